"""Name rows after the most common name in their map cell or, failing that, a cell next to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.geo import cell


def cell_names(named: DataFrame, name: str = "region", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(ci, cj, name, n): the most common name of every 0.1 degree cell, ties to the first in order.

    Counting per (cell, name) first keeps a cell that holds much of the table to one row per name
    and map task.
    """
    counts = (
        named.where(F.col(name).isNotNull())
        .groupBy(cell(F.col(lat)).alias("ci"), cell(F.col(lon)).alias("cj"), F.col(name).alias("name"))
        .agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("name").alias("name")))
    return (
        counts.groupBy("ci", "cj")
        .agg(best.alias("b"))
        .select("ci", "cj", F.col("b.name").alias("name"), (-F.col("b.neg_n")).alias("n"))
    )


def spread_to_neighbours(cells: DataFrame) -> DataFrame:
    """(ci, cj, name): the best name for every cell that has one within its 3x3 block.

    Nearest first (own cell, then sides, then corners), then the more frequent name. Spreading the
    named cells instead of the rows means the big table is looked up once, not nine times. The
    result has at most nine rows per named cell, and the globe has 6.5 million cells.
    """
    steps = F.sequence(F.lit(-1), F.lit(1))
    targets = cells.withColumn("di", F.explode(steps)).withColumn("dj", F.explode(steps))
    preference = F.min(
        F.struct(
            (F.abs("di") + F.abs("dj")).alias("distance"),
            (-F.col("n")).alias("neg_n"),
            F.col("name").alias("name"),
        )
    )
    return (
        targets.groupBy((F.col("ci") + F.col("di")).alias("ci"), (F.col("cj") + F.col("dj")).alias("cj"))
        .agg(preference.alias("b"))
        .select("ci", "cj", F.col("b.name").alias("name"))
    )


def name_by_neighbour(rows: DataFrame, cells: DataFrame, output: str = "region_en") -> DataFrame:
    """Add ``output`` to every row: NULL where neither its cell nor the eight around it is named.

    The lookup is broadcast only if Spark measures it below its broadcast limit; otherwise it is a
    left join on the cell, where AQE splits a cell that holds much of the rows.
    """
    lookup = spread_to_neighbours(cells).withColumnRenamed("name", output)
    keyed = rows.withColumns({"ci": cell(F.col("latitude")), "cj": cell(F.col("longitude"))})
    return keyed.join(lookup, ["ci", "cj"], "left").drop("ci", "cj")
