"""Write gold tables as Parquet and as JSON documents for a web page."""

from __future__ import annotations

import json
import time
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismic_lake.plans.gold import GoldTable, utc
from seismic_lake.sources.lake import PUBLISHED, Lake

SET = "gold"


def json_document(table: DataFrame, generated_at: datetime, extras: dict) -> DataFrame:
    """The lines of one JSON text {generated_at, columns, rows: [[...]], ...extras}, in order.

    ``table`` is stored Parquet; its rows keep the order they were written in. One line for each row, so a
    table of any size is one document and no value holds more than a row. The lines are in one
    partition, sorted there (spilling if need be), as a single file needs them.
    """
    cells = F.concat(F.lit("["), F.array_join(F.array(*[_cell(table, c) for c in table.columns]), ","), F.lit("]"))
    place = (F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = table.select(F.lit(1).alias("part"), *place, cells.alias("value"))
    head = {"generated_at": utc(generated_at).isoformat(timespec="seconds"), "columns": table.columns}
    before = json.dumps(head, separators=(",", ":"))[:-1] + ',"rows":['
    after = "]" + "".join(f",{json.dumps(k)}:{json.dumps(v, separators=(',', ':'), default=str)}" for k, v in extras.items()) + "}"
    # The first row has no comma before it; files may be empty, so it is looked up.
    first = rows.agg(F.min(F.struct("file", "row")).alias("first")).scalar()
    comma = F.when(F.struct("file", "row") == first, "").otherwise(",")
    rows = rows.withColumn("value", F.concat(comma, "value"))
    ends = table.sparkSession.createDataFrame([(0, "", 0, before), (2, "", 0, after)], "part int, file string, row long, value string")
    return rows.unionByName(ends).repartition(1).sortWithinPartitions("part", "file", "row").select("value")


def _cell(table: DataFrame, name: str):
    # A one-element JSON array without its brackets quotes and escapes any type.
    array = F.to_json(F.array(F.col(name)))
    return F.coalesce(F.substring(array, 2, F.length(array) - 2), F.lit("null"))


def write(tables: dict[str, GoldTable], lake: Lake, now: datetime, site: str | None = None) -> dict[str, int]:
    """Write all tables of a run as one set, Parquet and under ``site`` a JSON document each; returns row counts.

    Each table is computed once; counts and documents come from the stored files. A run's files go to folders of its
    own, and one log row, written when all are complete, makes them the newest set: :func:`read` gives the tables of one run
    whenever it is called, and a run that stops halfway leaves the set before it as it was. The plainly named
    copies, for pages that ask for one document by its name, are made from the recorded set afterwards.
    """
    run = f"{utc(now):%Y%m%dT%H%M%S}-{time.time_ns():020d}"  # of two runs for the same time the later one is the newest
    folder, pages = lake.path(SET, "builds", run), None if site is None else f"{site}/runs/{run}"
    counts = {}
    for name, table in tables.items():
        table.rows.write.parquet(f"{folder}/{name}")
        stored = lake.spark.read.schema(table.rows.schema).parquet(f"{folder}/{name}")
        counts[name] = stored.count()
        if pages is not None:
            json_document(stored, now, dict(table.extras)).write.text(f"{pages}/{name}.json")
    schemas = {name: table.rows.schema.json() for name, table in tables.items()}
    lake.record(SET, PUBLISHED, run, now, folder, {"counts": counts, "schemas": schemas, "pages": pages})
    for name, table in tables.items():
        stored = lake.spark.read.schema(table.rows.schema).parquet(f"{folder}/{name}")
        stored.write.mode("overwrite").parquet(lake.path(SET, name))
        if site is not None:
            json_document(stored, now, dict(table.extras)).write.mode("overwrite").text(f"{site}/{name}.json")
    return counts


def read(lake: Lake) -> dict[str, DataFrame]:
    """The tables of the newest complete set, all of one run; none before the first."""
    newest = lake.newest(SET)
    if newest is None:
        return {}
    schemas = {name: T.StructType.fromJson(json.loads(text)) for name, text in newest.summary["schemas"].items()}
    return {name: lake.spark.read.schema(schema).parquet(f"{newest.location}/{name}") for name, schema in schemas.items()}
