"""Link records of the same earthquake across the two agencies by time and distance."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.geo import in_box
from seismic_lake.operators.nearest import count_pairs, mutual_best
from seismic_lake.plans.clean_jma import TABLE as JMA_TABLE
from seismic_lake.plans.clean_usgs import TABLE as USGS_TABLE
from seismic_lake.sources.lake import BUILT, PUBLISHED, Build, Lake, MissingInput
from seismic_lake.vocab import JMA_SCHEMA, LINK_BOX, LINK_MIN_MAG, MATCH_SCHEMA, USGS_SCHEMA

TABLE = "clean/jma_usgs_matches"
LINKED_COLUMNS = ["event_id", "event_time", "latitude", "longitude", "depth_km", "mag", "mag_type"]


def jma_candidates(jma: DataFrame) -> DataFrame:
    wanted = in_box(LINK_BOX) & (F.col("mag") >= LINK_MIN_MAG) & (F.col("event_type") == "earthquake")
    return jma.where(wanted).select(*LINKED_COLUMNS)


def usgs_candidates(usgs: DataFrame) -> DataFrame:
    return usgs.where(in_box(LINK_BOX)).select(*LINKED_COLUMNS)


def link(jma: DataFrame, usgs: DataFrame) -> DataFrame:
    """The link table: one row per pair that are each other's best candidate."""
    j, u = jma_candidates(jma), usgs_candidates(usgs)
    pairs = mutual_best(j, u)

    def side(df: DataFrame, prefix: str, *names: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in ("event_id", *names)])

    joined = (
        pairs.withColumnsRenamed({"a_id": "jma_event_id", "b_id": "usgs_event_id"})
        .join(side(j, "jma", "event_time", "mag", "mag_type", "depth_km"), "jma_event_id")
        .join(side(u, "usgs", "mag", "mag_type", "depth_km"), "usgs_event_id")
    )
    return joined.withColumns(
        {
            "time_diff_s": F.round("dt", 2),
            "distance_km": F.round("km", 1),
            "mag_diff": F.round(F.col("usgs_mag") - F.col("jma_mag"), 2),
            "score": F.round("score", 4),
        }
    ).select(*MATCH_SCHEMA.fieldNames())


def link_summary(jma: DataFrame, usgs: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: candidates on both sides, pairs within tolerance, links.

    Pairs are counted by whole blocks where that can be; none is a row.
    """
    j, u = jma_candidates(jma), usgs_candidates(usgs)
    parts = [("jma_candidates", j), ("usgs_candidates", u), ("matched", matches)]
    counted = None
    for name, df in parts:
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counted = one if counted is None else counted.unionByName(one)
    counted = counted.unionByName(count_pairs(j, u).select(F.lit("pairs_considered").alias("name"), F.col("pairs").alias("n")))
    names = ["jma_candidates", "usgs_candidates", "pairs_considered", "matched"]
    return counted.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names])


def build(lake: Lake, build_id: str, now: datetime, event: str = BUILT) -> Build:
    """Rebuild the link table from the newest builds of both clean tables."""
    jma = lake.read(JMA_TABLE, JMA_SCHEMA, event)
    usgs = lake.read(USGS_TABLE, USGS_SCHEMA, event)
    for name, table in (("jma", jma), ("usgs", usgs)):
        if table is None:
            raise MissingInput(f"no clean {name} table under {lake.root}; build it first")
    path = lake.build_path(TABLE, build_id)
    # Rebalancing gives one file while the table is small and well-sized files when it is not.
    links = link(jma, usgs).hint("rebalance").sortWithinPartitions("jma_event_time")
    links.write.mode("overwrite").parquet(path)
    matches = lake.spark.read.schema(MATCH_SCHEMA).parquet(path)
    summary = link_summary(jma, usgs, matches).first().asDict()
    lake.record(TABLE, BUILT, build_id, now, path, summary)
    return Build(build_id, now, path, summary)


def read_matches(lake: Lake, event: str = PUBLISHED) -> DataFrame | None:
    return lake.read(TABLE, MATCH_SCHEMA, event, yearly=False)
