"""Snapshots of the felt-earthquake feed: a gzipped JSON array per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismic_lake.functions.geo import POINT_TEXT, point_depth_km, point_part
from seismic_lake.functions.text import to_number, to_timestamp
from seismic_lake.vocab import FEED_SCHEMA


def read_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Every bulletin of every snapshot; the run folder names the snapshot."""
    schema = T.StructType([*FEED_SCHEMA.fields, T.StructField("run_id", T.StringType())])
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(folder)
    return rows.withColumnRenamed("run_id", "snapshot")


def parse_feed(bulletins: DataFrame) -> DataFrame:
    """Bulletins with a location and an intensity, typed. Others are not felt reports.

    A time that cannot be read is left NULL for the job to count as a reject.
    """
    level = F.trim(F.col("maxi"))
    usable = (
        F.col("cod").rlike(POINT_TEXT)
        & (level != "")
        & (F.coalesce("eid", F.lit("")) != "")
        & (F.coalesce("at", F.lit("")) != "")
    )
    mag = to_number(F.col("mag"))
    return bulletins.where(usable).select(
        F.col("eid").alias("report_id"),
        to_timestamp(F.col("at")).alias("event_time"),
        point_part(F.col("cod"), 1).alias("latitude"),
        point_part(F.col("cod"), 2).alias("longitude"),
        point_depth_km(F.col("cod")).alias("depth_km"),
        F.when(~F.isnan(mag), mag).alias("mag"),
        level.alias("max_intensity"),
        F.nullif(F.col("anm"), F.lit("")).alias("region"),
        F.nullif(F.col("en_anm"), F.lit("")).alias("region_en"),
        to_timestamp(F.col("rdt")).alias("updated_at"),
        "snapshot",
    )
