"""Join a reviewed catalog and the preliminary lists that follow it into one history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.times import jst_date

NO_COVERAGE = "00000101"


def coverage_cutoff(final: DataFrame) -> DataFrame:
    """One row: the first day (yyyymmdd, local time) after the last year the catalog covers."""
    last_year = F.max(F.year(jst_date(F.col("event_time"))))
    day = F.concat(F.lpad((last_year + 1).cast("string"), 4, "0"), F.lit("0101"))
    return final.agg(F.coalesce(day, F.lit(NO_COVERAGE)).alias("cutoff"))


def after_coverage(daily: DataFrame, final: DataFrame) -> DataFrame:
    """Daily rows whose file day the catalog does not cover.

    The cutoff is a scalar subquery: a one-column aggregate whose result is pushed into the scan
    of the daily rows, with no driver round trip and no join.
    """
    return daily.where(F.col("day") >= coverage_cutoff(final).scalar())


def as_preliminary(daily: DataFrame) -> DataFrame:
    return daily.select(
        "event_time", "latitude", "longitude", "depth_km", "mag",
        F.when(F.col("mag").isNotNull(), "Mj").alias("mag_type"),
        F.lit(None).cast("string").alias("max_intensity"),
        F.lit("earthquake").alias("event_type"),
        "region",
        F.lit("J").alias("agency"),
        F.lit("preliminary").alias("status"),
        F.lit("jma_daily").alias("source"),
    )


def stitch(final: DataFrame, preliminary: DataFrame) -> DataFrame:
    """Both tiers by column name; a column one side lacks is NULL there."""
    return final.unionByName(preliminary, allowMissingColumns=True)
