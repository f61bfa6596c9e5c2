"""Calendars: every day present, missing days, days to load again."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def days(spark: SparkSession, first: date | Column, last: date | Column) -> DataFrame:
    """One row per day, both ends included; none when ``last`` is before ``first``."""
    first, last = (F.lit(d) if isinstance(d, date) else d for d in (first, last))
    span = F.when(last >= first, F.sequence(first, last, F.expr("interval 1 day")))
    return spark.range(1).select(F.explode(span).alias("day"))


def counts_per_day(events: DataFrame, first: date, last: date, day: Column, output: str) -> DataFrame:
    """(day, output): events per day with quiet days as 0. Events are counted before the join."""
    counted = events.groupBy(day.alias("day")).agg(F.count("*").alias(output))
    return (
        days(events.sparkSession, first, last)
        .join(counted, "day", "left")
        .select("day", F.coalesce(output, F.lit(0).cast("bigint")).alias(output))
    )


def missing_days(present: DataFrame, first: Column | None = None) -> DataFrame:
    """Days absent between the first (or ``first``) and last day of a one-column ``day`` table.

    ``present`` is reduced to its distinct days first: at most one row per calendar day however
    large the table.
    """
    distinct = present.select("day").where("day IS NOT NULL").distinct()
    bounds = distinct.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    start = F.col("lo") if first is None else F.coalesce(first, F.col("lo"))
    span = F.when(F.col("hi") >= start, F.sequence(start, F.col("hi"), F.expr("interval 1 day")))
    return bounds.select(F.explode(span).alias("day")).join(distinct, "day", "left_anti")


def days_to_load(state: DataFrame, today: date, start: date, lookback_days: int = 7, lag_days: int = 2) -> DataFrame:
    """Days a daily source should be (re)loaded for, from a one-row state with the last finished day, ``done_until``.

    Everything after the last finished day plus the last ``lookback_days`` available days, whose
    lists may be revised; never before ``start``, never later than ``lag_days`` before today.
    """
    last = F.lit(today - timedelta(days=lag_days))
    resumed = F.least(F.date_add("done_until", 1), F.date_sub(last, lookback_days - 1))
    # A state without a finished day begins at the start; greatest() passes over the NULL.
    first = F.greatest(F.lit(start), F.when(F.col("done_until").isNotNull(), resumed))
    span = F.when(last >= first, F.sequence(first, last, F.expr("interval 1 day")))
    return state.select(F.explode(span).alias("day"))
