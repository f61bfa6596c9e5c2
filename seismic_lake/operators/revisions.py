"""Keep the newest version of every record."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key under ``order``. Rows with a NULL key are left out.

    Planned as a per-key limit on both sides of the shuffle: every map task sends at most one row
    per key, so a key holding a third of the table costs one row per task, not a third of the
    table. NULL keys would form one such group for no use, so callers count them separately.
    """
    present = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return present.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _descending(*names: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in names]


# Versions equal in both times are told apart by what validation reads anyway, so the same one wins
# however often a task runs, and no column is shuffled only to break ties.


def event_order() -> list[Column]:
    return _descending("updated_at", "ingested_at", "event_time", "mag", "latitude", "longitude")


def bulletin_order() -> list[Column]:
    return _descending("updated_at", "snapshot", "event_time", "mag", "max_intensity")


def newest_revision(events: DataFrame) -> DataFrame:
    """Latest update of every event; equal updates go to the latest download."""
    return latest_by(events, ["event_id"], event_order())


def newest_bulletin(felt: DataFrame) -> DataFrame:
    """Latest bulletin of every report; equal updates go to the latest snapshot."""
    return latest_by(felt, ["report_id"], bulletin_order())


def one_per_event(events: DataFrame) -> DataFrame:
    """One row per event id; 'final' sorts before 'preliminary', then the fullest record wins."""
    return latest_by(
        events,
        ["event_id"],
        [
            F.col("status").asc_nulls_last(),
            F.col("mag").desc_nulls_last(),
            F.col("depth_km").asc_nulls_last(),
            F.col("region").asc_nulls_last(),
            F.col("latitude").asc_nulls_last(),
            F.col("longitude").asc_nulls_last(),
        ],
    )
