"""Validation with one reject reason per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    """``bad`` is true for rows to reject; NULL means the row is fine."""

    reason: str
    bad: Column | str

    def condition(self) -> Column:
        return F.expr(self.bad) if isinstance(self.bad, str) else self.bad


# Reasons in the order they are charged, with their limits.
NO_ID = Rule("missing event_id", "event_id IS NULL")
NO_TIME = Rule("missing event_time", "event_time IS NULL")
NO_PLACE = Rule("missing location", "latitude IS NULL OR longitude IS NULL")
NO_MAG = Rule("missing magnitude", "mag IS NULL")
BAD_LAT = Rule("latitude out of range", "latitude NOT BETWEEN -90 AND 90")
BAD_LON = Rule("longitude out of range", "longitude NOT BETWEEN -180 AND 180")

USGS_RULES = [
    NO_ID, NO_TIME, NO_PLACE, NO_MAG, BAD_LAT, BAD_LON,
    Rule("magnitude out of range", "mag NOT BETWEEN -2 AND 10"),
]
JMA_RULES = [
    NO_TIME, NO_PLACE, BAD_LAT, BAD_LON,
    Rule("magnitude out of range", "mag NOT BETWEEN -3 AND 10"),
]
FELT_RULES = [NO_TIME]


def mark_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the first reason a row fails, NULL when it passes all. One projection, no extra pass."""
    return df.withColumn(REASON, F.coalesce(*[F.when(r.condition(), r.reason) for r in rules]))


def accepted(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REASON).isNull()).drop(REASON)


def reject_counts(marked: DataFrame) -> DataFrame:
    """Rows per reason; reasons that did not occur are absent."""
    return marked.where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count("*").alias("rows"))
