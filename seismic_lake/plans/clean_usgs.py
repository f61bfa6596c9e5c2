"""Typed, de-duplicated, validated events from the raw downloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.operators.revisions import newest_revision
from seismic_lake.operators.validation import NO_ID, REASON, USGS_RULES, mark_rejects
from seismic_lake.sources.lake import BUILT, Build, Lake, write_yearly
from seismic_lake.sources.raw_events import read_raw_events, type_events

TABLE = "clean/usgs"
RAW = "raw/usgs"
CLEAN = "clean"


def marked_events(raw: DataFrame) -> DataFrame:
    """Newest revision of every identified event with its reject reason (NULL when accepted)."""
    return mark_rejects(newest_revision(type_events(raw)), USGS_RULES)


def clean_events(raw: DataFrame) -> DataFrame:
    """Accepted events with their year."""
    kept = marked_events(raw).where(F.col(REASON).isNull()).drop(REASON)
    return kept.withColumn("year", F.year("event_time"))


def reject_summary(raw: DataFrame) -> DataFrame:
    """(reject_reason, rows). Rows without an id cannot be revisions, so each counts."""
    typed = type_events(raw)
    no_id = typed.where("event_id IS NULL").agg(F.count("*").alias("rows"))
    no_id = no_id.where("rows > 0").select(F.lit(NO_ID.reason).alias(REASON), "rows")
    others = marked_events(raw).where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count("*").alias("rows"))
    return no_id.unionByName(others)


def outcome(marked: DataFrame) -> DataFrame:
    """Reason as a partition column, so accepted and rejected rows are written in one pass."""
    return marked.withColumn("outcome", F.coalesce(REASON, F.lit(CLEAN))).drop(REASON)


def written_counts(lake: Lake, path: str) -> dict[str, int]:
    """Rows per outcome of a finished build, answered from file footers and folder names."""
    rows = lake.spark.read.parquet(path).groupBy("outcome").count().collect()
    return {r["outcome"]: r["count"] for r in rows}


def build(lake: Lake, build_id: str, now: datetime) -> Build:
    """Rebuild the clean table from all raw runs. Recorded as built, not yet published."""
    raw = read_raw_events(lake.spark, lake.path(RAW))
    path = lake.build_path(TABLE, build_id)
    write_yearly(outcome(marked_events(raw)), path, "event_time", extra=["outcome"])

    blank = F.count_if(F.coalesce(F.trim("id"), F.lit("")) == "")
    totals = raw.agg(F.count("*").alias("rows"), blank.alias("blank")).first()
    counts = written_counts(lake, path) if totals["rows"] > totals["blank"] else {}
    clean_rows = counts.pop(CLEAN, 0)
    dropped = ({NO_ID.reason: totals["blank"]} if totals["blank"] else {}) | counts
    summary = {
        "raw_rows": totals["rows"],
        "duplicates_removed": totals["rows"] - clean_rows - sum(dropped.values()),
        "dropped": dropped,
        "clean_rows": clean_rows,
        "built_at": now.isoformat(timespec="seconds"),
    }
    location = f"{path}/outcome={CLEAN}"
    lake.record(TABLE, BUILT, build_id, now, location, summary)
    return Build(build_id, now, location, summary)
