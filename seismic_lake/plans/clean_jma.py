"""One Japanese earthquake history from the reviewed catalog and the preliminary daily lists,
plus the archive of felt reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.labels import event_key
from seismic_lake.operators.neighbours import cell_names, name_by_neighbour
from seismic_lake.operators.revisions import newest_bulletin, one_per_event
from seismic_lake.operators.stitch import after_coverage, as_preliminary, coverage_cutoff, stitch
from seismic_lake.operators.validation import FELT_RULES, JMA_RULES, REASON, mark_rejects, reject_counts
from seismic_lake.plans.clean_usgs import CLEAN, outcome, written_counts
from seismic_lake.sources.catalog import parse_catalog, read_catalog_lines
from seismic_lake.sources.daily_pages import parse_daily, read_daily_lines
from seismic_lake.sources.feed import parse_feed, read_feed
from seismic_lake.sources.lake import BUILT, Build, Lake, MissingInput, path_exists, write_yearly
from seismic_lake.vocab import JMA_SCHEMA

TABLE = "clean/jma"
FELT_TABLE = "clean/jma_felt"
RAW = "raw/jma"
NAMES_SINCE_YEAR = 2000  # fixed value: older catalog names do not name cells


def gazetteer(catalog: DataFrame) -> DataFrame:
    """Most common region name per 0.1 degree cell, from the agency's own events."""
    recent = catalog.where((F.col("agency") == "J") & (F.year("event_time") >= NAMES_SINCE_YEAR))
    return cell_names(recent)


def stitched_history(catalog: DataFrame, daily: DataFrame) -> DataFrame:
    """All rows of both tiers with ids and English names, before de-duplication."""
    final = catalog.withColumn("region_en", F.col("region"))
    preliminary = name_by_neighbour(as_preliminary(after_coverage(daily, catalog)), gazetteer(catalog))
    rows = stitch(final, preliminary)
    key = event_key(F.col("event_time"), F.col("latitude"), F.col("longitude"))
    return rows.withColumn("event_id", key).select(*JMA_SCHEMA.fieldNames())


def _staged(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back, so text is parsed once however many plans use the rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _text_lines(lake: Lake, schema: str) -> DataFrame:
    return lake.spark.createDataFrame([], schema)


def build(lake: Lake, build_id: str, now: datetime) -> Build:
    """Rebuild both tables from all raw files. Recorded as built, not yet published."""
    raw = lake.path(RAW)
    has_catalog = path_exists(lake.spark, f"{raw}/catalog/h*.zip")
    has_daily = path_exists(lake.spark, f"{raw}/daily/*/*.html.gz")
    if not (has_catalog or has_daily):
        raise MissingInput(f"no catalog or daily files under {raw}; load the raw layer first")

    lines = (
        read_catalog_lines(lake.spark, f"{raw}/catalog") if has_catalog else _text_lines(lake, "line string")
    )
    pages = (
        read_daily_lines(lake.spark, f"{raw}/daily")
        if has_daily
        else _text_lines(lake, "day string, line string")
    )
    staging = lake.path(TABLE, "staging", build_id)
    path = lake.build_path(TABLE, build_id)
    catalog = _staged(parse_catalog(lines), f"{staging}/catalog")
    daily = _staged(parse_daily(pages), f"{staging}/daily")
    history = _staged(stitched_history(catalog, daily), f"{staging}/history")
    write_yearly(outcome(mark_rejects(one_per_event(history), JMA_RULES)), path, "event_time", ["outcome"])

    by_status = {r["status"]: r["count"] for r in history.groupBy("status").count().collect()}
    raw_rows = sum(by_status.values())
    # Rows without a time or place have no id; each is its own reject.
    no_key = mark_rejects(history.where("event_id IS NULL"), JMA_RULES)
    dropped = {r[REASON]: r["rows"] for r in reject_counts(no_key).collect()}
    unkeyed = sum(dropped.values())
    counts = written_counts(lake, path) if raw_rows > unkeyed else {}
    clean_rows = counts.pop(CLEAN, 0)
    for reason, n in counts.items():
        dropped[reason] = dropped.get(reason, 0) + n

    felt_rows, felt_dropped = build_felt(lake, build_id, now)
    summary = {
        "raw_rows": raw_rows,
        "rows_by_status": by_status,
        "catalog_covers_until": coverage_cutoff(catalog).first()["cutoff"],
        "duplicates_removed": raw_rows - clean_rows - sum(dropped.values()),
        "dropped": dropped,
        "clean_rows": clean_rows,
        "felt_rows": felt_rows,
        "felt_dropped": felt_dropped,
        "built_at": now.isoformat(timespec="seconds"),
    }
    location = f"{path}/outcome={CLEAN}"
    lake.record(TABLE, BUILT, build_id, now, location, summary)
    return Build(build_id, now, location, summary)


def felt_reports(bulletins: DataFrame) -> DataFrame:
    """Newest bulletin of every report over all snapshots, with its reject reason."""
    return mark_rejects(newest_bulletin(parse_feed(bulletins)).drop("snapshot"), FELT_RULES)


def build_felt(lake: Lake, build_id: str, now: datetime) -> tuple[int, int]:
    """Rebuild the felt archive from all snapshots; returns kept and rejected rows."""
    path = lake.build_path(FELT_TABLE, build_id)
    counts: dict[str, int] = {}
    folder = lake.path(RAW, "feed")
    if path_exists(lake.spark, f"{folder}/run_id=*/*"):
        marked = felt_reports(read_feed(lake.spark, folder))
        write_yearly(outcome(marked), path, "event_time", ["outcome"])
        if path_exists(lake.spark, f"{path}/outcome=*"):
            counts = written_counts(lake, path)
    kept = counts.pop(CLEAN, 0)
    lake.record(FELT_TABLE, BUILT, build_id, now, f"{path}/outcome={CLEAN}", {"clean_rows": kept})
    return kept, sum(counts.values())
