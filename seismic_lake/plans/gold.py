"""Gold tables: one small table per question the dashboard asks.

Every function takes clean DataFrames and ``now`` and returns a DataFrame. Time limits are given
both on ``event_time`` and on the ``year`` partition, which Catalyst cannot derive itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.geo import in_box
from seismic_lake.functions.labels import magnitude_band, shindo_rank
from seismic_lake.functions.times import instant
from seismic_lake.operators.calendar import counts_per_day
from seismic_lake.plans.analytics import per_check, run_health
from seismic_lake.plans.audit import HISTORY
from seismic_lake.plans.clean_jma import FELT_TABLE
from seismic_lake.plans.clean_jma import TABLE as JMA_TABLE
from seismic_lake.plans.clean_usgs import TABLE as USGS_TABLE
from seismic_lake.plans.link import read_matches
from seismic_lake.sources.lake import PUBLISHED, Lake, MissingInput, path_exists, read_dq_history
from seismic_lake.vocab import (
    DAILY_DAYS,
    FELT_SCHEMA,
    FELT_SHOWN,
    JAPAN_BOX,
    JAPAN_MAP_MIN_MAG,
    JMA_SCHEMA,
    MAP_DAYS,
    MAP_MIN_MAG,
    RUNS_SHOWN,
    STRONGEST_N,
    USGS_SCHEMA,
)

COVERAGE_SINCE = datetime(2000, 1, 1, tzinfo=timezone.utc)


def utc(now: datetime) -> datetime:
    return now.replace(tzinfo=timezone.utc) if now.tzinfo is None else now.astimezone(timezone.utc)


def midnight(now: datetime) -> datetime:
    return utc(now).replace(hour=0, minute=0, second=0, microsecond=0)


def since(moment: datetime) -> Column:
    """Events at or after a moment, with the year bound that prunes partitions."""
    return (F.col("event_time") >= instant(moment)) & (F.col("year") >= utc(moment).year)


def shown(place: Column, ident: str = "event_id") -> list[Column]:
    """Columns of one event on a map: time in epoch ms, rounded coordinates."""
    return [
        F.unix_millis("event_time").alias("time"),
        F.round("latitude", 3).alias("lat"),
        F.round("longitude", 3).alias("lon"),
        F.round("depth_km", 1).alias("depth"),
        F.col("mag"),
        place.alias("place"),
        F.col(ident).alias("id"),
    ]


def felt_shown() -> list[Column]:
    return [
        F.unix_millis("event_time").alias("time"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.col("depth_km").alias("depth"),
        F.col("mag"),
        F.col("max_intensity").alias("shindo"),
        F.coalesce("region_en", "region").alias("place"),
        F.col("report_id").alias("id"),
    ]


def _count(rows: DataFrame) -> Column:
    return rows.agg(F.count("*").alias("n")).scalar()


def summary_counts(usgs: DataFrame, now: datetime) -> DataFrame:
    """Archive size and first year, which need no column of the files, and the last day and week,
    which read only this year's folders."""
    now = utc(now)
    day, week = (usgs.where(since(now - timedelta(days=n))) for n in (1, 7))
    totals = usgs.agg(F.count("*").alias("archive_total"), F.min("year").alias("archive_since"))
    return totals.select("*", _count(day).alias("last_24h"), _count(week).alias("last_7d"))


def _strongest(events: DataFrame, n: int) -> DataFrame:
    return events.orderBy(F.col("mag").desc_nulls_last(), F.col("event_time"), F.col("event_id")).limit(n)


def largest_this_month(usgs: DataFrame, now: datetime) -> DataFrame:
    return _strongest(usgs.where(since(midnight(now).replace(day=1))), 1).select(*shown(F.col("place")))


def recent_quakes(usgs: DataFrame, now: datetime) -> DataFrame:
    recent = usgs.where(since(utc(now) - timedelta(days=MAP_DAYS)) & (F.col("mag") >= MAP_MIN_MAG))
    return recent.orderBy("event_time").select(*shown(F.col("place")))


def daily_counts(usgs: DataFrame, now: datetime) -> DataFrame:
    """Events per UTC day over the last complete days; quiet days are 0, today is left out."""
    end = midnight(now)
    start = end - timedelta(days=DAILY_DAYS)
    rows = usgs.where(since(start) & (F.col("event_time") < instant(end)))
    last = (end - timedelta(days=1)).date()
    counted = counts_per_day(rows, start.date(), last, F.to_date("event_time"), "quakes")
    return counted.orderBy("day").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "quakes")


def strongest_this_year(usgs: DataFrame, now: datetime) -> DataFrame:
    start = midnight(now).replace(month=1, day=1)
    return _strongest(usgs.where(since(start)), STRONGEST_N).select(*shown(F.col("place")))


# --- Japan -----------------------------------------------------------------------------------


def japan_quakes(jma: DataFrame | None, usgs: DataFrame, now: datetime) -> DataFrame:
    """Map rows of the last 30 days; the other agency's events stand in until there are any."""
    window = since(utc(now) - timedelta(days=MAP_DAYS)) & in_box(JAPAN_BOX)
    if jma is None:
        return usgs.where(window).orderBy("event_time").select(*shown(F.col("place")))
    mapped = jma.where(window & (F.col("event_type") == "earthquake") & (F.col("mag") >= JAPAN_MAP_MIN_MAG))
    return mapped.orderBy("event_time").select(*shown(F.coalesce("region_en", "region")))


def japan_totals(jma: DataFrame, usgs: DataFrame, now: datetime) -> DataFrame:
    """One row: events located (any magnitude), the other agency's count, newest time in epoch ms.

    Each figure has its own pruned scan; the newest event is in the last year's folder.
    """
    window = since(utc(now) - timedelta(days=MAP_DAYS)) & in_box(JAPAN_BOX)
    last_year = jma.agg(F.max("year").alias("y")).scalar()
    newest = jma.where(F.col("year") >= last_year).agg(F.unix_millis(F.max("event_time")).alias("newest"))
    located = _count(jma.where(window & (F.col("event_type") == "earthquake")))
    return newest.select(located.alias("located_total"), _count(usgs.where(window)).alias("usgs_total"), "newest")


def japan_felt(felt: DataFrame) -> DataFrame:
    newest = felt.orderBy(F.col("event_time").desc_nulls_last(), F.col("report_id")).limit(FELT_SHOWN)
    return newest.select(*felt_shown())


def strongest_shaking(felt: DataFrame, now: datetime) -> DataFrame:
    """Strongest felt reports of the last 30 days by intensity level, then magnitude."""
    recent = felt.where(since(utc(now) - timedelta(days=MAP_DAYS)))
    ranked = recent.orderBy(
        shindo_rank(F.col("max_intensity")).desc_nulls_last(),
        F.col("mag").desc_nulls_last(),
        F.col("event_time").desc_nulls_last(),
        F.col("report_id"),
    )
    return ranked.limit(FELT_SHOWN).select(*felt_shown())


def coverage_by_band(jma: DataFrame, matches: DataFrame) -> DataFrame:
    """Per magnitude band since 2000: earthquakes, how many are linked, median magnitude difference.

    The median is exact; its state is one counter per distinct hundredth of a magnitude.
    """
    quakes = jma.where(
        since(COVERAGE_SINCE) & in_box(JAPAN_BOX) & (F.col("event_type") == "earthquake") & (F.col("mag") >= 0)
    ).select("event_id", magnitude_band(F.col("mag"), cap=6).alias("band"))
    linked = matches.select("jma_event_id", "mag_diff")
    return (
        quakes.join(linked, quakes["event_id"] == linked["jma_event_id"], "left")
        .groupBy("band")
        .agg(
            F.count("*").alias("jma_quakes"),
            F.count("jma_event_id").alias("in_usgs"),
            F.round(F.median("mag_diff"), 2).alias("median_mag_diff"),
        )
        .orderBy("band")
    )


# --- Audit history ---------------------------------------------------------------------------


def check_label() -> Column:
    """Check name, prefixed with its dataset unless that is the main one."""
    return F.when(F.col("ds") == "usgs", F.col("check")).otherwise(
        F.concat(F.upper("ds"), F.lit(": "), F.col("check"))
    )


def run_history(dq: DataFrame) -> DataFrame:
    """The newest runs over all datasets, oldest first. A run is published if every dataset was."""
    health = run_health(check_label(), F.col("ds") == "usgs")
    runs = per_check(dq).groupBy("run_id").agg(*health)
    newest = runs.orderBy(F.col("run_at").desc(), F.col("run_id").desc()).limit(RUNS_SHOWN)
    oldest_first = newest.orderBy("run_at", "run_id").drop("run_id")
    return oldest_first.withColumn("run_at", F.unix_millis("run_at"))


def newest_run(dq: DataFrame) -> Column:
    """Id of the run with the latest result, as a scalar subquery."""
    return dq.agg(F.max(F.struct("run_at", "run_id"))["run_id"].alias("run_id")).scalar()


def latest_checks(dq: DataFrame) -> DataFrame:
    """All results of the newest run, the main dataset first."""
    rows = dq.where(F.col("run_id") == newest_run(dq))
    return rows.orderBy(F.col("ds").desc(), "check").select(
        check_label().alias("check"), "severity", "passed", "observed", "expected"
    )


# --- All tables ------------------------------------------------------------------------------


@dataclass
class GoldTable:
    rows: DataFrame
    extras: dict = field(default_factory=dict)


def build_tables(lake: Lake, now: datetime, event: str = PUBLISHED) -> dict[str, GoldTable]:
    """Every gold table the published data allows."""
    now = utc(now)
    usgs = lake.read(USGS_TABLE, USGS_SCHEMA, event)
    if usgs is None:
        raise MissingInput(f"no clean usgs table under {lake.root}; build and publish it first")
    jma = lake.read(JMA_TABLE, JMA_SCHEMA, event)

    headline = summary_counts(usgs, now)
    top = largest_this_month(usgs, now).first()
    tables = {
        "summary": GoldTable(
            headline, headline.first().asDict() | {"largest_this_month": top.asDict() if top else None}
        ),
        "recent_quakes": GoldTable(recent_quakes(usgs, now)),
        "daily_counts": GoldTable(daily_counts(usgs, now)),
        "strongest_this_year": GoldTable(strongest_this_year(usgs, now), {"year": now.year}),
    }
    if jma is None:
        tables["japan_quakes"] = GoldTable(japan_quakes(None, usgs, now), {"source": "usgs"})
    else:
        tables |= _japan(lake, jma, usgs, now, event)
    history = lake.path(HISTORY)
    if path_exists(lake.spark, f"{history}/*"):
        dq = read_dq_history(lake.spark, history)
        checks = latest_checks(dq)
        run_at = dq.where(F.col("run_id") == newest_run(dq)).agg(F.unix_millis(F.min("run_at")).alias("t"))
        listed = [r.asDict() for r in checks.collect()]  # one run's checks
        tables["pipeline_runs"] = GoldTable(run_history(dq))
        tables["latest_checks"] = GoldTable(checks, {"run_at": run_at.first()["t"], "checks": listed})
    return tables


def _japan(lake: Lake, jma: DataFrame, usgs: DataFrame, now: datetime, event: str) -> dict[str, GoldTable]:
    totals = japan_totals(jma, usgs, now).first().asDict()
    felt = lake.read(FELT_TABLE, FELT_SCHEMA, event)
    if felt is None:
        felt = lake.spark.createDataFrame([], FELT_SCHEMA).withColumn("year", F.year("event_time"))
    tables = {
        "japan_quakes": GoldTable(
            japan_quakes(jma, usgs, now), {"source": "jma", "min_mag": JAPAN_MAP_MIN_MAG, **totals}
        ),
        "japan_felt": GoldTable(japan_felt(felt)),
        "japan_strongest_shaking": GoldTable(strongest_shaking(felt, now), {"days": MAP_DAYS}),
    }
    matches = read_matches(lake, event)
    if matches is not None:
        tables["jma_usgs_coverage"] = GoldTable(coverage_by_band(jma, matches))
    return tables
