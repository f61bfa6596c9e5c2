"""Ready-made analytical queries over the clean tables and the audit history."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seismic_lake.functions.geo import in_box
from seismic_lake.functions.times import instant
from seismic_lake.plans.audit import ERROR, WARN
from seismic_lake.vocab import JAPAN_BOX, JST_HOURS, Box

# Limits of the published example queries.
NEAR_JAPAN = Box(24, 46, 122, 146)
TOP_N = 20
RUNS = 30
TOKYO = "Asia/Tokyo"


def per_year(events: DataFrame, since_year: int = 2000) -> DataFrame:
    """Events and mean magnitude per year; reads only the year folders and the magnitude column."""
    return (
        events.where(F.col("year") >= since_year)
        .groupBy("year")
        .agg(F.count("*").alias("quakes"), F.round(F.avg("mag"), 2).alias("avg_mag"))
        .orderBy("year")
    )


def strongest_near(events: DataFrame, this_year: int, box: Box = NEAR_JAPAN, n: int = TOP_N) -> DataFrame:
    """Strongest events in a box over the last ten years, with the local time for display."""
    rows = events.where((F.col("year") >= this_year - 10) & in_box(box))
    top = rows.orderBy(F.col("mag").desc_nulls_last(), F.col("event_time"), F.col("event_id")).limit(n)
    return top.select(
        "event_time", F.from_utc_timestamp("event_time", TOKYO).alias("time_jst"), "mag", "depth_km", "place"
    )


def most_recent(events: DataFrame, this_year: int, n: int = TOP_N) -> DataFrame:
    newest = events.where(F.col("year") == this_year)
    newest = newest.orderBy(F.col("event_time").desc_nulls_last(), F.col("event_id")).limit(n)
    return newest.select("event_time", "mag", "place", "updated_at")


def failed_checks(dq: DataFrame, now: datetime, days: int = 30) -> DataFrame:
    rows = dq.where(~F.col("passed") & (F.col("run_at") > instant(now - timedelta(days=days))))
    return rows.orderBy(F.col("run_at").desc(), "check").select(
        "run_at", "check", "severity", "observed", "expected"
    )


def per_check(dq: DataFrame) -> DataFrame:
    """The history with equal results of a run counted together.

    However many rows a run has, only its distinct checks go on to be listed.
    """
    return dq.groupBy("run_id", "ds", "check", "severity", "passed").agg(
        F.count("*").alias("n"), F.min("run_at").alias("run_at"), F.max("value").alias("value")
    )


def failed_text(listed: Column) -> Column:
    """Each failed check once, in alphabetical order, with "(n)" after it where n > 1 of its rows failed.

    ``listed`` has a (label, n) per distinct check, so the text does not grow with the rows.
    """
    labels = F.array_sort(F.array_distinct(F.transform(listed, lambda x: x["label"])))

    def entry(name: Column) -> Column:
        n = F.aggregate(F.filter(listed, lambda x: x["label"] == name), F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
        return F.concat(name, F.when(n > 1, F.concat(F.lit(" ("), n.cast("string"), F.lit(")"))).otherwise(""))

    return F.array_join(F.transform(labels, entry), ", ")


def run_health(label: Column, counted: Column) -> list[Column]:
    """Aggregates of a run over :func:`per_check` rows; ``counted`` marks the rows whose row count
    and freshness are shown, ``label`` names a failed check."""
    failed = ~F.col("passed")

    def failures(severity: str) -> Column:
        return F.coalesce(F.sum(F.when(failed & (F.col("severity") == severity), F.col("n"))), F.lit(0))

    def measured(check: str) -> Column:
        return F.max(F.when(counted & (F.col("check") == check), F.col("value")))

    listed = F.collect_list(F.when(failed, F.struct(label.alias("label"), F.col("n").alias("n"))))
    return [
        F.min("run_at").alias("run_at"),
        F.bool_and(F.col("passed") | (F.col("severity") == WARN)).alias("published"),
        failures(ERROR).alias("errors"),
        failures(WARN).alias("warnings"),
        measured("not empty").alias("row_count"),
        measured("data is fresh").alias("hours_since_newest_event"),
        failed_text(listed).alias("failed_checks"),
    ]


def dq_runs(dq: DataFrame) -> DataFrame:
    """The long audit history as one wide row per run and dataset."""
    health = run_health(F.col("check"), F.lit(True))
    return per_check(dq).groupBy("run_id", F.col("ds").alias("dataset")).agg(*health)


def newest_dq_runs(dq: DataFrame, n: int = RUNS) -> DataFrame:
    runs = dq_runs(dq).orderBy(F.col("run_at").desc(), "run_id", "dataset").limit(n)
    return runs.select(
        "run_at", "published", "errors", "warnings", "row_count", "hours_since_newest_event", "failed_checks"
    )


def per_year_ratio(jma: DataFrame, usgs: DataFrame, since_year: int = 2015) -> DataFrame:
    """Events per year around Japan in both sources and their ratio, for years both have."""
    recent = (F.col("year") >= since_year) & in_box(JAPAN_BOX)
    ours = jma.where(recent & (F.col("event_type") == "earthquake")).groupBy("year")
    theirs = usgs.where(recent).groupBy("year")
    return (
        ours.agg(F.count("*").alias("jma_quakes"))
        .join(theirs.agg(F.count("*").alias("usgs_quakes")), "year")
        .withColumn("ratio", F.round(F.col("jma_quakes") / F.col("usgs_quakes"), 1))
        .orderBy("year")
    )


def magnitude_comparison(matches: DataFrame) -> DataFrame:
    """Links per whole magnitude: approximate median difference, mean distance and time difference."""
    return (
        matches.groupBy(F.floor("jma_mag").alias("jma_band"))
        .agg(
            F.count("*").alias("quakes"),
            F.round(F.approx_percentile("mag_diff", 0.5), 2).alias("median_usgs_minus_jma"),
            F.round(F.avg("distance_km"), 1).alias("avg_distance_km"),
            F.round(F.avg("time_diff_s"), 2).alias("avg_time_diff_s"),
        )
        .orderBy("jma_band")
    )


def strongest_shaking_by_text(felt: DataFrame, this_year: int, n: int = TOP_N) -> DataFrame:
    """Felt reports by intensity text, descending ('5-' sorts above '5+'), newest first."""
    rows = felt.where(F.col("year") >= this_year - 1)
    top = rows.orderBy(
        F.col("max_intensity").desc_nulls_last(), F.col("event_time").desc_nulls_last(), F.col("report_id")
    ).limit(n)
    return top.select(
        F.from_utc_timestamp("event_time", TOKYO).alias("time_jst"),
        F.col("max_intensity").alias("shindo"),
        "mag",
        "region_en",
    )


# --- Dashboard figures -----------------------------------------------------------------------


def published_share(runs: DataFrame) -> DataFrame:
    """Runs published out of runs shown."""
    return runs.agg(F.count_if("published").alias("published"), F.count("*").alias("runs"))


def newest_first(daily: DataFrame) -> DataFrame:
    """Days in the order a table shows them, with their ``place``: 1 for the newest. One row a day of the period."""
    newest = F.row_number().over(W.orderBy(F.col("day").desc()))
    return daily.withColumn("place", newest.cast("bigint")).orderBy("place")


def largest_shown(quakes: DataFrame) -> DataFrame:
    """The largest of the events on a map; the earliest of equals."""
    return quakes.orderBy(F.col("mag").desc_nulls_last(), "time", "id").limit(1)


def busiest_day(daily: DataFrame) -> DataFrame:
    """The day with the most events; the earliest of equals."""
    return daily.orderBy(F.col("quakes").desc(), F.col("day")).limit(1)


def coverage_percent(coverage: DataFrame) -> DataFrame:
    share = F.coalesce(F.try_divide(F.col("in_usgs") * 100.0, F.col("jma_quakes")), F.lit(0.0))
    return coverage.withColumn("percent", share)


def local_clock(jst_source: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Times as a wall clock at the sources' fixed offset, which differs from Tokyo time in 1948-51."""
    return jst_source.withColumn("time_local", F.col(time_col) + F.expr(f"interval {JST_HOURS} hour"))
