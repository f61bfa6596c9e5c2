"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismic_lake.functions import fixed_width, geo, labels, text, times
from seismic_lake.operators import calendar, incremental, lines, nearest, neighbours, proximity, revisions, stitch, validation
from seismic_lake.plans import analytics, audit, clean_jma, clean_usgs, gold, link
from seismic_lake.sources import catalog, daily_pages, feed, raw_events
from workload.inputs import spark_input, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW_ORDERS = datetime(2001, 8, 1, 12, tzinfo=timezone.utc)  # the newest order is of this day
NOW_EVENTS = datetime(2024, 1, 31, tzinfo=timezone.utc)  # a day after the newest event
WINDOW_CAP = 300


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def us(name: str):
    """A timestamp column as epoch microseconds, which both engines print the same."""
    return F.unix_micros(name).alias(name.replace("_time", "") + "_us")


def big(name: str):
    return F.col(name).cast("bigint").alias(name)


# --- Cleaning -------------------------------------------------------------------------------


def _event_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", us("event_time"), us("updated_at"), "latitude", "longitude", "depth_km", "mag",
        "mag_type", big("nst"), "place", "event_type", "review_status", "source", "ingested_at",
    )


@query
def typed_clean(spark, sf):
    return _event_columns(raw_events.type_events(spark_input(spark, sf, "raw_events")))


@query
def latest_revision(spark, sf):
    return _event_columns(revisions.newest_revision(raw_events.type_events(spark_input(spark, sf, "raw_events"))))


@query
def reject_reasons(spark, sf):
    return clean_usgs.reject_summary(spark_input(spark, sf, "raw_events"))


@query
def clean_rows(spark, sf):
    return _event_columns(clean_usgs.clean_events(spark_input(spark, sf, "raw_events")))


@query
def clean_summary(spark, sf):
    raw = spark_input(spark, sf, "raw_events")
    marked = clean_usgs.marked_events(raw)
    parts = marked.agg(
        F.count("*").alias("identified"),
        F.count_if(F.col(validation.REASON).isNotNull()).alias("rejected"),
        F.count_if(F.col(validation.REASON).isNull()).alias("clean_rows"),
    )
    blank = raw.agg(
        F.count("*").alias("n"), F.count_if(F.trim("id") == "").alias("blank")
    )
    n, no_id = blank.select("n").scalar(), blank.select("blank").scalar()
    return parts.select(
        n.alias("raw_rows"),
        (n - no_id - F.col("identified")).alias("duplicates_removed"),
        (F.col("rejected") + no_id).alias("dropped"),
        "clean_rows",
    )


@query
def clean_per_year(spark, sf):
    """Raw text rows to events per year: the whole cleaning path and an answer."""
    events = clean_usgs.clean_events(spark_input(spark, sf, "raw_events"))
    per_year = analytics.per_year(events, 1995)
    return per_year.select(big("year"), "quakes", "avg_mag")


# --- Parsing ---------------------------------------------------------------------------------


def _catalog(spark, sf):
    return spark_input(spark, sf, "catalog_lines").where(F.length("line") >= catalog.MIN_LINE_LENGTH)


@query
def fixed_width_number(spark, sf):
    line = F.col("line")
    return _catalog(spark, sf).select(
        "rec", "line",
        fixed_width.implied_decimal(line, 14, 4, 2).alias("sec"),
        fixed_width.implied_decimal(line, 22, 3).alias("lat_deg"),
        fixed_width.implied_decimal(line, 25, 4, 2).alias("lat_min"),
        fixed_width.implied_decimal(line, 45, 5, 2).alias("depth_km"),
    )


@query
def magnitude_codes(spark, sf):
    line = F.col("line")
    first, second = fixed_width.coded_magnitude(line, 53), fixed_width.coded_magnitude(line, 56)
    return _catalog(spark, sf).select("rec", "line", first.alias("first_mag"), second.alias("second_mag"))


@query
def dms_degrees(spark, sf):
    line = F.col("line")
    lat = fixed_width.degrees_minutes(
        fixed_width.implied_decimal(line, 22, 3), fixed_width.implied_decimal(line, 25, 4, 2)
    )
    lon = fixed_width.degrees_minutes(
        fixed_width.implied_decimal(line, 33, 4), fixed_width.implied_decimal(line, 37, 4, 2)
    )
    return _catalog(spark, sf).select("rec", "line", F.round(lat, 7).alias("lat"), F.round(lon, 7).alias("lon"))


@query
def local_to_utc(spark, sf):
    parsed = catalog.parse_catalog(spark_input(spark, sf, "catalog_lines"))
    return parsed.select(us("event_time"), "agency", "region")


@query
def code_maps(spark, sf):
    parsed = catalog.parse_catalog(spark_input(spark, sf, "catalog_lines"))
    return parsed.groupBy("mag_type", "max_intensity", "event_type").agg(F.count("*").alias("n"))


@query
def catalog_parse(spark, sf):
    parsed = catalog.parse_catalog(spark_input(spark, sf, "catalog_lines"))
    return parsed.select(
        us("event_time"), F.round("latitude", 7).alias("latitude"), F.round("longitude", 7).alias("longitude"),
        "depth_km", "mag", "mag_type", "max_intensity", "event_type", "region", "agency", "status", "source",
    )


@query
def daily_line_parse(spark, sf):
    parsed = daily_pages.parse_daily(spark_input(spark, sf, "daily_lines"))
    return parsed.select(
        us("event_time"), F.round("latitude", 7).alias("latitude"), F.round("longitude", 7).alias("longitude"),
        "depth_km", "mag", "region", "day",
    )


@query
def html_to_lines(spark, sf):
    return daily_pages.html_lines(table(spark, sf, "pages"), "page_id", "html")


@query
def point_text(spark, sf):
    cod = F.col("cod")
    return spark_input(spark, sf, "feed").select(
        "snapshot", cod,
        geo.point_part(cod, 1).alias("lat"),
        geo.point_part(cod, 2).alias("lon"),
        geo.point_depth_km(cod).alias("depth_km"),
    )


def _felt_columns(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "report_id", us("event_time"), "latitude", "longitude", "depth_km", "mag", "max_intensity",
        "region", "region_en", us("updated_at"), *extra,
    )


@query
def feed_typed(spark, sf):
    return _felt_columns(feed.parse_feed(spark_input(spark, sf, "feed")), "snapshot")


@query
def feed_latest(spark, sf):
    return _felt_columns(revisions.newest_bulletin(feed.parse_feed(spark_input(spark, sf, "feed"))))


@query
def event_keys(spark, sf):
    key = labels.event_key(F.col("event_time"), F.col("latitude"), F.col("longitude"))
    return spark_input(spark, sf, "faulty").select(key.alias("event_key"), "latitude", "longitude", us("event_time"))


# --- One history from two tiers -----------------------------------------------------------------


def _tier_final(spark, sf):
    """Orders up to the end of their last year as the reviewed catalog."""
    jma = spark_input(spark, sf, "jma")
    return jma.select(
        "event_time", "latitude", "longitude", "depth_km", "mag", "mag_type", "max_intensity", "event_type",
        "region", "agency", F.lit("final").alias("status"), F.lit("jma_catalog").alias("source"),
    )


def _tier_daily(spark, sf):
    """Line items a year later as daily rows; the catalog covers the earlier ones."""
    items = table(spark, sf, "lineitem")
    at = F.unix_micros(F.col("l_shipdate").cast("timestamp")) + (366 * 86_400 + (F.col("l_orderkey") * 17) % 86_400) * 1_000_000
    when = F.timestamp_micros(at)
    return items.select(
        when.alias("event_time"),
        ((F.col("l_orderkey") * 31 % 500 + 100).cast("double") / 10).alias("latitude"),
        ((F.col("l_partkey") * 37 % 500 + 1100).cast("double") / 10).alias("longitude"),
        ((F.col("l_suppkey") * 41) % 700).cast("double").alias("depth_km"),
        F.when(F.col("l_partkey") % 7 != 0, ((F.col("l_partkey") * 43) % 70).cast("double") / 10).alias("mag"),
        F.concat(F.lit("area "), (F.col("l_suppkey") % 9).cast("string")).alias("region"),
        F.date_format(times.shift_micros(when, F.lit(times.JST_MICROS)), "yyyyMMdd").alias("day"),
    )


def _history_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", us("event_time"), "latitude", "longitude", "depth_km", "mag", "mag_type", "max_intensity",
        "event_type", "region", "region_en", "agency", "status", "source",
    )


@query
def coverage_cutoff(spark, sf):
    return stitch.coverage_cutoff(_tier_final(spark, sf))


@query
def cell_mode_name(spark, sf):
    cells = neighbours.cell_names(_tier_final(spark, sf))
    return cells.select(big("ci"), big("cj"), "name", "n")


@query
def neighbour_name(spark, sf):
    events = spark_input(spark, sf, "usgs").select("event_id", "latitude", "longitude")
    named = neighbours.name_by_neighbour(events, neighbours.cell_names(_tier_final(spark, sf)))
    return named.select("event_id", "region_en")


@query
def union_by_name(spark, sf):
    final, daily = _tier_final(spark, sf), _tier_daily(spark, sf)
    both = stitch.stitch(final, daily)
    return both.select(us("event_time"), "latitude", "mag", "mag_type", "max_intensity", "agency", "status", "region", "day")


@query
def stitched_history(spark, sf):
    return _history_columns(clean_jma.stitched_history(_tier_final(spark, sf), _tier_daily(spark, sf)))


@query
def one_per_event(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("jma-"), F.col("l_orderkey").cast("string")).alias("event_id"),
        F.when(F.col("l_linestatus") == "F", "final").otherwise("preliminary").alias("status"),
        F.col("l_quantity").alias("mag"),
        F.col("l_partkey").cast("double").alias("depth_km"),
        F.col("l_returnflag").alias("region"),
        F.col("l_suppkey").cast("double").alias("latitude"),
        F.col("l_linenumber").cast("double").alias("longitude"),
    )
    return revisions.one_per_event(rows)


@query
def tier_stitch(spark, sf):
    history = clean_jma.stitched_history(_tier_final(spark, sf), _tier_daily(spark, sf))
    marked = validation.mark_rejects(revisions.one_per_event(history), validation.JMA_RULES)
    return _history_columns(validation.accepted(marked))


# --- Linking --------------------------------------------------------------------------------------


@query
def interval_join(spark, sf):
    a = spark_input(spark, sf, "dense_a").select(F.col("event_id").alias("a_id"), F.col("event_time").alias("a_time"))
    b = spark_input(spark, sf, "dense_b").select(F.col("event_id").alias("b_id"), F.col("event_time").alias("b_time"))
    pairs = proximity.interval_join(a, b, "a_time", "b_time", 16)
    gap = (F.unix_micros("b_time") - F.unix_micros("a_time")).alias("gap_us")
    return pairs.select("a_id", "b_id", gap)


@query
def haversine_pairs(spark, sf):
    a = proximity.slim(spark_input(spark, sf, "usgs"), "a")
    b = proximity.slim(spark_input(spark, sf, "jma"), "b")
    pairs = proximity.close_pairs(a, b, proximity.Tolerance())
    return pairs.select("a_id", "b_id", F.round("dt", 2).alias("dt"), F.round("km", 3).alias("km"))


def _matches(spark, sf):
    return link.link(spark_input(spark, sf, "dense_a"), spark_input(spark, sf, "dense_b"))


@query
def mutual_best_links(spark, sf):
    return _matches(spark, sf).select(
        "jma_event_id", "usgs_event_id", us("jma_event_time"), "time_diff_s", "distance_km", "jma_mag",
        "usgs_mag", "mag_diff", "jma_depth_km", "usgs_depth_km", "score",
    )


@query
def swarm_links(spark, sf):
    """Links where all records stand in two spots, half of them with a steady offset between the agencies."""
    links = nearest.mutual_best(spark_input(spark, sf, "swarm_a"), spark_input(spark, sf, "swarm_b"))
    return links.select("a_id", "b_id", F.round("dt", 2).alias("dt"), F.round("km", 3).alias("km"), F.round("score", 6).alias("score"))


@query
def swarm_pairs(spark, sf):
    """How many pairs those are, none of which is a row."""
    return nearest.count_pairs(spark_input(spark, sf, "swarm_a"), spark_input(spark, sf, "swarm_b"))


@query
def link_summary(spark, sf):
    a, b = spark_input(spark, sf, "dense_a"), spark_input(spark, sf, "dense_b")
    return link.link_summary(a, b, _matches(spark, sf))


@query
def link_by_band(spark, sf):
    # The approximate median is left to its own query; everything else here is exact.
    by_band = analytics.magnitude_comparison(_matches(spark, sf))
    return by_band.select("jma_band", "quakes", "avg_distance_km", "avg_time_diff_s")


@query
def approx_median(spark, sf):
    by_band = analytics.magnitude_comparison(_matches(spark, sf))
    return by_band.select("jma_band", "median_usgs_minus_jma")


# --- Audit -------------------------------------------------------------------------------------------


def _known(spark, sf):
    return spark_input(spark, sf, "known")


# The supplied tables carry fewer columns than a full clean table; the checks are the same.
AUDITED = audit.Dataset(
    name="usgs",
    table="orders",
    schema=audit.USGS.schema,
    required=audit.USGS.required,
    row_checks=audit.USGS.row_checks,
)


@query
def dq_metrics(spark, sf):
    metrics = audit.audit_metrics(spark_input(spark, sf, "faulty"), AUDITED, NOW_ORDERS)
    return metrics.select(
        "rows", "ids", *[f"null_{c}" for c in AUDITED.required],
        *[f"new_{k}" for k in range(len(AUDITED.row_checks))], "future", us("newest"),
    )


@query
def dq_known_issues(spark, sf):
    metrics = audit.audit_metrics(spark_input(spark, sf, "faulty"), AUDITED, NOW_ORDERS, _known(spark, sf))
    return metrics.select(*[f"{kind}_{k}" for kind in ("new", "acked") for k in range(len(AUDITED.row_checks))])


@query
def dq_stale_issues(spark, sf):
    return audit.stale_issues(spark_input(spark, sf, "faulty"), _known(spark, sf), AUDITED).select("check", "event_id")


def _audit_results(spark, sf):
    faulty, known = spark_input(spark, sf, "faulty"), _known(spark, sf)
    metrics = audit.audit_metrics(faulty, AUDITED, NOW_ORDERS, known)
    # Every customer has ten orders: that is the last good row count.
    baseline = table(spark, sf, "customer").count() * 10
    summary = {"raw_rows": baseline, "duplicates_removed": 0, "dropped": {"missing magnitude": baseline // 50}}
    results = audit.table_results(metrics, AUDITED, NOW_ORDERS, AUDITED.thresholds, baseline, summary)
    return results.unionByName(audit.stale_results(audit.stale_issues(faulty, known, AUDITED)))


@query
def dq_results(spark, sf):
    return _audit_results(spark, sf).select("check", "severity", "passed", F.round("value", 6).alias("value"))


@query
def dq_gate(spark, sf):
    blocking = (F.col("severity") == audit.ERROR) & ~F.col("passed")
    return _audit_results(spark, sf).agg(
        (F.count_if(blocking) == 0).alias("published"),
        F.count_if(blocking).alias("errors"),
        F.count_if(~F.col("passed") & (F.col("severity") == audit.WARN)).alias("warnings"),
    )


@query
def dq_results_jma(spark, sf):
    """The whole audit of the Japanese history: its own checks, felt reports and reconciliation."""
    jma, usgs = spark_input(spark, sf, "jma"), spark_input(spark, sf, "usgs")
    results = audit.audit(
        jma, audit.JMA, NOW_ORDERS, spark, felt=spark_input(spark, sf, "felt"), matches=link.link(jma, usgs)
    )
    return results.select("check", "severity", "passed", F.round("value", 6).alias("value"))


@query
def dq_missing_days(spark, sf):
    """Local days without a preliminary event since a month before the first ones."""
    return audit.missing_day_table(spark_input(spark, sf, "jma"), date(1999, 12, 1)).select(
        F.date_format("day", "yyyy-MM-dd").alias("day")
    )


@query
def dq_felt(spark, sf):
    m = audit.felt_metrics(spark_input(spark, sf, "felt"))
    return m.select("rows", "ids", "bad", us("newest"))


@query
def dq_reconcile(spark, sf):
    jma, usgs = spark_input(spark, sf, "jma"), spark_input(spark, sf, "usgs")
    return audit.reconcile_metrics(jma, link.link(jma, usgs))


def _dq(spark, sf):
    return spark_input(spark, sf, "dq").withColumn("ds", F.coalesce("dataset", F.lit("usgs")))


@query
def dq_runs_wide(spark, sf):
    return analytics.dq_runs(_dq(spark, sf)).select(
        "run_id", "dataset", us("run_at"), "published", "errors", "warnings", "row_count",
        "hours_since_newest_event", "failed_checks",
    )


@query
def dq_runs_newest(spark, sf):
    return analytics.newest_dq_runs(_dq(spark, sf)).withColumn("run_at", F.unix_micros("run_at"))


@query
def failed_checks_recent(spark, sf):
    return analytics.failed_checks(_dq(spark, sf), NOW_EVENTS, 20).withColumn("run_at", F.unix_micros("run_at"))


@query
def run_history(spark, sf):
    return gold.run_history(_dq(spark, sf)).drop("run_at")


@query
def latest_checks(spark, sf):
    return gold.latest_checks(_dq(spark, sf))


@query
def run_statuses(spark, sf):
    runs = analytics.dq_runs(_dq(spark, sf))
    return runs.select("run_id", "dataset", labels.run_status(F.col("published"), F.col("warnings")).alias("status"))


@query
def check_statuses(spark, sf):
    checks = _dq(spark, sf).withColumn("status", labels.check_status(F.col("passed"), F.col("severity")))
    rank = labels.status_rank(F.col("status")).cast("bigint").alias("rank")
    return checks.groupBy("ds", "check", "status", rank).agg(F.count("*").alias("n"))


# --- Gold ----------------------------------------------------------------------------------------------


def _usgs(spark, sf):
    return spark_input(spark, sf, "usgs")


MAP_SINCE = NOW_ORDERS - timedelta(days=30)


@query
def summary_counts(spark, sf):
    return gold.summary_counts(_usgs(spark, sf), NOW_ORDERS).withColumn("archive_since", F.col("archive_since").cast("bigint"))


@query
def largest_this_month(spark, sf):
    return gold.largest_this_month(_usgs(spark, sf), datetime(2001, 7, 20, 12, tzinfo=timezone.utc))


@query
def recent_quakes(spark, sf):
    return gold.recent_quakes(_usgs(spark, sf), NOW_ORDERS)


@query
def daily_counts(spark, sf):
    return gold.daily_counts(_usgs(spark, sf), NOW_ORDERS)


@query
def newest_first(spark, sf):
    """The days as a table lists them, newest first."""
    return analytics.newest_first(gold.daily_counts(_usgs(spark, sf), NOW_ORDERS))


@query
def strongest_this_year(spark, sf):
    return gold.strongest_this_year(_usgs(spark, sf), NOW_ORDERS)


@query
def japan_quakes(spark, sf):
    return gold.japan_quakes(spark_input(spark, sf, "jma"), _usgs(spark, sf), NOW_ORDERS)


@query
def japan_totals(spark, sf):
    return gold.japan_totals(spark_input(spark, sf, "jma"), _usgs(spark, sf), NOW_ORDERS)


@query
def japan_fallback(spark, sf):
    return gold.japan_quakes(None, _usgs(spark, sf), NOW_ORDERS)


@query
def newest_felt(spark, sf):
    return gold.japan_felt(spark_input(spark, sf, "felt")).withColumn("time", F.floor(F.col("time") / 1000))


@query
def strongest_shaking(spark, sf):
    ranked = gold.strongest_shaking(spark_input(spark, sf, "felt"), NOW_EVENTS)
    return ranked.withColumn("time", F.floor(F.col("time") / 1000))


@query
def coverage_by_band(spark, sf):
    jma, usgs = spark_input(spark, sf, "jma"), _usgs(spark, sf)
    covered = gold.coverage_by_band(jma, link.link(jma, usgs))
    return covered.select(big("band"), "jma_quakes", "in_usgs", "median_mag_diff")


@query
def coverage_percent(spark, sf):
    jma, usgs = spark_input(spark, sf, "jma"), _usgs(spark, sf)
    shares = analytics.coverage_percent(gold.coverage_by_band(jma, link.link(jma, usgs)))
    return shares.select(big("band"), F.round("percent", 6).alias("percent"))


# --- Analytics --------------------------------------------------------------------------------------------


@query
def per_year(spark, sf):
    return analytics.per_year(_usgs(spark, sf), 1996).withColumn("year", F.col("year").cast("bigint"))


@query
def strongest_near(spark, sf):
    top = analytics.strongest_near(_usgs(spark, sf), 2001)
    return top.select(us("event_time"), us("time_jst"), "mag", "depth_km", "place")


@query
def recent_events(spark, sf):
    return analytics.most_recent(_usgs(spark, sf), 2001).select(us("event_time"), "mag", "place", us("updated_at"))


@query
def per_year_ratio(spark, sf):
    ratio = analytics.per_year_ratio(spark_input(spark, sf, "jma"), _usgs(spark, sf), 1995)
    return ratio.withColumn("year", F.col("year").cast("bigint"))


@query
def shaking_by_text(spark, sf):
    top = analytics.strongest_shaking_by_text(spark_input(spark, sf, "felt"), 2024)
    return top.withColumn("time_jst", F.unix_micros("time_jst"))


@query
def local_clock(spark, sf):
    clock = analytics.local_clock(_usgs(spark, sf))
    return clock.select("event_id", F.date_format("time_local", "yyyy-MM-dd HH:mm:ss").alias("time_local"))


@query
def busiest_day(spark, sf):
    return analytics.busiest_day(gold.daily_counts(_usgs(spark, sf), NOW_ORDERS))


@query
def largest_shown(spark, sf):
    quakes = gold.japan_quakes(spark_input(spark, sf, "jma"), _usgs(spark, sf), NOW_ORDERS)
    return analytics.largest_shown(quakes)


@query
def published_share(spark, sf):
    return analytics.published_share(gold.run_history(_dq(spark, sf)))


# --- Display values ------------------------------------------------------------------------------------------


@query
def mag_depth_bands(spark, sf):
    rows = _usgs(spark, sf).select(
        labels.display_mag_band(F.col("mag")).alias("mag_band"),
        labels.display_depth_band(F.col("depth_km")).alias("depth_band"),
        labels.magnitude_band(F.col("mag"), 6).cast("bigint").alias("capped_band"),
    )
    return rows.groupBy("mag_band", "depth_band", "capped_band").agg(F.count("*").alias("n"))


@query
def shindo_classes(spark, sf):
    rows = spark_input(spark, sf, "felt").select(
        "max_intensity",
        labels.shindo_class(F.col("max_intensity")).alias("shown_as"),
        labels.shindo_rank(F.col("max_intensity")).alias("rank"),
    )
    return rows.groupBy("max_intensity", "shown_as", "rank").agg(F.count("*").alias("n"))


@query
def readable_places(spark, sf):
    """Part names as upper-case catalog names; types, as they are, stay unchanged."""
    parts = table(spark, sf, "part")
    name = F.when(
        F.col("p_partkey") % 3 != 0,
        F.concat(
            F.when(F.col("p_partkey") % 2 == 0, "NE OFF ").otherwise("NEAR "), F.upper("p_name"), F.lit(" PREF")
        ),
    ).otherwise(F.concat(F.lit("near "), F.col("p_name")))
    return parts.select("p_partkey", name.alias("place")).withColumn("shown", labels.readable_place(F.col("place")))


@query
def pacific_longitudes(spark, sf):
    lon = F.col("longitude")
    rows = raw_events.type_events(spark_input(spark, sf, "raw_events")).select(
        lon, geo.pacific_longitude(lon).alias("shifted")
    )
    return rows.groupBy("longitude", "shifted").agg(F.count("*").alias("n"))


@query
def pacific_lines(spark, sf):
    """Embeddings as lines of points whose mean longitude decides the shift."""
    offset = (F.col("vec_id") % 5 - 2) * 40
    rows = table(spark, sf, "embeddings").select(
        "vec_id",
        F.transform(
            _points(180), lambda p: F.struct((p["lon"] + offset).alias("lon"), p["lat"].alias("lat"))
        ).alias("points"),
    )
    return rows.select("vec_id", F.explode(F.transform(geo.pacific_line(F.col("points")), lambda p: p["lon"])).alias("lon"))


def _points(scale: int):
    """Every pair of embedding values as a point."""
    size = F.floor(F.size("embedding") / 2).cast("int")
    return F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.struct(
            F.round(F.col("embedding")[i * 2].cast("double") * scale).alias("lon"),
            F.round(F.col("embedding")[i * 2 + 1].cast("double") * 4).alias("lat"),
        ),
    )


# --- Map layers, windows and incremental selection -------------------------------------------------------------


@query
def line_points(spark, sf):
    merged = lines.merge_steps(spark_input(spark, sf, "steps"), chunk=700)
    return merged.select("boundary", "type", "line_no", "point_no", "lon", "lat")


@query
def line_shapes(spark, sf):
    """Whole lines: their size, ends and extent, in one row each."""
    return lines.line_extents(lines.merge_steps(spark_input(spark, sf, "steps"), chunk=700))


@query
def step_rejects(spark, sf):
    odd = F.col("seq") % 7 == 0
    steps = spark_input(spark, sf, "steps").withColumn("boundary", F.when(~odd, F.col("boundary")))
    return lines.step_rejects(steps.withColumn("seq", F.when(F.col("seq") % 5 != 0, F.col("seq"))))


@query
def ring_clean(spark, sf):
    features = table(spark, sf, "embeddings").select(
        "vec_id", F.array(F.array(_points(3))).alias("polygons")
    )
    polygons = lines.clean_polygons(features, decimals=0)
    points = polygons.select("vec_id", F.posexplode(F.col("rings")[0]).alias("point_no", "p"))
    return points.select("vec_id", big("point_no"), F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat"))


@query
def capped_windows(spark, sf):
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    windows = incremental.capped_windows(events, "ts", WINDOW_CAP)
    return windows.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "n")


@query
def capped_windows_years(spark, sf):
    events = spark_input(spark, sf, "usgs")
    windows = incremental.capped_windows(events, "event_time", WINDOW_CAP)
    return windows.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "n")


@query
def capped_windows_job(spark, sf):
    """Ranges of a job that begins and ends within a year."""
    events = spark_input(spark, sf, "usgs")
    begin, end = datetime(1995, 3, 14, 15), datetime(2000, 10, 2)
    windows = incremental.capped_windows(events, "event_time", WINDOW_CAP, start=begin, end=end)
    return windows.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "n")


@query
def resume_ranges(spark, sf):
    """Planned ranges that were not finished by an earlier, smaller load of the same start."""
    start = F.lit("1995-01-01").alias("job_start")
    usgs = spark_input(spark, sf, "usgs")

    def plan(events):
        return incremental.capped_windows(events, "event_time", WINDOW_CAP).select(
            start, F.unix_micros("window_start").alias("window_start"), F.unix_micros("window_end").alias("window_end"), "n"
        )

    earlier = plan(usgs.where(F.col("event_time") < times.instant(datetime(1998, 1, 1)))).drop("n")
    return incremental.unfinished(plan(usgs), earlier)


MARK = datetime(2000, 6, 1, tzinfo=timezone.utc)


@query
def incremental_rows(spark, sf):
    begin, end = datetime(2000, 5, 1), datetime(2000, 7, 1)
    events = spark_input(spark, sf, "usgs")
    changed = incremental.changed_since(events, MARK, begin, end, min_mag=2.0)
    return changed.select("event_id", us("event_time"), us("updated_at"), "mag")


@query
def next_mark(spark, sf):
    changed = incremental.changed_since(_usgs(spark, sf), MARK, min_mag=2.0)
    return incremental.next_mark(changed).withColumn("max_updated", F.unix_micros("max_updated"))


@query
def days_to_load(spark, sf):
    """Days between the newest event and a later day, from the state the events give."""
    state = table(spark, sf, "events").agg(F.max(F.to_date("ts")).alias("done_until"))
    wanted = calendar.days_to_load(state, date(2024, 2, 20), date(2024, 1, 1))
    loaded = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("have"))
    days = wanted.join(loaded, "day", "left")
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("have", F.lit(0)).alias("have"))


@query
def changed_files(spark, sf):
    """Pages as files: listed now, and as seen before some of them grew."""
    pages = table(spark, sf, "pages")
    listed = pages.select(
        F.col("url").alias("name"), F.length("html").cast("bigint").alias("size"),
        F.when(F.col("page_id") % 5 != 0, F.col("page_id") % 7).alias("last_modified"),
    )
    seen = pages.select(
        F.col("url").alias("name"),
        (F.length("html") + F.when(F.col("page_id") % 3 == 0, 1).otherwise(0)).cast("bigint").alias("size"),
        F.when(F.col("page_id") % 5 != 0, F.col("page_id") % 7).alias("last_modified"),
    )
    return incremental.changed_files(listed, seen)


@query
def snapshot_latest(spark, sf):
    """Newest turn of every conversation, as snapshots of one report."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars"))
    return revisions.latest_by(turns, ["conv_id"], [F.col("turn").desc(), F.col("role"), F.col("n_chars")])


@query
def calendar_days(spark, sf):
    """Orders per day from before the first to after the last, quiet days included."""
    orders = table(spark, sf, "orders")
    counted = calendar.counts_per_day(orders, date(1994, 12, 1), date(2001, 12, 31), F.to_date("o_orderdate"), "orders")
    return counted.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "orders")


@query
def blank_to_null(spark, sf):
    """Text cleaning of document sources and languages with odd spaces around them."""
    docs = table(spark, sf, "documents")
    padded = F.concat(F.lit(" 　"), F.when(F.col("doc_id") % 4 != 0, F.col("source")).otherwise(""), F.lit("  "))
    number = F.concat(F.lit(" "), F.col("n_chars").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".5 ").otherwise("x"))
    return docs.select("doc_id", text.clean_text(padded).alias("source"), big_value(text.to_integer(number)).alias("size"))


def big_value(col):
    return col.cast("bigint")
