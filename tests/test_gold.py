import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from samples import JST, bulletin, catalog_line, daily_line, iso, raw_event, utc, write_catalog, write_daily, write_feed, write_raw

from pyspark.sql import functions as F

from seismic_lake.plans import analytics, clean_jma, clean_usgs, gold, gold_files, link, tables
from seismic_lake.plans.audit import HISTORY, USGS, audit_and_publish
from seismic_lake.sources.lake import BUILT, Lake, MissingInput, read_dq_history
from seismic_lake.vocab import DAILY_DAYS, DQ_SCHEMA, MATCH_SCHEMA

NOW = utc(2020, 5, 14, 6)


def quake(ident, age, mag=3.0, at=(10.0, 20.0), **fields):
    """An event ``age`` before now."""
    when = iso(NOW - age)
    place = {"latitude": str(at[0]), "longitude": str(at[1])}
    return raw_event(**({"id": ident, "time": when, "updated": when, "mag": str(mag)} | place | fields))


def days(n):
    return timedelta(days=n)


SENDAI, LIMA = (38.3, 141.6), (-12.1, -77.4)
EVENTS = [
    quake("archive", days(40_000), 8.4),
    quake("december", days(140), 7.7),
    quake("january", days(120), 6.9),
    quake("april", days(31), 6.6, SENDAI),
    quake("map edge", days(30), 2.5, SENDAI),
    quake("below map", days(29), 2.4, SENDAI),
    quake("lima", days(12), 5.8, LIMA, place="off Peru"),
    quake("twin 1", days(9), 4.1),
    quake("twin 2", days(9) - timedelta(minutes=1), 4.1, LIMA),
    quake("week edge", days(7), 2.1),
    quake("yesterday", timedelta(hours=10), 3.3),
    quake("tonight", timedelta(hours=1), 3.6, SENDAI),
]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("gold")))
    write_raw(lake, "x", EVENTS)
    clean_usgs.build(lake, "b1", NOW)
    return lake, gold.build_tables(lake, NOW, BUILT)


def objects(table):
    return [r.asDict() for r in table.rows.collect()]


def test_summary(built):
    s = built[1]["summary"].extras
    assert (s["archive_total"], s["archive_since"], s["last_24h"], s["last_7d"]) == (12, 1910, 2, 3)
    assert (s["largest_this_month"]["id"], s["largest_this_month"]["place"]) == ("lima", "off Peru")


def test_the_map_has_a_month_of_events_from_its_smallest_magnitude(built):
    shown = objects(built[1]["recent_quakes"])
    assert [q["id"] for q in shown] == ["map edge", "lima", "twin 1", "twin 2", "yesterday", "tonight"]
    lima = shown[1]
    assert (lima["lat"], lima["lon"], lima["depth"], lima["mag"]) == (-12.1, -77.4, 33.0, 5.8)
    assert lima["time"] == int((NOW - days(12)).timestamp()) * 1000


def test_daily_counts_leave_out_today_and_keep_quiet_days(built):
    counts = {d["day"]: d["quakes"] for d in objects(built[1]["daily_counts"])}
    assert len(counts) == DAILY_DAYS and min(counts) == "2020-02-14" and max(counts) == "2020-05-13"
    assert (counts["2020-05-05"], counts["2020-05-06"], counts["2020-05-13"]) == (2, 0, 1)
    assert sum(counts.values()) == 8
    [peak] = analytics.busiest_day(built[1]["daily_counts"].rows).collect()
    assert (peak["day"], peak["quakes"]) == ("2020-05-05", 2)
    newest = analytics.newest_first(built[1]["daily_counts"].rows).first()
    assert newest["day"] == "2020-05-13"


def test_strongest_this_year(built):
    t = built[1]["strongest_this_year"]
    ids = [q["id"] for q in objects(t)]
    assert t.extras == {"year": 2020} and len(ids) == 10
    assert ids[:5] == ["january", "april", "lima", "twin 1", "twin 2"]


def test_the_other_agency_stands_in_for_japan(built):
    t = built[1]
    assert [q["id"] for q in objects(t["japan_quakes"])] == ["map edge", "below map", "tonight"]
    assert t["japan_quakes"].extras == {"source": "usgs"}
    assert set(t) == {"summary", "recent_quakes", "daily_counts", "strongest_this_year", "japan_quakes"}


def test_time_limits_prune_partitions(built):
    lake, t = built
    plan = t["recent_quakes"].rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [" in plan and "GreaterThanOrEqual(event_time" in plan


def test_files(built, tmp_path):
    lake, t = built
    counts = gold_files.write(t, lake, NOW, str(tmp_path / "site"))
    assert counts["recent_quakes"] == 6 and lake.spark.read.parquet(lake.path("gold/recent_quakes")).count() == 6

    def page(name):
        [part] = Path(tmp_path / "site" / f"{name}.json").glob("part-*.txt")
        return json.loads(part.read_text())

    summary, daily, quakes = page("summary"), page("daily_counts"), page("recent_quakes")
    assert summary["generated_at"] == "2020-05-14T06:00:00+00:00" and summary["last_7d"] == 3
    assert daily["columns"] == ["day", "quakes"] and len(daily["rows"]) == 90
    assert [d for d, _ in daily["rows"]] == sorted(d for d, _ in daily["rows"])
    assert quakes["columns"] == ["time", "lat", "lon", "depth", "mag", "place", "id"]
    assert [r[-1] for r in quakes["rows"]][-2:] == ["yesterday", "tonight"]


def test_a_document_is_one_text_at_any_size(lake, tmp_path):
    rows = lake.spark.range(0, 3000, 1, 7).select("id", F.concat(F.lit('a "'), F.col("id").cast("string")).alias("name"))
    for name, df in {"many": rows, "none": rows.limit(0)}.items():
        gold_files.write({name: gold.GoldTable(df, {"days": 30})}, lake, NOW, str(tmp_path / "site"))
        [part] = Path(tmp_path / f"site/{name}.json").glob("part-*.txt")
        page = json.loads(part.read_text())
        assert page["rows"] == [[r["id"], r["name"]] for r in df.collect()] and page["days"] == 30


def test_a_set_of_gold_tables_is_of_one_run(lake, tmp_path):
    def tables_of(n):
        return {name: gold.GoldTable(lake.spark.range(n).withColumn("run", F.lit(n)), {}) for name in ("one", "two", "three")}

    def seen():
        return {(name, r["run"]) for name, df in gold_files.read(lake).items() for r in df.select("run").distinct().collect()}

    assert gold_files.read(lake) == {}
    gold_files.write(tables_of(2), lake, NOW, str(tmp_path / "site"))
    old = gold_files.read(lake)  # a reader that looked before the next run
    assert seen() == {("one", 2), ("two", 2), ("three", 2)}
    half = tables_of(3)
    half["three"] = gold.GoldTable(lake.spark.range(1).select(F.raise_error(F.lit("stopped")).alias("run")), {})
    with pytest.raises(Exception, match="stopped"):
        gold_files.write(half, lake, NOW + days(1), str(tmp_path / "site"))
    assert seen() == {("one", 2), ("two", 2), ("three", 2)}
    assert lake.spark.read.parquet(lake.path("gold/one")).count() == 2
    gold_files.write(tables_of(3), lake, NOW + days(2))
    assert seen() == {("one", 3), ("two", 3), ("three", 3)} and old["two"].count() == 2


def test_moving_a_table_to_the_next_build_is_one_change(lake, monkeypatch):
    """Between any two statements a reader sees one build, whole, and years are pruned by folder."""
    spark = lake.spark
    write_raw(lake, "x", [quake(f"a{i}", days(400 * i)) for i in range(3)])
    clean_usgs.build(lake, "one", NOW)
    tables.register(lake, BUILT, "seismic_move")
    write_raw(lake, "y", [quake(f"b{i}", days(400 * i)) for i in range(4)])
    clean_usgs.build(lake, "two", NOW + days(1))
    seen, sql = [], spark.sql

    def watched(text, *args, **more):
        done = sql(text, *args, **more)
        seen.append(sql("SELECT count(*) FROM seismic_move.usgs_events").first()[0])
        return done

    monkeypatch.setattr(spark, "sql", watched)
    tables.register(lake, BUILT, "seismic_move")
    monkeypatch.undo()
    assert set(seen) == {3, 7} and seen == sorted(seen)
    plan = spark.sql("SELECT mag FROM seismic_move.usgs_events WHERE year >= 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    spark.sql("DROP TABLE seismic_move.usgs_events")


def test_no_clean_table_is_an_error(lake):
    with pytest.raises(MissingInput):
        gold.build_tables(lake, NOW)


def test_japan_tables_and_sql(lake):
    spark = lake.spark
    listed = (NOW - days(3) + JST).replace(tzinfo=None)
    big = utc(2018, 4, 9, 16)
    write_catalog(lake, "h2018.zip", [catalog_line((big + JST).replace(tzinfo=None), 35.2, 132.6, mag=6.1, region="W SHIMANE PREF")])
    write_daily(
        lake,
        listed.strftime("%Y%m%d"),
        [
            daily_line(listed, 35.25, 132.65, mag="2.8", region="島根県西部"),
            daily_line(listed + timedelta(minutes=2), 35.25, 132.65, mag="-"),
            daily_line(listed + timedelta(minutes=4), 35.25, 132.65, mag="1.9"),
            daily_line(listed + timedelta(minutes=6), 23.0, 125.0, mag="4.4"),
        ],
    )
    levels = {"old": ("2020-03-30", "7", "6.9"), "weak": ("2020-05-12", "2", "5.9"), "lower": ("2020-05-01", "5-", "5.0"),
              "single": ("2020-05-02", "5", "4.2"), "upper": ("2020-04-20", "5+", "4.0"), "weak small": ("2020-05-13", "2", "Ｍ不明")}
    write_feed(lake, "20200514T000000Z", [bulletin(e, f"{d}T12:00:00+09:00", maxi=s, mag=m) for e, (d, s, m) in levels.items()])
    twin = {"time": iso(big + timedelta(seconds=4)), "updated": iso(big + timedelta(hours=1))}
    write_raw(lake, "x", [quake("list", days(3), 3.0, (35.2, 132.7)), quake("twin", days(0), 5.7, (35.1, 132.5), **twin)])
    clean_jma.build(lake, "j1", NOW)
    clean_usgs.build(lake, "u1", NOW)
    link.build(lake, "m1", NOW)
    t = gold.build_tables(lake, NOW, BUILT)

    j = t["japan_quakes"]
    newest = int((NOW - days(3) + timedelta(minutes=6)).timestamp()) * 1000
    assert j.extras == {"source": "jma", "min_mag": 2.0, "located_total": 3, "usgs_total": 1, "newest": newest}
    [q] = objects(j)
    assert (q["mag"], q["place"]) == (2.8, "W SHIMANE PREF")  # the catalog's name for the cell next door
    assert analytics.largest_shown(j.rows).first()["id"] == q["id"]
    assert [r["id"] for r in objects(t["japan_felt"])] == ["weak small", "weak", "single", "lower", "upper", "old"]
    shaking = t["japan_strongest_shaking"]
    assert [r["id"] for r in objects(shaking)] == ["upper", "single", "lower", "weak", "weak small"]
    assert shaking.extras == {"days": 30}
    coverage = {r["band"]: tuple(r)[1:] for r in t["jma_usgs_coverage"].rows.collect()}
    assert coverage == {1: (1, 0, None), 2: (1, 1, 0.2), 6: (1, 1, -0.4)}
    share = {r["band"]: r["percent"] for r in analytics.coverage_percent(t["jma_usgs_coverage"].rows).collect()}
    assert share == {1: 0.0, 2: 100.0, 6: 100.0}

    # The same tables from SQL, then again after the next build.
    made = tables.register(lake, BUILT, "seismic_test")
    assert set(made) == {f"seismic_test.{n}" for n in tables.TABLES}
    assert spark.sql("SELECT count(*) FROM seismic_test.usgs_events WHERE year >= 2020").first()[0] == 1
    write_raw(lake, "y", [quake("later", days(1), 4.0, (35.0, 133.0))])
    clean_usgs.build(lake, "u2", NOW + days(1))
    tables.register(lake, BUILT, "seismic_test")
    strongest = spark.sql("""
        SELECT mag FROM seismic_test.usgs_events
        WHERE year >= 2010 AND latitude BETWEEN 30 AND 40 AND longitude BETWEEN 130 AND 140 ORDER BY mag DESC LIMIT 20""")
    assert [r["mag"] for r in strongest.collect()] == [5.7, 4.0, 3.0]
    for name in tables.TABLES:
        spark.sql(f"DROP TABLE seismic_test.{name}")


def dq_row(run_id, at, dataset, check, passed, severity="error", value=None):
    return (run_id, at, check, severity, passed, "", "", value, dataset)


def test_run_history_groups_datasets_and_reads_older_files(spark, lake):
    t0 = utc(2020, 5, 13, 22)
    history = lake.path(HISTORY)
    # Before there was a second dataset, files had no dataset column.
    before = spark.createDataFrame([dq_row("a", t0 - days(2), None, "not empty", True, value=70.0)], DQ_SCHEMA)
    before.drop("dataset").write.parquet(f"{history}/dq_a")
    late = t0 + timedelta(minutes=9)
    results = [
        dq_row("b", late, "jma", "data is fresh", False),
        dq_row("b", late, "jma", "not empty", True, value=900.0),
        dq_row("b", t0, "usgs", "not empty", True, value=71.0),
        dq_row("b", t0, "usgs", "data is fresh", True, value=1.5),
        dq_row("b", t0, "usgs", "depth plausible", False, "warn"),
    ]
    spark.createDataFrame(results, DQ_SCHEMA).write.parquet(f"{history}/dq_b")
    write_raw(lake, "x", [quake("q", timedelta(hours=1))])
    clean_usgs.build(lake, "b", NOW)
    t = gold.build_tables(lake, NOW, BUILT)
    first, last = objects(t["pipeline_runs"])
    assert (first["published"], first["row_count"], first["failed_checks"]) == (True, 70.0, "")
    assert (last["published"], last["row_count"], last["hours_since_newest_event"]) == (False, 71.0, 1.5)
    assert (last["errors"], last["warnings"]) == (1, 1)
    assert last["failed_checks"] == "JMA: data is fresh, depth plausible"
    checks = t["latest_checks"].extras["checks"]
    assert [c["check"] for c in checks] == ["data is fresh", "depth plausible", "not empty", "JMA: data is fresh", "JMA: not empty"]
    assert t["latest_checks"].extras["run_at"] == int(t0.timestamp() * 1000)

    dq = read_dq_history(spark, history)
    wide = {(r["run_id"], r["dataset"]): r for r in analytics.dq_runs(dq).collect()}
    assert len(wide) == 3 and wide["b", "usgs"]["published"] and not wide["b", "jma"]["published"]
    assert analytics.newest_dq_runs(dq).count() == 3
    assert analytics.failed_checks(dq, t0, 30).count() == 2 and analytics.failed_checks(dq, t0 + days(31), 30).count() == 0
    share = analytics.published_share(t["pipeline_runs"].rows).first()
    assert (share["published"], share["runs"]) == (1, 2)

    spark.sql("CREATE DATABASE IF NOT EXISTS seismic_dq")
    tables.register_history(spark, history, "seismic_dq")
    assert spark.sql("SELECT * FROM seismic_dq.dq_runs WHERE dataset = 'usgs'").count() == 2
    spark.sql("DROP VIEW seismic_dq.dq_runs")
    spark.sql("DROP TABLE seismic_dq.dq_results")


def test_history_of_a_real_audit(lake):
    write_raw(lake, "x", [quake(f"q{i}", timedelta(hours=i)) for i in range(4)])
    clean_usgs.build(lake, "b", NOW)
    assert audit_and_publish(lake, USGS, NOW, "r1").published
    t = gold.build_tables(lake, NOW)
    [run] = objects(t["pipeline_runs"])
    assert (run["published"], run["errors"], run["warnings"], run["row_count"]) == (True, 0, 0, 4.0)
    assert run["hours_since_newest_event"] == 0.0 and len(t["latest_checks"].extras["checks"]) == 14


def test_adding_a_column_to_an_older_table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS seismic_evolve")
    spark.sql(f"CREATE TABLE seismic_evolve.results (run_id string) USING parquet LOCATION '{tmp_path}/results'")
    spark.sql("INSERT INTO seismic_evolve.results VALUES ('r1')")
    assert tables.add_missing_column(spark, "seismic_evolve.results", "dataset", "string")
    assert not tables.add_missing_column(spark, "seismic_evolve.results", "dataset", "string")
    assert spark.table("seismic_evolve.results").first().asDict() == {"run_id": "r1", "dataset": None}
    spark.sql("DROP TABLE seismic_evolve.results")


def test_queries_over_links_and_felt(spark):
    matches = spark.createDataFrame(
        [("j1", "u1", NOW, 1.0, 10.0, 5.4, "Mj", 5.6, "mww", 0.2, 1.0, 1.0, 0.1),
         ("j2", "u2", NOW, 3.0, 20.0, 5.1, "Mj", 5.0, "mww", -0.1, 1.0, 1.0, 0.1)], MATCH_SCHEMA)
    [r] = analytics.magnitude_comparison(matches).collect()
    assert (r["jma_band"], r["quakes"], r["avg_distance_km"], r["avg_time_diff_s"]) == (5, 2, 15.0, 2.0)
    assert r["median_usgs_minus_jma"] in (-0.1, 0.2)
    felt = spark.createDataFrame([("a", "5+", 2026), ("b", "5-", 2026), ("c", "7", 2020)], "report_id string, max_intensity string, year int")
    felt = felt.withColumns({"event_time": F.timestamp_micros(F.lit(0)), "mag": F.lit(1.0), "region_en": F.lit("x")})
    assert [r["shindo"] for r in analytics.strongest_shaking_by_text(felt, 2026).collect()] == ["5-", "5+"]
