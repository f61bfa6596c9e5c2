from datetime import datetime, timedelta

import pytest
from samples import (
    bulletin,
    catalog_line,
    daily_line,
    iso,
    raw_event,
    rows,
    utc,
    write_catalog,
    write_daily,
    write_feed,
    write_raw,
)

from pyspark.sql import functions as F

from seismic_lake.plans import audit, clean_jma, clean_usgs, link
from seismic_lake.plans.audit import JMA, USGS, Thresholds, audit_and_publish, is_blocking
from seismic_lake.sources.lake import PUBLISHED, Lake, read_dq_history, read_known_issues
from seismic_lake.vocab import USGS_SCHEMA

NOW = utc(2021, 6, 15, 3, 20)  # a day after the sample event
LOOSE = Thresholds(freshness_hours=1e9)


def events(n=4, **fields):
    return [raw_event(id=f"nz{i}", **fields) for i in range(n)]


def build(lake, rows_, build_id="b1", now=NOW):
    write_raw(lake, f"run{build_id}", rows_)
    return clean_usgs.build(lake, build_id, now)


def check(lake, now=NOW, known=None, baseline=None, summary=None, dataset=USGS, **more):
    df = lake.read(dataset.table, event="built")
    newest = lake.newest(dataset.table, "built")
    summary = newest.summary if newest and summary is None else summary
    return audit.audit(df, dataset, now, lake.spark, known=known, baseline=baseline, summary=summary, **more).collect()


def by_name(results):
    return {r["check"]: r for r in results}


def failing(results):
    return [r["check"] for r in results if not r["passed"]]


def known_file(lake, tmp_path, entries):
    path = tmp_path / "known.csv"
    lines = ["check,event_id,reason,acknowledged_on"] + [f'{c},{e},"{r}",2021-06-01' for c, e, r in entries]
    path.write_text("\n".join(lines) + "\n")
    return read_known_issues(lake.spark, str(path), audit.CHECK_NAMES)


def test_a_sound_build_has_fourteen_passing_results(lake):
    build(lake, events())
    results = check(lake)
    named = by_name(results)
    assert failing(results) == [] and len(results) == 14
    assert named["schema matches"]["expected"] == "25 columns"
    assert (named["not empty"]["observed"], named["not empty"]["value"]) == ("4 rows", 4.0)
    assert (named["data is fresh"]["observed"], named["data is fresh"]["value"]) == ("newest event 24.0h old", 24.0)
    assert named["row count did not drop"]["observed"] == "4 rows (first run, baseline set)"


def test_without_a_table_there_is_one_blocking_result(lake):
    [r] = check(lake)
    assert r["check"] == "clean layer exists" and is_blocking(r)


def test_duplicates_nulls_and_bad_values(spark, lake):
    build(lake, events())
    df = lake.read(clean_usgs.TABLE, USGS_SCHEMA, "built")
    broken = {"event_id": F.lit(None).cast("string"), "latitude": F.lit(-91.0), "mag": F.lit(None).cast("double"), "year": F.lit(2020)}
    odd = df.limit(1).withColumns(broken)
    named = by_name(audit.audit(df.union(df).union(odd).union(odd), USGS, NOW, spark).collect())
    assert named["event_id unique"]["value"] == 6 and is_blocking(named["event_id unique"])
    assert named["required fields present"]["observed"] == "{'event_id': 2, 'mag': 2}"
    assert named["required fields present"]["value"] == 4
    # Failing records are counted by distinct id, as acknowledgements are.
    assert named["latitude in range"]["value"] == 1 and named["year partition matches event_time"]["value"] == 1


def test_another_schema_ends_the_audit(spark):
    df = spark.createDataFrame([("x", "1", 2)], "event_id string, mag string, shoe_size int")
    results = audit.audit(df, USGS, NOW, spark).collect()
    assert [(r["check"], is_blocking(r)) for r in results] == [("schema matches", True), ("no unexpected columns", False)]
    assert results[0]["observed"].startswith("missing ['depth_error_km'") and results[0]["observed"].endswith("wrong type ['mag']")
    assert results[1]["observed"] == "['shoe_size']"


def test_times_that_cannot_be(lake):
    soon, later = "2021-06-15T04:20:00.000Z", "2021-06-15T04:20:00.001Z"  # an hour ahead is allowed
    build(lake, [*events(updated=later), raw_event(id="ok", time=soon, updated=later), raw_event(id="no", time=later, updated=later)])
    r = by_name(check(lake))["no events in the future"]
    assert is_blocking(r) and r["value"] == 1


@pytest.mark.parametrize("hours,passes", [(48, True), (49, False)])
def test_age_of_the_newest_event(lake, hours, passes):
    build(lake, events())
    r = by_name(check(lake, NOW + timedelta(hours=hours - 24)))["data is fresh"]
    assert r["passed"] == passes and r["value"] == hours and is_blocking(r) != passes


def test_odd_values_warn_without_blocking(lake):
    build(lake, [*events(), raw_event(id="core", depth="2900"), raw_event(id="early", updated="2021-06-13T00:00:00Z")])
    results = check(lake)
    assert failing(results) == ["depth plausible", "updated_at not before event_time"]
    assert not any(is_blocking(r) for r in results)


@pytest.mark.parametrize("baseline,passes", [(4, True), (3, True), (5, False)])
def test_row_count_against_the_last_good_build(lake, baseline, passes):
    build(lake, events(4))
    r = by_name(check(lake, baseline=baseline))["row count did not drop"]
    assert r["passed"] == passes and r["value"] == pytest.approx(4 / baseline - 1)
    if baseline == 5:
        assert r["observed"] == "4 vs 5 last good run (-20.00%)" and r["expected"] == ">= -1%"


def test_rejection_rate(lake):
    build(lake, [*events(3), *(raw_event(id=f"bad{i}", mag="?") for i in range(5))])
    r = by_name(check(lake))["cleaning rejected few rows"]
    assert is_blocking(r) and r["value"] == pytest.approx(0.625) and r["observed"] == "5 of 8 (62.500%)"
    missing = by_name(check(lake, summary={}))["cleaning rejected few rows"]
    assert not missing["passed"] and not is_blocking(missing)


def test_reviewed_records_are_skipped_and_new_ones_fire(lake, tmp_path):
    build(lake, [*events(), *(raw_event(id=f"core{i}", depth="2900") for i in range(3))])
    known = known_file(lake, tmp_path, [("depth plausible", f"core{i}", "seen, really") for i in range(2)])
    r = by_name(check(lake, known=known))["depth plausible"]
    assert (r["value"], r["passed"], r["observed"]) == (1, False, "1 rows (2 known, acknowledged)")
    # Acknowledged for one check is not acknowledged for another.
    other = known_file(lake, tmp_path, [("latitude in range", f"core{i}", "x") for i in range(3)])
    assert by_name(check(lake, known=other))["depth plausible"]["value"] == 3


def test_reviews_that_no_longer_apply_are_listed(lake, tmp_path):
    build(lake, [*events(), raw_event(id="core", depth="2900")])
    assert failing(check(lake, known=known_file(lake, tmp_path, [("depth plausible", "core", "ok")]))) == []
    entries = [("depth plausible", "core", "ok"), ("depth plausible", "nz1", "fixed"), ("longitude in range", "gone", "x")]
    r = by_name(check(lake, known=known_file(lake, tmp_path, entries)))["known issues still apply"]
    assert (r["passed"], is_blocking(r), r["value"]) == (False, False, 2)
    assert r["observed"] == "no longer failing: gone (longitude in range), nz1 (depth plausible)"


def test_a_review_file_with_mistakes_stops_the_run(lake, tmp_path):
    for entry, message in [(("depth", "x", "y"), "unknown check depth"), (("depth plausible", " ", "y"), "are required"), (("depth plausible", "x", " "), "are required")]:
        with pytest.raises(ValueError, match=message):
            known_file(lake, tmp_path, [("depth plausible", "fine", "ok"), entry])
    assert read_known_issues(lake.spark, str(tmp_path / "none.csv"), audit.CHECK_NAMES).count() == 0


def test_publishing_moves_the_baseline_only_when_nothing_blocks(lake):
    build(lake, events())
    outcome = audit_and_publish(lake, USGS, NOW, "monday")
    assert outcome.published and outcome.failed == []
    assert lake.newest(USGS.table, PUBLISHED).summary == {"row_count": 4}
    report = audit.markdown_report(outcome.results, USGS)
    assert "Data quality (USGS): passed" in report and "| ✅ | not empty | error | 4 rows | > 0 |" in report

    # The next build loses most magnitudes: it is recorded, but readers keep the good one.
    tuesday = NOW + timedelta(hours=20)
    build(lake, [raw_event(id=f"bad{i}", mag="") for i in range(5)], "b2", tuesday)
    outcome = audit_and_publish(lake, USGS, tuesday, "tuesday")
    assert not outcome.published and outcome.failed == ["cleaning rejected few rows"]
    assert lake.newest(USGS.table, PUBLISHED).build_id == "b1"
    assert "FAILED" in audit.markdown_report(outcome.results, USGS)

    # Auditing the same run again replaces its rows.
    audit_and_publish(lake, USGS, tuesday, "tuesday")
    history = read_dq_history(lake.spark, lake.path(audit.HISTORY)).groupBy("run_id", "ds").count().collect()
    assert {tuple(r) for r in history} == {("monday", "usgs", 14), ("tuesday", "usgs", 14)}


# --- The Japanese tables ------------------------------------------------------------------------

JNOW = utc(2019, 1, 6)


def build_jma(lake: Lake, days=(1, 2, 3, 4), level="4", with_usgs=True):
    """A catalog of 2018 with one large and one small event, then days of January 2019."""
    large = datetime(2018, 9, 6, 3, 7, 59)
    lines = [catalog_line(large, 42.69, 142.0, mag=6.7, level="7"), catalog_line(large + timedelta(days=9), 35.0, 140.0, mag=0.9)]
    write_catalog(lake, "h2018.zip", lines)
    for day in days:
        at = datetime(2019, 1, day, 2)
        write_daily(lake, f"2019010{day}", [daily_line(at + timedelta(hours=k), 36.0 + k, 140.0) for k in range(3)])
    write_feed(lake, "20190105T000000Z", [bulletin("f1", "2019-01-05T06:00:00+09:00", maxi=level)])
    clean_jma.build(lake, "j1", JNOW)
    if with_usgs:
        t = iso((large - timedelta(hours=9, seconds=5)).replace(tzinfo=JNOW.tzinfo))
        write_raw(lake, "u", [raw_event(id="us1", time=t, updated=t, latitude="42.7", longitude="141.9", mag="6.6")])
        clean_usgs.build(lake, "u1", JNOW)
        link.build(lake, "m1", JNOW)


def check_jma(lake, now=JNOW, **more):
    felt = lake.read(clean_jma.FELT_TABLE, event="built")
    return by_name(check(lake, now, dataset=JMA, felt=felt, matches=link.read_matches(lake, "built"), **more))


def test_a_sound_history_has_twenty_passing_results(lake):
    build_jma(lake)
    named = check_jma(lake)
    assert failing(named.values()) == [] and len(named) == 20
    assert named["not empty"]["value"] == 14
    assert named["no missing days in daily lists"]["observed"] == "4 days, 2019-01-01 to 2019-01-04"
    assert named["M5+ quakes also in USGS"]["observed"] == "1 of 1 (100.0%)"
    assert named["felt feed is fresh"]["observed"] == "newest felt quake 27.0h old"
    # Lists come days late: 96 hours are allowed.
    assert named["data is fresh"]["value"] == 53.0
    assert check_jma(lake, JNOW + timedelta(hours=43))["data is fresh"]["passed"]
    assert is_blocking(check_jma(lake, JNOW + timedelta(hours=44))["data is fresh"])


@pytest.mark.parametrize("days,text", [((1, 4), "2 missing (2019-01-02, 2019-01-03)"), ((2, 3), "1 missing (2019-01-01)")])
def test_missing_days_count_from_the_end_of_the_catalog(lake, days, text):
    build_jma(lake, days=days, with_usgs=False)
    named = check_jma(lake)
    r = named["no missing days in daily lists"]
    assert is_blocking(r) and r["observed"] == text
    assert "M5+ quakes also in USGS" not in named  # there is no link table


def test_more_than_five_missing_days_are_cut_off(spark):
    days = spark.createDataFrame([(utc(2019, 1, d),) for d in (1, 9)], "event_time timestamp")
    [r] = audit.missing_day_results(days.withColumn("status", F.lit("preliminary")), None).collect()
    assert r["value"] == 7 and r["observed"].endswith("2019-01-06 ...)")


def test_felt_reports(spark, lake):
    build_jma(lake, level="8", with_usgs=False)
    assert is_blocking(check_jma(lake)["felt shindo is a JMA level"])
    [r] = audit.felt_results(spark, None, JNOW).collect()
    assert r["check"] == "felt feed is fresh" and not r["passed"] and not is_blocking(r)


def test_large_events_without_a_link_only_warn(lake):
    build_jma(lake)
    r = by_name(check(lake, JNOW, dataset=JMA, matches=link.read_matches(lake, "built").limit(0)))["M5+ quakes also in USGS"]
    assert (r["passed"], is_blocking(r), r["value"]) == (False, False, 0.0)


def test_reviews_concern_their_own_dataset(lake, tmp_path):
    build_jma(lake, with_usgs=False)
    known = known_file(lake, tmp_path, [("depth plausible", "jma-gone", "x"), ("depth plausible", "nz1", "x")])
    assert check_jma(lake, known=known)["known issues still apply"]["observed"] == "no longer failing: jma-gone (depth plausible)"


def test_datasets_are_published_separately(lake):
    build_jma(lake)
    assert audit_and_publish(lake, JMA, JNOW, "sunday", LOOSE).published
    assert lake.newest(JMA.table).summary == {"row_count": 14} and lake.newest(USGS.table) is None
    assert link.read_matches(lake).count() == 1
    assert [r["report_id"] for r in rows(lake.read(clean_jma.FELT_TABLE))] == ["f1"]
    kept = read_dq_history(lake.spark, lake.path(audit.HISTORY)).select("ds", "run_id").distinct().collect()
    assert [tuple(r) for r in kept] == [("jma", "sunday")]


def test_the_audit_reads_each_table_once(lake):
    build(lake, events())
    df = lake.read(clean_usgs.TABLE, USGS_SCHEMA, "built")
    metrics = audit.audit_metrics(df, USGS, NOW)
    results = audit.table_results(metrics, USGS, NOW, USGS.thresholds, 3, None)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "place" not in plan.split("ReadSchema")[1]
