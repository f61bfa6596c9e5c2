import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from samples import iso, raw_event, utc, write_raw

from pyspark.sql import functions as F

from seismic_lake.functions import times
from seismic_lake.operators import calendar, incremental, lines, neighbours, revisions, validation
from seismic_lake.streaming import revision_log
from seismic_lake.vocab import USGS_SCHEMA

# --- Newest revisions and rejects -----------------------------------------------------------------


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=40))
def test_newest_is_the_maximum_per_key_and_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, a int, b int")
    order = [F.col("a").desc(), F.col("b").desc()]
    once = revisions.latest_by(df, ["k"], order)
    want = {k: max((a, b) for kk, a, b in rows if kk == k) for k, _, _ in rows}
    assert {r["k"]: (r["a"], r["b"]) for r in once.collect()} == want
    assert sorted(map(tuple, revisions.latest_by(once, ["k"], order).collect())) == sorted(map(tuple, once.collect()))


def test_a_hot_key_sends_one_row_per_task(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 10_000).alias("k"), F.col("id").alias("a"))
    newest = revisions.latest_by(df, ["k"], [F.col("a").desc()])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and newest.first()["a"] == 999


def test_each_row_is_charged_once(spark):
    rules = [validation.Rule("a", "x > 5"), validation.Rule("b", "x > 3"), validation.Rule("c", "y IS NULL")]
    df = spark.createDataFrame([(9, None), (4, None), (1, None), (1, 1), (None, 1)], "x int, y int")
    marked = validation.mark_rejects(df, rules)
    assert {r["reject_reason"]: r["rows"] for r in validation.reject_counts(marked).collect()} == {"a": 1, "b": 1, "c": 1}
    assert validation.accepted(marked).count() == 2


# --- Neighbour names ----------------------------------------------------------------------------------


def test_neighbour_lookup_equals_nine_lookups(spark):
    rnd = random.Random(7)
    named = [(rnd.randrange(8) / 10 + 35.05, rnd.randrange(8) / 10 + 140.05, rnd.choice("ABC")) for _ in range(14)]
    rows = [(i, rnd.randrange(14) / 10 + 34.75, rnd.randrange(14) / 10 + 139.75) for i in range(120)]
    cells = neighbours.cell_names(spark.createDataFrame(named, "latitude double, longitude double, region string"))
    got = neighbours.name_by_neighbour(spark.createDataFrame(rows, "i int, latitude double, longitude double"), cells)
    found = {r["i"]: r["region_en"] for r in got.collect()}

    counts: dict = {}
    for la, lo, name in named:
        cell = (int(la * 10 // 1), int(lo * 10 // 1))
        counts.setdefault(cell, {}).setdefault(name, 0)
        counts[cell][name] += 1
    best = {c: min((-n, name) for name, n in v.items()) for c, v in counts.items()}
    for i, la, lo in rows:
        ci, cj = int(la * 10 // 1), int(lo * 10 // 1)
        near = [(abs(a) + abs(b), *best[ci + a, cj + b]) for a in (-1, 0, 1) for b in (-1, 0, 1) if (ci + a, cj + b) in best]
        assert found[i] == (min(near)[2] if near else None)
    assert len(found) == 120 and None in found.values()


# --- Calendars ---------------------------------------------------------------------------------------------


def listed(df):
    return [r["day"] for r in df.orderBy("day").collect()]


def state(spark, done_until):
    return spark.createDataFrame([(done_until,)], "done_until date")


def test_days_to_load(spark):
    start = date(2023, 11, 28)
    first = listed(calendar.days_to_load(state(spark, None), date(2023, 12, 3), start))
    assert first == [date(2023, 11, 28), date(2023, 11, 29), date(2023, 11, 30), date(2023, 12, 1)]
    # Up to date: the last week again. Far behind: everything since. Just begun: not before the start.
    week = listed(calendar.days_to_load(state(spark, date(2023, 12, 30)), date(2024, 1, 2), start))
    assert week == [date(2023, 12, d) for d in range(25, 32)]
    behind = listed(calendar.days_to_load(state(spark, date(2023, 12, 10)), date(2024, 1, 2), start, lookback_days=2))
    assert behind == [date(2023, 12, d) for d in range(11, 32)]
    assert listed(calendar.days_to_load(state(spark, date(2023, 11, 29)), date(2023, 12, 2), start))[0] == start
    assert listed(calendar.days_to_load(state(spark, None), date(2023, 11, 29), start)) == []


def test_missing_days(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (2, 2, 4)], "day date")
    assert listed(calendar.missing_days(days)) == [date(2024, 1, 3)]
    assert listed(calendar.missing_days(days, F.lit(date(2024, 1, 1)))) == [date(2024, 1, 1), date(2024, 1, 3)]
    assert listed(calendar.missing_days(days.limit(0))) == []


# --- Windows and incremental loads ---------------------------------------------------------------------------


@pytest.mark.parametrize("n,gap,cap", [(3000, 190, 400), (300, 0.01, 50), (40, 10**6, 100)])
def test_properties_of_capped_windows(spark, n, gap, cap):
    start = utc(2019, 11, 3, 5)
    us = [times.to_micros(start + timedelta(seconds=i * gap)) for i in range(n)]
    df = spark.createDataFrame([(u,) for u in us], "us bigint").select(F.timestamp_micros("us").alias("t"))
    got = incremental.capped_windows(df, "t", cap).select(F.unix_micros("window_start"), F.unix_micros("window_end"), "n")
    got = sorted(map(tuple, got.collect()))
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:], strict=False))
    for low, high, count in got:
        assert count == sum(low <= u < high for u in us) and (count <= cap or high - low <= 60e6)
        # Not cut further than needed: a whole year, or with its other half above the cap.
        whole = datetime.fromtimestamp(low / 1e6, tz=start.tzinfo)
        size = high - low
        at = low - times.to_micros(datetime(whole.year, 1, 1))
        parent = low - size if round(at / size) % 2 else low
        assert size > 364 * 86_400e6 or sum(parent <= u < parent + 2 * size for u in us) > cap
    assert sum(r[2] for r in got) == n


def test_a_job_window_clips_its_first_and_last_piece(spark):
    # Yearly events over 147 calendar years; the job ends in October of the last.
    df = spark.range(147).select(F.make_timestamp(F.lit(1880) + F.col("id").cast("int"), F.lit(3), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("t"))
    got = incremental.capped_windows(df, "t", 10, start=utc(1880, 2, 1), end=utc(2026, 10, 1)).orderBy("window_start").collect()
    edges = [(r["window_start"].isoformat()[:10], r["window_end"].isoformat()[:10]) for r in got]
    assert len(got) == 147 and edges[0] == ("1880-02-01", "1881-01-01") and edges[-1] == ("2026-01-01", "2026-10-01")
    assert incremental.capped_windows(df, "t", 10, start=utc(1990, 4, 1), end=utc(1990, 6, 1)).count() == 0


def test_large_ranges_are_cut_under_the_cap(spark):
    df = spark.range(50_000).select(F.timestamp_micros(F.lit(times.to_micros(utc(2020, 1, 1))) + F.col("id") * 600_000_000).alias("t"))
    got = incremental.capped_windows(df, "t", 18_000).orderBy("window_start").collect()
    assert len(got) >= 3 and sum(r["n"] for r in got) == 50_000 and max(r["n"] for r in got) <= 18_000
    assert all(a["window_end"] <= b["window_start"] for a, b in zip(got, got[1:], strict=False))


def test_finished_ranges_are_skipped_only_for_the_same_start(spark):
    schema = "job_start string, window_start int, window_end int"
    planned = spark.createDataFrame([("1900", 0, 1), ("1900", 1, 2)], schema)
    assert incremental.unfinished(planned, spark.createDataFrame([("1900", 0, 1)], schema)).count() == 1
    assert incremental.unfinished(planned, spark.createDataFrame([("1950", 0, 1)], schema)).count() == 2


def test_high_water_mark_comes_from_the_data(spark):
    def at(us):
        return F.timestamp_micros(F.lit(us).cast("bigint"))

    mark = datetime(2024, 1, 2)
    us = times.to_micros(mark)
    rows = [(us - 10, us - 1, 3.0), (us - 10, us + 5, 1.0), (us - 10, us + 7, 2.0), (us - 10**13, us + 9, 5.0)]
    df = spark.createDataFrame(rows, "t bigint, u bigint, mag double").select(
        F.timestamp_micros("t").alias("event_time"), F.timestamp_micros("u").alias("updated_at"), "mag"
    )
    changed = incremental.changed_since(df, mark, window_start=mark - timedelta(days=30), min_mag=2.0)
    assert [r["mag"] for r in changed.collect()] == [2.0]
    got = incremental.next_mark(changed, at(us)).select(F.unix_micros("max_updated"), "events").first()
    assert tuple(got) == (us + 7, 1)
    none = incremental.next_mark(changed.limit(0), at(us)).select(F.unix_micros("max_updated"), "events").first()
    assert tuple(none) == (us, 0)


def test_changed_files(spark):
    schema = "name string, size bigint, last_modified string"
    listed_now = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "x"), ("d", 1, "x")], schema)
    seen = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "y")], schema)
    assert sorted(r["name"] for r in incremental.changed_files(listed_now, seen).collect()) == ["c", "d"]


# --- Lines and polygons -----------------------------------------------------------------------------------------

STEP = "boundary string, seq bigint, step_class string, start_lon double, start_lat double, end_lon double, end_lat double"


def random_steps(seed, n=120):
    rnd, out = random.Random(seed), []
    for b in ("AB", "CD"):
        lon = 170.0
        for i in range(n):
            nxt = lon + rnd.choice([0.5, 1.25, 1.25, 300])
            start = lon if rnd.random() < 0.85 else lon + 0.1
            out.append((b, i * 3 + 1, rnd.choice(["SUB", "SUB", "OCB", "CCB"]) if rnd.random() < 0.3 else "SUB", start, 1.0, nxt, 1.0))
            lon = nxt if nxt < 400 else 170.0
    rnd.shuffle(out)
    return out


def drawn(points):
    out = {}
    for r in points.orderBy("boundary", "line_no", "point_no").collect():
        out.setdefault((r["boundary"], r["line_no"]), []).append((r["type"], r["lon"], r["lat"]))
    return out


def test_lines_listed_by_hand(spark):
    steps = [
        ("AB", 1, "SUB", 0.0, 0.0, 1.0, 0.0),
        ("AB", 2, "SUB", 1.0, 0.0, 2.0, 0.001),  # goes on; rounded
        ("AB", 5, "OCB", 2.0, 0.0, 3.0, 0.0),  # another type
        ("AB", 6, "OCB", 3.5, 0.0, 4.0, 0.0),  # starts elsewhere
        ("AB", 7, "OCB", 4.0, 0.0, -179.0, 0.0),  # around the dateline: dropped
        ("AB", 8, "OCB", -179.0, 0.0, -178.0, 0.0),
        ("CD", 1, "SUB", 9.0, 9.0, 8.0, 9.0),
        ("CD", None, "SUB", 8.0, 9.0, 7.0, 9.0),
        (None, 1, "SUB", 8.0, 9.0, 7.0, 9.0),
    ]
    df = spark.createDataFrame(steps, STEP)
    got = [[lon for _, lon, _ in line] for _, line in sorted(drawn(lines.merge_steps(df, chunk=2)).items())]
    assert got == [[0.0, 1.0, 2.0], [2.0, 3.0], [3.5, 4.0], [-179.0, -178.0], [9.0, 8.0]]
    assert tuple(lines.step_rejects(df).first()) == (1, 1)
    [whole] = [r for r in lines.line_extents(lines.merge_steps(df)).collect() if (r["boundary"], r["line_no"]) == ("AB", 1)]
    assert (whole["points"], whole["first_lon"], whole["last_lon"], whole["west"], whole["east"]) == (3, 0.0, 2.0, 0.0, 2.0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_properties_of_merged_steps(spark, seed):
    steps = random_steps(seed)
    df = spark.createDataFrame(steps, STEP)
    by_chunk = [drawn(lines.merge_steps(df, chunk=c)) for c in (7, 50, 100_000)]
    assert by_chunk[0] == by_chunk[1] == by_chunk[2]
    kept = [s for s in steps if abs(round(s[5], 2) - round(s[3], 2)) <= 180]
    pairs = []
    for (boundary, _), line in by_chunk[0].items():
        assert len({kind for kind, _, _ in line}) == 1 and len(line) > 1
        pairs += [(boundary, a[1], b[1]) for a, b in zip(line, line[1:], strict=False)]
    # Every kept step is in exactly one line.
    assert sorted(pairs) == sorted((s[0], round(s[3], 2), round(s[5], 2)) for s in kept)


def test_polygons(spark):
    square = [(0.001, 0.0), (0.0, 0.004), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    sliver = [(0.0, 0.0), (0.001, 0.001), (0.002, 0.002), (1.0, 1.0), (0.0, 0.0)]
    schema = "id int, polygons array<array<array<struct<lon:double,lat:double>>>>"
    df = spark.createDataFrame([(1, [[square, sliver], [sliver]]), (2, [[sliver]]), (3, [])], schema)
    [r] = lines.clean_polygons(df).collect()
    assert (r["id"], r["polygon_no"]) == (1, 0)
    assert [[tuple(p) for p in ring] for ring in r["rings"]] == [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]


# --- Streams ------------------------------------------------------------------------------------------------------


def run_stream(lake):
    q = revision_log.stream_events(lake.spark, lake.path("raw/usgs"), lake.path("log"), lake.path("offsets"))
    q.awaitTermination(120)
    assert q.exception() is None
    return revision_log.current(lake.spark, lake.path("log"), USGS_SCHEMA, ["event_id"], revisions.event_order())


def test_streamed_revisions_equal_a_full_rebuild(lake):
    write_raw(lake, "r1", [raw_event(id="a", mag="1"), raw_event(id="b", mag="2")])
    assert run_stream(lake).count() == 2
    later = iso(utc(2021, 9, 9))
    write_raw(lake, "r2", [raw_event(id="a", mag="5", updated=later), raw_event(id="b", mag="9", updated="2021-01-01T00:00:00Z")])
    write_raw(lake, "r3", [raw_event(id="c", mag="3")])
    got = run_stream(lake)
    assert {r["event_id"]: r["mag"] for r in got.collect()} == {"a": 5.0, "b": 2.0, "c": 3.0}
    from seismic_lake.sources.raw_events import read_raw_events, type_events

    rebuilt = revisions.newest_revision(type_events(read_raw_events(lake.spark, lake.path("raw/usgs"))))
    assert got.exceptAll(rebuilt).isEmpty() and rebuilt.exceptAll(got).isEmpty()


def test_streamed_bulletins(lake):
    from samples import bulletin, write_feed

    from seismic_lake.sources.feed import parse_feed
    from seismic_lake.vocab import FELT_SCHEMA

    order = revisions.bulletin_order()
    write_feed(lake, "1", [bulletin("e1", "2025-04-21T08:00:00+09:00", mag="2.3")])
    write_feed(lake, "2", [bulletin("e1", "2025-04-21T08:00:00+09:00", mag="2.4", rdt="2025-04-21T09:30:00+09:00")])
    q = revision_log.log_revisions(
        revision_log.feed_stream(lake.spark, lake.path("raw/jma/feed"), 1), lake.path("felt_log"), lake.path("felt_offsets"),
        ["report_id"], order, parse_feed,
    )
    q.awaitTermination(120)
    [r] = revision_log.current(lake.spark, lake.path("felt_log"), FELT_SCHEMA, ["report_id"], order, "snapshot string").collect()
    assert r["mag"] == 2.4


def test_ties_and_missing_ids_in_a_stream_are_treated_as_in_a_rebuild(lake):
    from seismic_lake.sources.raw_events import read_raw_events, type_events

    same = {"updated": iso(utc(2021, 9, 9))}
    for run, mags in (("r1", "4 7 5"), ("r2", "3 6")):
        rows = [raw_event(id="a", mag=m, **same) for m in mags.split()] + [raw_event(id="")]
        write_raw(lake, run, rows)
        got = run_stream(lake)
    rebuilt = revisions.newest_revision(type_events(read_raw_events(lake.spark, lake.path("raw/usgs"))))
    assert [r["mag"] for r in got.collect()] == [r["mag"] for r in rebuilt.collect()] == [6.0]
    assert revision_log.rejected(lake.spark, lake.path("log")) == 2


def test_a_new_checkpoint_does_not_overwrite_an_older_log(lake):
    write_raw(lake, "r1", [raw_event(id="a"), raw_event(id="b")])
    run_stream(lake)
    for folder in ("offsets2", "offsets3"):
        revision_log.stream_events(lake.spark, lake.path("raw/usgs"), lake.path("log"), lake.path(folder)).awaitTermination(120)
    assert lake.spark.read.option("recursiveFileLookup", True).parquet(lake.path("log/revisions")).count() == 6
    assert run_stream(lake).count() == 2


def compact_log(lake):
    return revision_log.compact(lake.spark, lake.path("log"), USGS_SCHEMA, ["event_id"], revisions.event_order())


def test_reading_the_log_costs_the_base_and_the_batches_after_it(lake):
    from seismic_lake.sources.raw_events import read_raw_events, type_events

    def files(df):
        return sorted(f.split("/log/")[1].split("/part-")[0] for f in df.inputFiles())

    for n in range(4):
        write_raw(lake, f"r{n}", [raw_event(id=i, mag=str(n), updated=iso(utc(2021, 9, 1 + n))) for i in ("a", f"only{n}")] + [raw_event(id="")])
        got = run_stream(lake)
        if n in (1, 2):
            base = compact_log(lake)
            got = revision_log.current(lake.spark, lake.path("log"), USGS_SCHEMA, ["event_id"], revisions.event_order())
            assert files(got) == [f"base/builds/{base.number}"] and list(base.upto.values()) == [n]
        rebuilt = revisions.newest_revision(type_events(read_raw_events(lake.spark, lake.path("raw/usgs"))))
        assert got.exceptAll(rebuilt).isEmpty() and rebuilt.exceptAll(got).isEmpty()
        assert revision_log.rejected(lake.spark, lake.path("log")) == n + 1
    assert [f.split("/")[0] for f in files(got)] == ["base", "revisions"]  # one open batch, of four
    assert revision_log.drop_folded(lake.spark, lake.path("log")) == 2 * 3 + 1
    after = revision_log.current(lake.spark, lake.path("log"), USGS_SCHEMA, ["event_id"], revisions.event_order())
    assert after.exceptAll(rebuilt).isEmpty() and after.count() == 5


def test_a_folded_batch_that_runs_again_is_not_read_twice(lake):
    write_raw(lake, "r1", [raw_event(id="a", mag="1"), raw_event(id="")])
    run_stream(lake)
    base = compact_log(lake)
    [(query, batch)] = base.upto.items()
    again = lake.spark.read.parquet(f"{base.location}")
    for part, rows in (("revisions", again), ("rejects", lake.spark.range(1).selectExpr("1L AS rejected"))):
        rows.write.mode("overwrite").parquet(lake.path(f"log/{part}/query={query}/batch={batch}"))
    assert revision_log.rejected(lake.spark, lake.path("log")) == 1
    # A batch whose rejects are not written yet is read, but not folded in.
    again.write.parquet(lake.path(f"log/revisions/query={query}/batch={batch + 1}"))
    got = revision_log.current(lake.spark, lake.path("log"), USGS_SCHEMA, ["event_id"], revisions.event_order())
    assert got.count() == 1 and len({f.rsplit("/", 1)[0] for f in got.inputFiles()}) == 2
    assert compact_log(lake).upto == base.upto


def test_an_empty_log_is_an_empty_table(lake):
    assert revision_log.current(lake.spark, lake.path("none"), USGS_SCHEMA, ["event_id"], revisions.event_order()).count() == 0
    assert revision_log.rejected(lake.spark, lake.path("none")) == 0
