import math
import random
from datetime import timedelta

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from samples import utc

from pyspark.sql import functions as F

from seismic_lake.operators import nearest, proximity
from seismic_lake.operators.nearest import mutual_best
from seismic_lake.operators.proximity import interval_join, slim
from seismic_lake.plans.link import link, link_summary

T0 = utc(2016, 4, 15, 16)
COLUMNS = "event_id string, t_us bigint, latitude double, longitude double, depth_km double, mag double, mag_type string, event_type string"


def events(spark, rows):
    """rows: (id, seconds after T0, lat, lon[, mag])"""
    start = int(T0.timestamp()) * 1_000_000
    data = [
        (r[0], start + round(r[1] * 1e6), float(r[2]), float(r[3]), 10.0, float(r[4]) if len(r) > 4 else 4.0, "Mj", "earthquake")
        for r in rows
    ]
    return spark.createDataFrame(data, COLUMNS).withColumn("event_time", F.timestamp_micros("t_us")).drop("t_us")


def km(a, b):
    la, lb = math.radians(a[2]), math.radians(b[2])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(min(1, h)))


def brute_force(left, right, seconds=16, max_km=100):
    scored = []
    for a in left:
        for b in right:
            dt, d = abs(round(a[1] * 1e6) - round(b[1] * 1e6)) / 1e6, km(a, b)
            if dt <= seconds and d <= max_km:
                scored.append((round(dt / seconds + d / max_km, 9), a[0], b[0]))
    best_a, best_b = {}, {}
    for s, a, b in scored:
        best_a[a] = min(best_a.get(a, (9, "")), (s, b))
        best_b[b] = min(best_b.get(b, (9, "")), (s, a))
    return {(a, b) for a, (_, b) in best_a.items() if best_b[b][1] == a}


def found(df):
    return {(r["a_id"], r["b_id"]) for r in df.collect()}


def test_one_event_of_both_agencies(spark):
    j = events(spark, [("jma-1", 0, 33.0, 131.0, 4.7)])
    u = events(spark, [("us1", -6.25, 33.3, 131.0, 4.2)])
    [r] = link(j, u).collect()
    assert (r["jma_event_id"], r["usgs_event_id"], r["time_diff_s"], r["mag_diff"]) == ("jma-1", "us1", 6.25, -0.5)
    assert r["distance_km"] == 33.4 and r["score"] == pytest.approx(6.25 / 16 + 0.3336, abs=1e-4)
    assert r["jma_event_time"] is not None and r["usgs_depth_km"] == 10.0


def test_the_closest_record_is_linked_and_the_other_left_over(spark):
    j = events(spark, [("jma-main", 0, 33.0, 131.0, 6.0), ("jma-after", 12, 33.0, 131.0, 3.0)])
    u = events(spark, [("us1", 9, 33.0, 131.0, 5.9)])
    links = link(j, u)
    assert [(r["jma_event_id"], r["time_diff_s"]) for r in links.collect()] == [("jma-after", 3.0)]
    s = link_summary(j, u, links).first().asDict()
    assert s == {"jma_candidates": 2, "usgs_candidates": 1, "pairs_considered": 2, "matched": 1}


def test_a_best_partner_that_prefers_another_stays_unlinked(spark):
    # b1 is nearest to a2, a2 to b2; a1 would take b1 but b1 does not want it.
    j = events(spark, [("a1", 0, 35, 140), ("a2", 6, 35, 140)])
    u = events(spark, [("b1", 4, 35, 140), ("b2", 7, 35, 140)])
    assert {(r["jma_event_id"], r["usgs_event_id"]) for r in link(j, u).collect()} == {("a2", "b2")}


def test_what_is_never_linked(spark):
    j = [("slow", 0, 33.0, 131.0), ("away", 1000, 33.0, 131.0), ("tiny", 2000, 33.0, 131.0, 1.4), ("south", 3000, 19.9, 131.0)]
    u = [("slow2", 17, 33.0, 131.0), ("away2", 1000, 34.0, 131.0), ("tiny2", 2000, 33.0, 131.0), ("south2", 3000, 19.9, 131.0)]
    assert link(events(spark, j), events(spark, u)).count() == 0


def test_limits_are_inclusive(spark):
    a, b = [("a", 0, 35, 140)], [("b", 16, 35, 140)]
    assert found(mutual_best(events(spark, a), events(spark, b))) == {("a", "b")}
    assert found(mutual_best(events(spark, a), events(spark, [("b", 16.000001, 35, 140)]))) == set()


def swarm(seed, n, seconds, degrees, p):
    rnd = random.Random(seed)
    return [
        (f"{p}{i:04d}", round(rnd.uniform(0, seconds), 2), round(35 + rnd.uniform(0, degrees), 3), round(140 + rnd.uniform(0, degrees), 3))
        for i in range(n)
    ]


@pytest.mark.parametrize("rows", [7, 100, 2000])
@pytest.mark.parametrize("shape", [(200, 600, 4), (200, 30, 1), (150, 3, 0.2)])
def test_matches_brute_force_however_cells_are_dealt(spark, monkeypatch, shape, rows):
    monkeypatch.setattr(proximity.in_blocks, "__defaults__", (rows,))
    n, seconds, degrees = shape
    a, b = swarm(1, n, seconds, degrees, "a"), swarm(2, n, seconds, degrees, "b")
    # Exact copies on both sides, as overlapping downloads would give.
    a += [(f"{r[0]}x", *r[1:]) for r in a[:40]]
    b += [(f"{r[0]}x", *r[1:]) for r in b[:40]]
    got = mutual_best(events(spark, a), events(spark, b))
    assert found(got) == brute_force(a, b)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.sampled_from([0.0, 60.0, 89.5, -89.0]), st.sampled_from([0.0, 179.9, -180.0]))
def test_anywhere_on_the_globe(spark, seed, lat0, lon0):
    rnd = random.Random(seed)

    def side(p):
        return [
            (f"{p}{i}", rnd.uniform(0, 40), min(90, lat0 + rnd.uniform(-0.4, 0.4)), (lon0 + rnd.uniform(-1, 1) + 180) % 360 - 180)
            for i in range(30)
        ]

    a, b = side("a"), side("b")
    assert found(mutual_best(events(spark, a), events(spark, b))) == brute_force(a, b)


def test_links_are_one_to_one(spark):
    a, b = swarm(5, 300, 100, 1, "a"), swarm(6, 300, 100, 1, "b")
    got = mutual_best(events(spark, a), events(spark, b)).collect()
    assert len({r["a_id"] for r in got}) == len({r["b_id"] for r in got}) == len(got)


def test_a_dense_cell_is_dealt_to_groups_of_bounded_size(spark):
    a, b = slim(events(spark, swarm(1, 300, 4, 0.01, "a")), "a"), slim(events(spark, swarm(2, 200, 4, 0.01, "b")), "b")
    left, right = proximity.in_blocks(a.withColumn("k", F.lit(1)), b.withColumn("k", F.lit(1)), ["k"], rows=50)
    met = left.join(right, ["k", "_x", "_y"])
    assert met.count() == 300 * 200 == met.select("a_id", "b_id").distinct().count()
    sizes = [r["n"] for r in left.groupBy("_x", "_y").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 6 * 4 and max(sizes) < 100


def test_a_steady_offset_between_agencies_in_a_swarm(spark):
    a = swarm(1, 120, 4, 0.01, "a")
    b = [(i.replace("a", "b"), t + 3, lat + 0.18, lon) for i, t, lat, lon in a]
    assert found(mutual_best(events(spark, a), events(spark, b))) == brute_force(a, b)


def count_within(left, right):
    return sum(abs(round(a[1] * 1e6) - round(b[1] * 1e6)) <= 16_000_000 and km(a, b) <= 100 for a in left for b in right)


@pytest.mark.parametrize("block,blocks", [(4, 3), (16, 2), (32, 1024)])
@pytest.mark.parametrize("seconds,degrees,offset", [(4, 0.01, 0), (4, 0.3, 3), (40, 2, 0), (2000, 3, 1)])
def test_swarms_however_they_are_cut_into_blocks(spark, monkeypatch, block, blocks, seconds, degrees, offset):
    """Small blocks and groups: a cell is many blocks, and is dealt to several groups."""
    monkeypatch.setattr(nearest, "BLOCK", block)
    monkeypatch.setattr(nearest, "BLOCKS", blocks)
    a, b = swarm(7, 150, seconds, degrees, "a"), swarm(8, 130, seconds, degrees, "b")
    b = [(i, t + offset, lat + offset * 0.06, lon) for i, t, lat, lon in b] + [(f"{r[0]}x", *r[1:]) for r in b[:20]]
    left, right = events(spark, a), events(spark, b)
    assert found(mutual_best(left, right)) == brute_force(a, b)
    assert nearest.count_pairs(left, right).first()["pairs"] == count_within(a, b)


def test_whole_blocks_are_counted_without_their_pairs(spark, monkeypatch):
    """No pair of spots is looked at where all are within reach of each other."""
    looked_at = spark.sparkContext.accumulator(0)
    spot_pairs = nearest._spot_pairs

    def counted(a, b, x, y, tol):
        looked_at.add(len(x))
        return spot_pairs(a, b, x, y, tol)

    monkeypatch.setattr(nearest, "_spot_pairs", counted)
    a, b = events(spark, swarm(1, 2000, 4, 0.01, "a")), events(spark, swarm(2, 1500, 4, 0.01, "b"))
    assert nearest.count_pairs(a, b).first()["pairs"] == 2000 * 1500
    assert looked_at.value == 0
    far = events(spark, swarm(2, 1500, 30, 0.01, "b"))
    assert nearest.count_pairs(a, far).first()["pairs"] == count_within(swarm(1, 2000, 4, 0.01, "a"), swarm(2, 1500, 30, 0.01, "b"))
    assert looked_at.value > 0


def test_a_crowded_cell_is_neither_counted_nor_searched_block_by_block(spark, monkeypatch):
    """Tiles wholly within reach are counted as a product; a tile is searched with its neighbours, not with all others."""
    monkeypatch.setattr(nearest, "BLOCK", 8)
    monkeypatch.setattr(nearest, "BLOCKS", 16)
    met, looked_at = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    search, block_pairs = nearest._search, nearest._block_pairs

    def searched(a, b, *rest):
        met.add(len(a.t0) * len(b.t0))
        return search(a, b, *rest)

    def paired(a, b):
        looked_at.add(len(a.t0) * len(b.t0))
        return block_pairs(a, b)

    monkeypatch.setattr(nearest, "_search", searched)
    monkeypatch.setattr(nearest, "_block_pairs", paired)
    a, b = swarm(1, 3000, 4, 0.2, "a"), swarm(2, 3000, 4, 0.2, "b")
    left, right = events(spark, a), events(spark, b)
    assert found(mutual_best(left, right)) == brute_force(a, b)
    assert 0 < met.value < (3000 / 8) ** 2  # in both directions together; all with all are at least as many
    looked_at.value = 0
    assert nearest.count_pairs(left, right).first()["pairs"] == 3000 * 3000
    assert looked_at.value == 0


def test_a_cell_that_only_one_side_crowds_is_not_gathered(spark, monkeypatch):
    """A swarm on a cell's edge reaches into the next cell, where the other side has nothing: no row holds all its blocks."""
    monkeypatch.setattr(nearest, "BLOCK", 4)
    monkeypatch.setattr(nearest, "BLOCKS", 8)
    gathered, partitions = [], nearest._partitions

    def dealt(df):
        if "block" in df.columns:
            gathered.append(df)
        return partitions(df)

    monkeypatch.setattr(nearest, "_partitions", dealt)
    edge = -(int(T0.timestamp()) % 128)  # seconds after T0 at which a cell begins
    a = [(i, t + edge, lat, lon) for i, t, lat, lon in swarm(1, 400, 4, 0.2, "a")]
    b = [(i, t + edge, lat, lon) for i, t, lat, lon in swarm(2, 400, 4, 0.2, "b")]
    left, right = events(spark, a), events(spark, b)
    assert found(mutual_best(left, right)) == brute_force(a, b)
    assert nearest.count_pairs(left, right).first()["pairs"] == 400 * 400
    assert nearest.count_pairs(left, events(spark, [(i, t + 3600, *at) for i, t, *at in b])).first()["pairs"] == 0
    most = [df.groupBy(*proximity.CELL).count().agg(F.max("count")).first()[0] or 0 for df in gathered]
    assert len(most) == 3 and max(most) <= 2 * 8


def one_spot_blocks(rows):
    columns = list(zip(*[(i, round(t * 1e6), lat, lon) for i, t, lat, lon in rows], strict=True))
    box = {f"{c}{end}": pa.array(v) for c, v in zip(("t", "lat", "lon"), columns[1:], strict=True) for end in (0, 1)}
    spots = {c: pa.array([[x] for x in v]) for c, v in zip(("id", "t", "lat", "lon", "n"), (*columns, [1] * len(rows)), strict=True)}
    return nearest._Side(pa.table({**box, "u": pa.array([nearest.UNBOUNDED] * len(rows)), **spots}))


def test_a_task_looks_at_a_bounded_number_of_pairs_together(monkeypatch):
    """However many blocks meet in one group: the arrays of a task do not grow with a cell."""
    monkeypatch.setattr(nearest, "PAIRS", 500)
    looked_at, kms = [], nearest._km

    def counted(lat, *rest):
        looked_at.append(len(lat))
        return kms(lat, *rest)

    monkeypatch.setattr(nearest, "_km", counted)
    a, b = swarm(1, 300, 30, 1, "a"), swarm(2, 200, 30, 1, "b")
    one, other = one_spot_blocks(a), one_spot_blocks(b)
    best = [r for batch in nearest._search(one, other, proximity.Tolerance()) for r in batch.to_pylist()]
    links = [{(r["id"], r["other"])[:: 1 if of_a else -1] for r in best if r["of_a"] == of_a} for of_a in (True, False)]
    assert links[0] & links[1] == brute_force(a, b)
    reach = nearest._reach(one, other, proximity.Tolerance())
    known = {r["id"]: r["dt"] / 16 + r["km"] / 100 for r in best if r["of_a"]}
    assert all(known[i] <= u + nearest.SLACK for (i, *_), u in zip(a, reach, strict=True) if i in known)
    assert max(looked_at) <= 500


def test_crowded_keys_go_to_a_fixed_number_of_partitions(spark):
    """Groups are few bytes and much work: they are not merged by their bytes, so each task has some."""
    a, b = slim(events(spark, swarm(1, 800, 4, 0.01, "a")), "a"), slim(events(spark, swarm(2, 800, 4, 0.01, "b")), "b")
    left, right = proximity.in_blocks(a.withColumn("k", F.lit(1)), b.withColumn("k", F.lit(1)), ["k"], rows=50)
    met = left.join(right, ["k", "_x", "_y"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(met) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in met) < 2 * 800 * 800 / len(met)


def test_interval_join_equals_the_naive_join(spark):
    a, b = events(spark, swarm(3, 300, 2000, 1, "a")), events(spark, swarm(4, 300, 2000, 1, "b"))
    left = a.select(F.col("event_id").alias("x"), F.col("event_time").alias("tx"))
    right = b.select(F.col("event_id").alias("y"), F.col("event_time").alias("ty"))
    got = interval_join(left, right, "tx", "ty", 16).select("x", "y")
    near = (F.col("ty") >= F.col("tx") - F.expr("interval 16 second")) & (F.col("ty") <= F.col("tx") + F.expr("interval 16 second"))
    naive = left.join(right, near).select("x", "y")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, naive.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_link_needs_both_tables(lake):
    from seismic_lake.plans import link as link_plan
    from seismic_lake.sources.lake import MissingInput

    with pytest.raises(MissingInput):
        link_plan.build(lake, "b", T0 + timedelta(days=1))


def test_a_build_without_links_is_an_empty_table(lake):
    from datetime import datetime

    from samples import catalog_line, raw_event, write_catalog, write_raw

    from seismic_lake.plans import clean_jma, clean_usgs
    from seismic_lake.plans import link as link_plan

    write_catalog(lake, "h2016.zip", [catalog_line(datetime(2016, 4, 16, 1), 33.0, 131.0, mag=5.4)])
    write_raw(lake, "r", [raw_event(latitude="33", longitude="131")])
    clean_jma.build(lake, "j", T0)
    clean_usgs.build(lake, "u", T0)
    built = link_plan.build(lake, "m", T0)
    assert built.summary == {"jma_candidates": 1, "usgs_candidates": 1, "pairs_considered": 0, "matched": 0}
    assert link_plan.read_matches(lake, "built").count() == 0


def test_a_session_is_sized_for_its_input(spark):
    from seismic_lake.session import INITIAL_PARTITIONS, SCAN_BYTES, size_for

    own = spark.newSession()
    usual = own.conf.get(SCAN_BYTES)
    size_for(own, 1 << 30)
    assert (own.conf.get(INITIAL_PARTITIONS), own.conf.get(SCAN_BYTES)) == ("8", usual)
    size_for(own, 100 << 40)
    assert (own.conf.get(INITIAL_PARTITIONS), own.conf.get(SCAN_BYTES)) == ("50000", str((100 << 40) // 100_000))
    size_for(own, 100)
    assert own.conf.get(INITIAL_PARTITIONS) == "50000" and spark.conf.get(INITIAL_PARTITIONS, None) is None
