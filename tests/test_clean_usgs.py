import pytest
from samples import raw_event, rows, utc, write_raw

from seismic_lake.plans import clean_usgs
from seismic_lake.sources.lake import BUILT, MissingInput
from seismic_lake.sources.raw_events import land_raw, read_raw_events
from seismic_lake.vocab import USGS_SCHEMA

NOW = utc(2022, 2, 2)


def build(lake, build_id="b1"):
    return clean_usgs.build(lake, build_id, NOW).summary


def read(lake):
    return rows(lake.read(clean_usgs.TABLE, USGS_SCHEMA, BUILT))


def test_columns_are_renamed_and_typed(lake):
    write_raw(lake, "run7", [raw_event(nst="88", magNst="12.7", rms=" 0.91 ", gap=" ", place="  　Port Vila  ")])
    build(lake)
    [r] = read(lake)
    assert set(r) == {*USGS_SCHEMA.fieldNames(), "year"}
    assert (r["event_id"], r["event_time"], r["year"]) == ("nz100", utc(2021, 6, 14, 3, 20), 2021)
    assert (r["mag"], r["depth_km"], r["rms"], r["nst"], r["mag_nst"]) == (4.4, 33.0, 0.91, 88, 13)
    assert r["gap"] is None and r["network"] is None  # blank text is NULL
    assert (r["place"], r["source"], r["ingested_at"]) == ("Port Vila", "usgs", "run7")


def test_the_newest_update_wins_in_whatever_order_copies_arrive(lake):
    first, second = raw_event(mag="4.4"), raw_event(mag="4.9", updated="2021-06-20T00:00:00.000Z")
    for run, row in (("a", first), ("b", second), ("c", first), ("d", first)):
        write_raw(lake, run, [row])
    summary = build(lake)
    assert [r["mag"] for r in read(lake)] == [4.9]
    assert (summary["raw_rows"], summary["duplicates_removed"]) == (4, 3)


def test_equal_updates_go_to_the_latest_download_and_missing_updates_lose(lake):
    write_raw(lake, "a", [raw_event(id="p", mag="1.0"), raw_event(id="q", mag="5", updated="")])
    write_raw(lake, "b", [raw_event(id="p", mag="2.0"), raw_event(id="q", mag="6")])
    build(lake)
    assert {r["event_id"]: r["mag"] for r in read(lake)} == {"p": 2.0, "q": 6.0}


def test_every_reject_is_charged_to_its_first_reason(lake):
    faults = {
        "no time, no place": dict(time=" ", latitude=""),
        "no longitude": dict(longitude="east"),
        "text magnitude": dict(mag="M4"),
        "suffixed magnitude": dict(mag="4.4f"),
        "too far south": dict(latitude="-90.5"),
        "too far east, huge": dict(longitude="181", mag="11"),
        "huge": dict(mag="10.01"),
        "not a number": dict(mag="nan"),
    }
    write_raw(lake, "r", [raw_event(), raw_event(id="", mag=""), raw_event(id=" ")])
    write_raw(lake, "s", [raw_event(id=name, **fields) for name, fields in faults.items()])
    summary = build(lake)
    assert [r["event_id"] for r in read(lake)] == ["nz100"]
    assert summary["dropped"] == {
        "missing event_id": 2,
        "missing event_time": 1,
        "missing location": 1,
        "missing magnitude": 2,
        "latitude out of range": 1,
        "longitude out of range": 1,
        "magnitude out of range": 2,
    }
    assert summary["raw_rows"] == summary["duplicates_removed"] + sum(summary["dropped"].values()) + summary["clean_rows"]
    listed = clean_usgs.reject_summary(read_raw_events(lake.spark, lake.path("raw/usgs"))).collect()
    assert {r["reject_reason"]: r["rows"] for r in listed} == summary["dropped"]


def test_one_folder_per_utc_year(lake, tmp_path):
    times = {"x": "1906-04-18T13:12:00Z", "y": "2019-12-31T23:59:59Z", "z": "2020-01-01T00:30:00+01:00"}
    write_raw(lake, "r", [raw_event(id=i, time=t) for i, t in times.items()])
    build(lake)
    location = tmp_path / "lake/clean/usgs/builds/b1/outcome=clean"
    assert sorted(p.name for p in location.iterdir()) == ["year=1906", "year=2019"]
    plan = lake.read(clean_usgs.TABLE, USGS_SCHEMA, BUILT).where("year = 1906")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_builds_stand_beside_each_other_until_dropped(lake):
    write_raw(lake, "r1", [raw_event(id="one")])
    build(lake, "b1")
    write_raw(lake, "r2", [raw_event(id="two")])
    clean_usgs.build(lake, "b2", utc(2022, 2, 3))
    assert sorted(r["event_id"] for r in read(lake)) == ["one", "two"]
    assert lake.drop_old_builds(clean_usgs.TABLE, keep=["b2"]) == ["b1"]
    assert len(read(lake)) == 2


def test_nothing_accepted_means_no_table(lake):
    write_raw(lake, "r", [raw_event(mag="")])
    assert build(lake)["clean_rows"] == 0
    assert lake.read(clean_usgs.TABLE, USGS_SCHEMA, BUILT) is None


def test_without_raw_files_the_build_says_so(lake):
    with pytest.raises(MissingInput, match="load the raw layer first"):
        build(lake)


def test_files_that_lack_columns_are_read_with_nulls(lake):
    columns = "id string, time string, latitude double, longitude double, mag double"
    narrow = lake.spark.createDataFrame([("n1", "2024-01-01T00:00:00Z", 1.5, 2.5, 3.5)], columns)
    land_raw(narrow, lake.path("raw/usgs"), "r1", "usgs")
    write_raw(lake, "r2", [raw_event(id="full")])
    assert build(lake)["clean_rows"] == 2
    got = {r["event_id"]: r for r in read(lake)}
    assert got["n1"]["latitude"] == 1.5 and got["n1"]["place"] is None and got["n1"]["source"] == "usgs"
