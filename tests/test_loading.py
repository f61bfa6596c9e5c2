from datetime import timedelta

import pytest
from samples import catalog_line, iso, raw_event, utc, write_catalog

from seismic_lake.operators.incremental import changed_files
from seismic_lake.plans import loading
from seismic_lake.plans.clean_usgs import RAW
from seismic_lake.sources.catalog import list_catalog_files
from seismic_lake.sources.lake import MissingInput
from seismic_lake.sources.raw_events import read_raw_events
from seismic_lake.vocab import RAW_EVENT_COLUMNS

START = utc(2017, 8, 1)


def source(spark, events):
    rows = [tuple(e[c] for c in RAW_EVENT_COLUMNS) for e in events]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_EVENT_COLUMNS))


def hourly(n, start=START, mag="2.5", prefix="e"):
    times = [iso(start + timedelta(hours=i)) for i in range(n)]
    return [raw_event(id=f"{prefix}{i}", time=t, updated=t, mag=mag) for i, t in enumerate(times)]


def raw(lake):
    return read_raw_events(lake.spark, lake.path(RAW))


def test_a_range_and_then_only_the_changes(lake):
    old = hourly(20)
    state = loading.load_range(lake, source(lake.spark, old), START, START + timedelta(days=2), "r1", utc(2017, 8, 3))
    assert state["max_updated"] == "2017-08-01T19:00:00+00:00" and state["last_run_events"] == 20
    revised = old[0] | {"mag": "3.5", "updated": "2017-08-03T00:00:00.000Z"}
    later = [*old[1:], revised, *hourly(3, START + timedelta(days=1), prefix="new"), *hourly(2, START + timedelta(days=1), "1.5", "small")]
    state = loading.load_changes(lake, source(lake.spark, later), "r2", utc(2017, 8, 4))
    assert state["last_run_events"] == 4 and state["max_updated"] == "2017-08-03T00:00:00+00:00"
    got = raw(lake)
    assert got.count() == 24 and {r["_ingested_at"] for r in got.collect()} == {"r1", "r2"}
    state = loading.load_changes(lake, source(lake.spark, later), "r3", utc(2017, 8, 5))
    assert state["last_run_events"] == 0 and state["max_updated"] == "2017-08-03T00:00:00+00:00"


def test_small_events_are_left_out_and_text_stays_as_it_was(lake):
    events = [*hourly(3, mag="1.9"), raw_event(id="x", time=iso(START), updated="", mag=" 2.40 ", place=" near ")]
    loading.load_range(lake, source(lake.spark, events), START, START + timedelta(days=1), "r1", START)
    [r] = raw(lake).collect()
    assert (r["mag"], r["place"], r["_source"]) == (" 2.40 ", " near ", "usgs")
    assert "max_updated" not in loading.state(lake)


def test_the_same_range_goes_on_where_it_ended(lake):
    events = source(lake.spark, hourly(48))
    assert loading.load_range(lake, events, START, START + timedelta(days=1), "r1", utc(2017, 8, 3))["last_run_events"] == 24
    assert loading.load_range(lake, events, START, START + timedelta(days=2), "r2", utc(2017, 8, 4))["last_run_events"] == 24
    again = loading.load_range(lake, events, START, START + timedelta(days=2), "r3", utc(2017, 8, 5))
    assert again["last_run_id"] == "r2" and raw(lake).count() == 48
    assert loading.load_range(lake, events, START, START + timedelta(days=2), "r4", utc(2017, 8, 6), restart=True)["last_run_events"] == 48


def test_another_start_is_another_job(lake):
    events = source(lake.spark, [*hourly(10, utc(1999, 9, 9), prefix="o"), *hourly(5)])
    end = START + timedelta(days=1)
    loading.load_range(lake, events, START, end, "r1", utc(2017, 8, 3))
    assert loading.load_range(lake, events, utc(1999, 9, 9), end, "r2", utc(2017, 8, 4))["last_run_events"] == 15


def test_changes_need_a_first_load(lake):
    with pytest.raises(MissingInput, match="load a range first"):
        loading.load_changes(lake, source(lake.spark, []), "r", START)


def test_only_new_or_changed_catalog_files_are_loaded(lake):
    from datetime import datetime

    line = catalog_line(datetime(2023, 1, 1, 12), 35.0, 140.0)
    write_catalog(lake, "h2022.zip", [line])
    write_catalog(lake, "h2023.zip", [line])
    folder = lake.path("raw/jma/catalog")
    seen = lake.spark.createDataFrame(list_catalog_files(lake.spark, folder).collect())
    assert changed_files(list_catalog_files(lake.spark, folder), seen).count() == 0
    write_catalog(lake, "h2023.zip", [line, line, line.replace("NE", "SW")])
    write_catalog(lake, "h2024.zip", [line])
    changed = changed_files(list_catalog_files(lake.spark, folder), seen)
    assert sorted(r["name"] for r in changed.collect()) == ["h2023.zip", "h2024.zip"]
