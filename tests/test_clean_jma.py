from datetime import datetime, timedelta

import pytest
from samples import bulletin, catalog_line, daily_line, rows, utc, write_catalog, write_daily, write_feed

from seismic_lake.plans import clean_jma
from seismic_lake.sources import catalog
from seismic_lake.sources.catalog import parse_catalog
from seismic_lake.sources.lake import BUILT, MissingInput
from seismic_lake.vocab import FELT_SCHEMA, JMA_SCHEMA

NOW = utc(2025, 5, 5)
NOON = datetime(2018, 7, 7, 12)  # local time


def build(lake, build_id="b1", now=NOW):
    return clean_jma.build(lake, build_id, now).summary


def read(lake):
    return rows(lake.read(clean_jma.TABLE, JMA_SCHEMA, BUILT))


def read_felt(lake):
    return {r["report_id"]: r for r in rows(lake.read(clean_jma.FELT_TABLE, FELT_SCHEMA, BUILT))}


def parsed(spark, *lines):
    return parse_catalog(spark.createDataFrame([(x,) for x in lines], "line string")).collect()


def test_a_catalog_record(lake):
    at = datetime(2018, 1, 1, 8, 59, 59, 990000)  # still the old year in UTC
    line = catalog_line(at, 34.75, 138.5, depth=21.05, mag=5.1, level="A", region="SURUGA BAY")
    write_catalog(lake, "h2018.zip", [line, line[:67]])
    build(lake)
    [q] = read(lake)
    assert q["event_time"] == utc(2017, 12, 31, 23, 59, 59, 990000) and q["year"] == 2017
    assert (q["latitude"], q["longitude"], q["depth_km"]) == (34.75, 138.5, 21.05)
    assert (q["mag"], q["mag_type"], q["max_intensity"], q["event_type"]) == (5.1, "Mj", "5-", "earthquake")
    assert (q["region"], q["region_en"]) == ("SURUGA BAY", "SURUGA BAY")
    assert (q["agency"], q["status"], q["source"]) == ("J", "final", "jma_catalog")
    assert q["event_id"].startswith("jma-20171231T235959.99-") and len(q["event_id"]) == 27


@pytest.mark.parametrize("tenths", [90, 47, 10, 9, 0, -1, -9, -10, -18, -27, -30])
def test_magnitudes_from_nine_to_minus_three(spark, tenths):
    [r] = parsed(spark, catalog_line(NOON, 35.0, 140.0, mag=tenths / 10))
    assert r["mag"] == pytest.approx(tenths / 10)


def test_the_second_magnitude_stands_in_for_the_first(spark):
    line = catalog_line(NOON, 35.0, 140.0, mag=None)
    [r] = parsed(spark, line[:55] + "62S" + line[58:])
    assert (r["mag"], r["mag_type"]) == (6.2, "Ms")


def test_codes(spark):
    far = catalog_line(NOON, -8.25, -110.5, kind="B", agency="I", klass="5", level="D")
    blast = catalog_line(NOON, 36.0, 140.0, mag=None, klass="3", level="?")
    odd = catalog_line(NOON, 36.0, 140.0, kind="Q", klass="9", level="6", region="")
    f, b, o = parsed(spark, far, blast, odd)
    assert (f["latitude"], f["longitude"], f["mag_type"], f["agency"]) == (-8.25, -110.5, "mb", "I")
    assert (f["event_type"], f["max_intensity"]) == ("low_frequency", "6+")
    assert (b["event_type"], b["mag"], b["mag_type"], b["max_intensity"]) == ("artificial", None, None, None)
    assert (o["event_type"], o["mag_type"], o["max_intensity"], o["region"]) == ("earthquake", None, "6", None)


def test_blank_fractions_are_zero(spark):
    line = catalog_line(datetime(1930, 11, 26, 4, 2, 46), 35.1, 139.05)
    line = line[:15] + "  " + line[17:26] + "  " + line[28:]  # hundredths of seconds and of minutes
    [r] = parsed(spark, line)
    assert r["latitude"] == 35 + 6 / 60 and r["longitude"] == 139.05


def test_local_time_never_has_daylight_saving(lake):
    write_catalog(lake, "h1919.zip", [catalog_line(datetime(1949, 8, 1, 9), 35.0, 139.0)])
    build(lake)
    assert read(lake)[0]["event_time"] == utc(1949, 8, 1, 0)


def test_seconds_roll_over_and_impossible_dates_are_rejected(lake):
    line = catalog_line(NOON, 35.0, 140.0)
    rolled, bad = line[:13] + "6050" + line[17:], line[:5] + "13" + line[7:]
    write_catalog(lake, "h2018.zip", [rolled, bad, bad])
    summary = build(lake)
    [q] = read(lake)
    assert q["event_time"] == utc(2018, 7, 7, 3, 1, 0, 500000)
    assert summary["dropped"] == {"missing event_time": 2} and summary["duplicates_removed"] == 0


def test_daily_lists_and_their_english_names(lake):
    near = [catalog_line(NOON + timedelta(hours=i), 34.65, 138.35, region=r) for i, r in enumerate(["BAY", "BAY", "COAST"])]
    write_catalog(lake, "h2018.zip", near)
    listed = [
        daily_line(datetime(2019, 1, 2, 0, 0, 30, 500000), 34.75, 138.45, depth="8", mag="-0.3"),
        daily_line(datetime(2019, 1, 2, 12), 40.0, 143.0, depth="-", mag="-", region="三陸沖"),
    ]
    write_daily(lake, "20190102", listed, encoding="shift_jis")
    build(lake)
    first, second = read(lake)[-2:]
    assert first["event_time"] == utc(2019, 1, 1, 15, 0, 30, 500000)
    assert (first["latitude"], first["longitude"]) == (pytest.approx(34.75), pytest.approx(138.45))
    assert (first["depth_km"], first["mag"], first["mag_type"]) == (8.0, -0.3, "Mj")
    assert (first["region"], first["region_en"]) == ("駿河湾", "BAY")  # from the cell diagonally below
    assert (first["status"], first["source"], first["agency"]) == ("preliminary", "jma_daily", "J")
    assert (second["depth_km"], second["mag"], second["mag_type"]) == (None, None, None)
    assert (second["region"], second["region_en"]) == ("三陸沖", None)


def test_the_catalog_replaces_the_years_it_covers(lake):
    last = datetime(2018, 12, 31, 22)
    write_catalog(lake, "h2018.zip", [catalog_line(last, 35.0, 140.0)])
    write_daily(lake, "20181231", [daily_line(last, 35.0, 140.0)])
    write_daily(lake, "20190101", [daily_line(last + timedelta(hours=3), 35.0, 140.0)])
    summary = build(lake)
    assert [(q["status"], q["year"]) for q in read(lake)] == [("final", 2018), ("preliminary", 2018)]
    assert summary["catalog_covers_until"] == "20190101"
    assert summary["rows_by_status"] == {"final": 1, "preliminary": 1}


def test_without_a_catalog_every_day_counts(lake):
    write_daily(lake, "20181231", [daily_line(datetime(2018, 12, 31, 22), 35.0, 140.0)])
    assert build(lake)["catalog_covers_until"] == "00000101" and len(read(lake)) == 1


def test_the_same_record_in_two_files_is_one_event(lake):
    lines = [catalog_line(NOON + timedelta(minutes=i), 35.0, 140.0) for i in range(3)]
    write_catalog(lake, "h201801.zip", lines[:2])
    write_catalog(lake, "h201807.zip", lines[1:])
    assert build(lake)["duplicates_removed"] == 1 and len(read(lake)) == 3


def test_felt_reports_keep_the_latest_bulletin(lake):
    write_daily(lake, "20250420", [daily_line(datetime(2025, 4, 20, 1), 35.0, 140.0)])
    day = "2025-04-21T"
    first = [
        bulletin("revised", f"{day}08:00:00+09:00", rdt=f"{day}08:04:00+09:00"),
        bulletin("flash", f"{day}08:10:00+09:00", cod=""),
        bulletin("no level", f"{day}08:10:00+09:00", maxi=" "),
        bulletin("unknown size", f"{day}09:00:00+09:00", mag="Ｍ不明", maxi="6+", cod="+41.2+142.9-600000/"),
        bulletin("bad time", "yesterday"),
        bulletin("no depth", f"{day}10:00:00+09:00", mag=4.5, cod="-41.2+142.9/", en_anm=""),
    ]
    write_feed(lake, "20250421T000000Z", first)
    later = bulletin("revised", f"{day}08:00:00+09:00", rdt=f"{day}11:00:00+09:00", mag="3.9", maxi="3")
    write_feed(lake, "20250422T000000Z", [later, first[0]])
    summary = build(lake)
    felt = read_felt(lake)
    assert set(felt) == {"revised", "unknown size", "no depth"}
    assert (felt["revised"]["mag"], felt["revised"]["max_intensity"], felt["revised"]["depth_km"]) == (3.9, "3", 21.0)
    assert felt["revised"]["event_time"] == utc(2025, 4, 20, 23) and felt["revised"]["region_en"] == "Central Shizuoka"
    assert (felt["unknown size"]["mag"], felt["unknown size"]["depth_km"]) == (None, 600.0)
    assert felt["no depth"]["depth_km"] is None and felt["no depth"]["latitude"] == -41.2
    assert felt["no depth"]["mag"] == 4.5 and felt["no depth"]["region_en"] is None
    assert (summary["felt_rows"], summary["felt_dropped"]) == (3, 1)


def test_missing_raw_files_stop_the_build(lake):
    with pytest.raises(MissingInput, match="catalog or daily"):
        build(lake)


def test_a_republished_file_replaces_the_earlier_rows(lake):
    for build_id, lat in (("b1", 35.0), ("b2", 36.5)):
        write_catalog(lake, "h2018.zip", [catalog_line(NOON, lat, 140.0)])
        build(lake, build_id, NOW + timedelta(days=int(build_id[1])))
    assert [q["latitude"] for q in read(lake)] == [36.5]


def test_lines_of_all_files_are_dealt_out_again(spark, lake):
    lines = [catalog_line(NOON + timedelta(seconds=i), 35.0, 140.0) for i in range(500)]
    write_catalog(lake, "h2017.zip", lines[:1])
    write_catalog(lake, "h2018.zip", lines)
    read_back = catalog.read_catalog_lines(spark, lake.path("raw/jma/catalog"))
    assert "REBALANCE" in read_back._jdf.queryExecution().executedPlan().toString()
    assert read_back.count() == 501
