import math

import pytest
from samples import daily_line, daily_page, utc

from pyspark.sql import functions as F

from seismic_lake.functions import fixed_width, geo, labels, text, times
from seismic_lake.sources.daily_pages import decode_page, html_lines, page_text, parse_daily
from seismic_lake.vocab import JAPAN_BOX, SHINDO_ORDER


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value,number",
    [("3.2", 3.2), (" -1e2 ", -100.0), ("", None), ("  ", None), ("abc", None), ("1.5d", None), ("2f", None), ("0x10", None),
     ("1_000", None), ("+.5", 0.5), ("5.", 5.0), ("　7　", 7.0), (None, None)],
)
def test_numbers(spark, value, number):
    assert one(spark, value, "string", text.to_number) == number


def test_nan_and_infinity_stay_numbers_for_the_range_checks(spark):
    assert math.isnan(one(spark, "NaN", "string", text.to_number)) and one(spark, "-inf", "string", text.to_number) == -math.inf
    assert one(spark, "inf", "string", text.to_integer) is None


@pytest.mark.parametrize("value,whole", [("12", 12), ("12.7", 13), ("12.5", 13), ("-12.5", -13), ("3000000000", None), ("x", None)])
def test_integers_round_half_away_from_zero(spark, value, whole):
    assert one(spark, value, "string", text.to_integer) == whole


@pytest.mark.parametrize(
    "value,moment",
    [("2024-03-05T10:00:00.250Z", utc(2024, 3, 5, 10, 0, 0, 250000)), ("2026-10-11T15:49:00+09:00", utc(2026, 10, 11, 6, 49)),
     ("2024-03-05", utc(2024, 3, 5)), ("10:00", None), ("2024", None), ("", None), ("2024-13-01T00:00:00Z", None)],
)
def test_timestamps(spark, value, moment):
    micros = one(spark, value, "string", lambda c: F.unix_micros(text.to_timestamp(c)))
    assert micros == (None if moment is None else times.to_micros(moment))


@pytest.mark.parametrize(
    "field,value",
    [("1234", 12.34), ("  12", 0.12), ("12  ", 12.0), ("5 5 ", 5.05), ("    ", None), ("-312", -3.12), ("x1 2", 0.02)],
)
def test_implied_decimals(spark, field, value):
    got = one(spark, field, "string", lambda c: fixed_width.implied_decimal(c, 1, 4, 2))
    assert got == (pytest.approx(value) if value is not None else None)


def test_implied_decimals_of_no_line_and_of_minus_zero(spark):
    lines = spark.createDataFrame([(0, None), (1, "-0 0"), (2, "12"), (3, "1")], "n int, line string").orderBy("n")
    got = [r[0] for r in lines.select(fixed_width.implied_decimal(F.col("line"), 1, 4, 2)).collect()]
    assert got == [None, 0.0, 12.0, 1.0] and str(got[1]) == "-0.0"


@pytest.mark.parametrize("code,mag", [("45", 4.5), (" 5", 0.5), ("-1", -0.1), ("A0", -1.0), ("B5", -2.5), ("C0", -3.0), ("  ", None), ("4 ", None)])
def test_coded_magnitudes(spark, code, mag):
    assert one(spark, code, "string", lambda c: fixed_width.coded_magnitude(c, 1)) == mag


def test_distance_and_boxes(spark):
    def km(a, b):
        cols = [F.lit(float(x)) for x in (*a, *b)]
        return spark.range(1).select(geo.great_circle_km(*cols)).first()[0]

    assert km((0, 0), (0, 180)) == pytest.approx(6371 * math.pi)
    assert km((35, 140), (35, 140)) == 0 and km((0, 0), (1, 0)) == pytest.approx(111.1949, abs=1e-3)
    df = spark.createDataFrame([(24.0, 122.0), (46.0, 150.0), (46.1, 150.0), (None, 130.0)], "latitude double, longitude double")
    assert df.where(geo.in_box(JAPAN_BOX)).count() == 2


@pytest.mark.parametrize(
    "value,parts", [("+34.8+138.6-21000/", (34.8, 138.6, 21.0)), ("-5+100/", (-5.0, 100.0, None)), ("+34.8+138.6-21000", (None,) * 3), ("", (None,) * 3)]
)
def test_points(spark, value, parts):
    df = spark.createDataFrame([(value,)], "v string").select(
        geo.point_part(F.col("v"), 1), geo.point_part(F.col("v"), 2), geo.point_depth_km(F.col("v"))
    )
    assert tuple(df.first()) == parts


def test_event_keys_before_1970_and_without_place(spark):
    def key(us, lat, lon):
        cols = [F.timestamp_micros(F.lit(us).cast("bigint")), F.lit(lat).cast("double"), F.lit(lon).cast("double")]
        return spark.range(1).select(labels.event_key(*cols)).first()[0]

    assert key(0, 35, 139).startswith("jma-19700101T000000.00-")
    assert key(-740_000, 35, 139).startswith("jma-19691231T235959.26-")
    assert key(-740_000, 35, 139) != key(-740_000, 35.01, 139)
    assert key(None, 35, 139) is None and key(0, None, 139) is None and key(0, 35, None) is None


def test_bands_levels_and_status(spark):
    df = spark.createDataFrame([(2.9, 29.9), (3.0, 30.0), (6.5, 300.0), (None, None)], "m double, d double")
    got = df.select(labels.display_mag_band(F.col("m")), labels.display_depth_band(F.col("d")), labels.magnitude_band(F.col("m"), 6)).collect()
    assert [tuple(r) for r in got] == [("Below 3", "0–30 km", 2), ("3–4", "30–70 km", 3), ("6+", "300+ km", 6), (None, None, None)]
    levels = spark.createDataFrame([(s,) for s in [*SHINDO_ORDER, "9", None]], "s string")
    ranks = [r[0] for r in levels.select(labels.shindo_rank(F.col("s"))).collect()]
    assert ranks == [*range(1, 12), None, None]
    shown = {r[0]: r[1] for r in levels.select("s", labels.shindo_class(F.col("s"))).collect()}
    assert (shown["4"], shown["5-"], shown["6"], shown["7"]) == ("normal", "strong", "severe", "severe")


@pytest.mark.parametrize(
    "place,shown",
    [("SW OFF SADO IS", "SW off Sado Is."), ("FAR OFF IZU PEN", "Far off Izu Pen."), ("OFF  TOKAI REG", "Off Tokai Region"),
     ("Off Tokai", "Off Tokai"), ("駿河湾", "駿河湾"), ("12.5", "12.5"), (None, None), ("PREF X", "Pref. X")],
)
def test_readable_places(spark, place, shown):
    assert one(spark, place, "string", labels.readable_place) == shown


def test_pacific_longitudes(spark):
    got = spark.createDataFrame([(-31.0,), (-30.0,), (150.0,)], "v double").select(geo.pacific_longitude(F.col("v")))
    assert [r[0] for r in got.collect()] == [329.0, -30.0, 150.0]
    line = spark.createDataFrame([([(-179.0, 1.0), (179.0, 2.0)],), ([(-100.0, 1.0), (20.0, 2.0)],)], "p array<struct<lon:double,lat:double>>")
    lons = [[p["lon"] for p in r[0]] for r in line.select(geo.pacific_line(F.col("p"))).collect()]
    assert lons == [[-179.0, 179.0], [260.0, 380.0]]


# --- Pages -----------------------------------------------------------------------------------


def test_page_charsets():
    assert "一覧表" in decode_page(daily_page(["x"], "shift_jis"))
    for head, encoding in [("", "utf-8"), ("", "cp932"), ("<meta charset=klingon>", "utf-8"), ("<meta charset='utf-8'>", "cp932")]:
        assert "駿河湾" in decode_page(f"{head}<p>駿河湾</p>".encode(encoding))


def test_tags_end_lines_and_entities_are_text():
    assert page_text("<p>a<br>b &amp; c</p>&copy;d") == "\na\nb & c\n©d"


def test_daily_lines(spark):
    from datetime import datetime

    good = daily_line(datetime(2019, 1, 1, 0, 0, 4, 500000), 34.75, 138.45, depth="36", mag="-0.4")
    south = good.replace("'N ", "'S ").replace("'E ", "'W ").replace(" 36 ", " - ")
    wide = good.replace(" ", "   ").replace("駿河湾", "\u3000駿河湾\u3000").replace("   ", "\u00a0 ", 3)
    bad_date = good.replace("2019 1 1", "2019 13 1")
    lines = [good, south, wide, "日時 位置", "", good + " x", bad_date, good.replace("34°", "34 ")]
    df = spark.createDataFrame([("20190101", x) for x in lines], "day string, line string")
    got = parse_daily(df).withColumn("us", F.unix_micros("event_time")).collect()
    assert len(got) == 5
    first = got[0]
    assert first["us"] == times.to_micros(utc(2018, 12, 31, 15, 0, 4, 500000))
    assert first["latitude"] == pytest.approx(34.75) and (first["depth_km"], first["mag"]) == (36.0, -0.4)
    assert got[1]["latitude"] < 0 and got[1]["longitude"] < 0 and got[1]["depth_km"] is None
    assert got[2]["region"] == "駿河湾" and got[3]["region"] == "駿河湾 x" and got[4]["us"] is None


def test_html_lines_of_a_table(spark):
    df = spark.createDataFrame([(1, "<p>a</p><p>b</p>"), (2, None), (3, "")], "id bigint, html string")
    got = html_lines(df, "id", "html").orderBy("id", "line_no").collect()
    assert [tuple(r) for r in got] == [(1, 1, ""), (1, 2, "a"), (1, 3, ""), (1, 4, "b")]


def test_lines_end_where_python_ends_them(spark):
    texts = ["", "\n", "a", "a\n", "a\r\n\n", "a\rb\u2028c\x0bd\x85e\x1cf", "\r\na\n\n\n", None, "<p></p>"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, html string")
    got = {}
    for r in html_lines(df, "id", "html").orderBy("id", "line_no").collect():
        got.setdefault(r["id"], []).append(r["line"])
    assert got == {i: page_text(t or "").splitlines() for i, t in enumerate(texts) if page_text(t or "").splitlines()}
