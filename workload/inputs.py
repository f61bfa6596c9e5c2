"""Earthquake-shaped inputs derived from the supplied tables.

Every input is one projection over a whole table, written once and rendered for both engines, so
a query and its SQL counterpart start from the same rows. Values come from integer arithmetic, and
no row is left out: conditions only choose values (a blank field, a bad coordinate, a revision).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from seismic_lake.session import configure

# Tokens: `a // b` whole division; US(c) epoch microseconds of a timestamp column; AT(x) timestamp
# from epoch microseconds; YMD(c), DAY(c) date text.
_SPARK = [
    (r"\s//\s", " div "),
    (r"\bUS\((\w+)\)", r"unix_micros(CAST(\1 AS TIMESTAMP))"),
    (r"\bAT\(", "timestamp_micros("),
    (r"\bYMD\((\w+)\)", r"date_format(\1, 'yyyyMMdd')"),
    (r"\bDAY\((\w+)\)", r"date_format(\1, 'yyyy-MM-dd')"),
    (r"\bTEXT\b", "STRING"),
]
_DUCK = [
    (r"\bUS\((\w+)\)", r"epoch_us(\1)"),
    (r"\bAT\(", "make_timestamp("),
    (r"\bYMD\((\w+)\)", r"strftime(\1, '%Y%m%d')"),
    (r"\bDAY\((\w+)\)", r"strftime(\1, '%Y-%m-%d')"),
    (r"\bTEXT\b", "VARCHAR"),
]


def _tenths(n: str) -> str:
    """Text of a non-negative number of tenths."""
    return f"(({n}) // 10) || '.' || (({n}) % 10)"


def _signed_tenths(n: str) -> str:
    return f"CASE WHEN ({n}) < 0 THEN '-' ELSE '' END || {_tenths(f'abs({n})')}"


def _double(n: str) -> str:
    return f"CAST({n} AS DOUBLE) / 10"


def _pad(n: str, width: int, fill: str = " ") -> str:
    return f"lpad('' || ({n}), {width}, '{fill}')"


ORDER_US = "(US(o_orderdate) + ((o_orderkey * 7919) % 86400) * 1000000)"
_LAT_TENTHS = "(l_orderkey * 7919) % 1800 - 900"
_LON_TENTHS = "(l_partkey * 104729) % 3600 - 1800"

_BLANK_RAW = {
    c: "''"
    for c in ("gap", "dmin", "rms", "net", "horizontalError", "depthError", "magError", "magNst",
              "locationSource", "magSource")
}

# Orders are events, their line items are downloaded revisions of them.
RAW_EVENTS = {
    "id": "CASE WHEN l_orderkey % 401 = 0 THEN ' ' ELSE 'us' || l_orderkey END",
    "time": "CASE WHEN l_partkey % 509 = 0 THEN '' ELSE DAY(l_shipdate) || 'T'"
    f" || {_pad('l_orderkey % 24', 2, '0')} || ':' || {_pad('l_partkey % 60', 2, '0')} || ':00.250Z' END",
    "updated": "CASE WHEN l_suppkey % 71 = 0 THEN '' ELSE DAY(l_shipdate) || 'T'"
    f" || {_pad('12 + l_linenumber', 2, '0')} || ':00:00.000Z' END",
    "latitude": f"CASE WHEN l_partkey % 101 = 0 THEN '123.4' ELSE ' ' || {_signed_tenths(_LAT_TENTHS)} END",
    "longitude": f"{_signed_tenths(_LON_TENTHS)} || ' '",
    "depth": f"CASE WHEN l_suppkey % 13 = 0 THEN '' ELSE {_tenths('(l_suppkey * 31) % 7000')} END",
    "mag": "CASE WHEN l_partkey % 50 = 0 THEN '' WHEN l_partkey % 77 = 0 THEN 'abc'"
    f" ELSE {_tenths('(l_partkey * 37) % 90')} END",
    "magType": "CASE l_partkey % 4 WHEN 0 THEN 'mb' WHEN 1 THEN 'ml' WHEN 2 THEN ' mww' ELSE ' ' END",
    "nst": "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN '' || l_partkey"
    f" ELSE {_tenths('l_partkey % 1000')} END",
    "place": "CASE WHEN l_suppkey % 19 = 0 THEN '  ' ELSE '  region ' || (l_suppkey % 25) || ' ' END",
    "type": "CASE l_returnflag WHEN 'R' THEN 'explosion' ELSE 'earthquake' END",
    "status": "CASE l_linestatus WHEN 'F' THEN 'reviewed' ELSE 'automatic' END",
    **_BLANK_RAW,
    "_source": "'usgs'",
    "_ingested_at": f"'run' || l_linenumber || {_pad('l_partkey', 9, '0')} || {_pad('l_suppkey', 9, '0')}",
}

_MAG_CODES = (
    "CASE l_partkey % 9 WHEN 0 THEN '  ' WHEN 1 THEN '-' || (l_suppkey % 10) WHEN 2 THEN 'A' || (l_suppkey % 10)"
    " WHEN 3 THEN 'B' || (l_suppkey % 10) WHEN 4 THEN 'C0' WHEN 5 THEN ' ' || (l_suppkey % 10)"
    " WHEN 6 THEN (l_suppkey % 10) || ' ' ELSE " + _pad("(l_partkey * 7 + l_suppkey) % 90", 2) + " END"
)
_LAT_DEG = "(l_orderkey * 31) % 100 - 30"
_LON_DEG = "(l_partkey * 17) % 300 - 120"
_CATALOG_LINE = " || ".join(
    [
        "CASE l_suppkey % 5 WHEN 0 THEN 'U' WHEN 1 THEN 'I' ELSE 'J' END",
        "CASE WHEN l_orderkey % 211 = 0 THEN '20011301' ELSE YMD(l_shipdate) END",
        _pad("l_orderkey % 24", 2, "0"),
        _pad("l_partkey % 60", 2, "0"),
        "CASE WHEN l_partkey % 23 = 0 THEN ' 7  ' ELSE " + _pad("(l_partkey * 97 + l_orderkey) % 6000", 4) + " END",
        "'    '",
        _pad(_LAT_DEG, 3),
        "CASE WHEN l_suppkey % 23 = 0 THEN '19  ' ELSE " + _pad("(l_suppkey * 89) % 6000", 4) + " END",
        "' 0.2'",
        "CASE WHEN l_partkey % 307 = 0 THEN '    ' ELSE " + _pad(_LON_DEG, 4) + " END",
        _pad("(l_orderkey * 53) % 6000", 4),
        "' 0.3'",
        "CASE WHEN l_partkey % 29 = 0 THEN '     ' ELSE " + _pad("(l_partkey * 41) % 70000", 5) + " END",
        "'  *'",
        _MAG_CODES,
        "CASE l_linenumber WHEN 1 THEN 'J' WHEN 2 THEN 'D' WHEN 3 THEN 'v' WHEN 4 THEN 'W' WHEN 5 THEN 'B' ELSE 'X' END",
        "CASE WHEN l_suppkey % 4 = 0 THEN '  ' ELSE " + _pad("(l_suppkey * 11) % 80", 2) + " END",
        "CASE l_linenumber WHEN 1 THEN 'd' WHEN 2 THEN 'S' ELSE ' ' END",
        "'  '",
        "'' || (l_partkey % 7)",
        "CASE l_suppkey % 12 WHEN 0 THEN ' ' WHEN 8 THEN 'A' WHEN 9 THEN 'B' WHEN 10 THEN 'C' WHEN 11 THEN 'D'"
        " ELSE '' || (l_suppkey % 12) END",
        "'   #12'",
        "CASE WHEN l_partkey % 31 = 0 THEN '                        '"
        " ELSE rpad('NE OFF REGION ' || (l_suppkey % 40) || ' PREF', 24, ' ') END",
        "'   .'",
    ]
)
# Every line item as a 96-character catalog record; some are cut short.
CATALOG_LINES = {
    "rec": "l_orderkey * 8 + l_linenumber",
    "line": f"substr({_CATALOG_LINE}, 1, CASE WHEN l_suppkey % 97 = 0 THEN 60 ELSE 96 END)",
}

# Every event as a line of a daily list; 'error' events are headings that are no data lines.
DAILY_LINES = {
    "event_id": "event_id",
    "day": "YMD(ts)",
    "line": "CASE WHEN event_type = 'error' THEN 'date time latitude longitude' ELSE "
    + " || ".join(
        [
            "year(ts)",
            "' ' || " + _pad("month(ts)", 2),
            "' ' || " + _pad("day(ts)", 2),
            "' ' || " + _pad("hour(ts)", 2, "0") + " || ':' || " + _pad("minute(ts)", 2, "0"),
            "' ' || " + _tenths("(event_id * 7) % 600"),
            "' ' || " + _pad("30 + user_id % 15", 2) + " || '°' || " + _tenths("(event_id * 13) % 600"),
            "CASE WHEN user_id % 6 = 0 THEN '''S ' ELSE '''N ' END",
            _pad("120 + user_id % 30", 3) + " || '° ' || " + _tenths("(event_id * 17) % 600"),
            "CASE WHEN user_id % 7 = 0 THEN '''W ' ELSE '''E ' END",
            "CASE WHEN event_id % 9 = 0 THEN '   -' ELSE " + _pad("event_id % 600", 4) + " END",
            "CASE WHEN event_id % 8 = 0 THEN '    -' WHEN event_id % 8 = 1 THEN '  -0.' || (event_id % 10)"
            " ELSE '   ' || " + _tenths("(event_id * 37) % 70") + " END",
            "'　region ' || (user_id % 25) || '  '",
        ]
    )
    + " END",
}

# Every event as a bulletin of the felt feed; a user's events are revisions of one report.
_SHINDO = (
    "CASE event_id % 13 WHEN 0 THEN '' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '4'"
    " WHEN 5 THEN '5-' WHEN 6 THEN '5' WHEN 7 THEN '5+' WHEN 8 THEN '6-' WHEN 9 THEN '6' WHEN 10 THEN '6+'"
    " WHEN 11 THEN '7' ELSE ' 9 ' END"
)
FEED = {
    "eid": "'f' || user_id",
    "at": "DAY(ts) || 'T' || " + _pad("hour(ts)", 2, "0") + " || ':' || " + _pad("minute(ts)", 2, "0") + " || ':00+09:00'",
    "rdt": "CASE WHEN event_id % 37 = 0 THEN '' ELSE DAY(ts) || 'T23:' || " + _pad("event_id % 60", 2, "0")
    + " || ':00+09:00' END",
    "cod": "CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 11 = 1 THEN '+'"
    f" || {_tenths('300 + user_id % 150')} || '+' || {_tenths('1300 + event_id % 200')} || '/'"
    f" ELSE '+' || {_tenths('300 + user_id % 150')} || '+' || {_tenths('1300 + event_id % 200')}"
    " || '-' || ((event_id % 70) * 10000) || '/' END",
    "mag": "CASE event_id % 17 WHEN 0 THEN 'Ｍ不明' WHEN 1 THEN 'NaN' WHEN 2 THEN '' WHEN 3 THEN '1.5d'"
    f" ELSE {_tenths('(event_id * 37) % 90')} END",
    "maxi": _SHINDO,
    "anm": "CASE WHEN user_id % 5 = 0 THEN '' ELSE 'area ' || (user_id % 25) END",
    "en_anm": "CASE WHEN user_id % 3 = 0 THEN '' ELSE 'Area ' || (user_id % 25) END",
    "snapshot": "'run_id=' || YMD(ts) || " + _pad("event_id", 9, "0"),
}

# Every event as a felt report of its own, in clean form.
FELT = {
    "report_id": "'f' || event_id",
    "event_time": "AT(US(ts))",
    "latitude": _double("300 + user_id % 150"),
    "longitude": _double("1300 + event_id % 200"),
    "depth_km": _double("(event_id * 31) % 700"),
    "mag": f"CASE WHEN event_id % 17 = 0 THEN NULL ELSE {_double('(event_id * 37) % 90')} END",
    "max_intensity": f"nullif(trim({_SHINDO}), '')",
    "region": "'area ' || (user_id % 25)",
    "region_en": "CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'Area ' || (user_id % 25) END",
    "updated_at": "AT(US(ts) + 600000000)",
    "year": "CAST(year(ts) AS INT)",
}

# Every order as a clean event of one agency...
USGS = {
    "event_id": "'us' || o_orderkey",
    "event_time": f"AT({ORDER_US})",
    "updated_at": f"AT({ORDER_US} + ((o_orderkey * 13) % 90000) * 1000000)",
    "latitude": _double("100 + (o_orderkey * 7919) % 500"),
    "longitude": _double("1100 + (o_orderkey * 104729) % 500"),
    "depth_km": _double("(o_orderkey * 31) % 7000"),
    "mag": _double("(o_orderkey * 37) % 90"),
    "mag_type": "CASE o_orderkey % 3 WHEN 0 THEN 'mb' WHEN 1 THEN 'mww' ELSE 'ml' END",
    "place": "'near place ' || (o_custkey % 25)",
    "event_type": "CASE o_orderstatus WHEN 'P' THEN 'explosion' ELSE 'earthquake' END",
    "year": "CAST(year(o_orderdate) AS INT)",
}
# ...and, moved a little in time and place, of the other. Some move too far to be linked.
JMA = {
    "event_id": "'jma-' || o_orderkey",
    "event_time": f"AT({ORDER_US} + ((o_orderkey * 7) % 41 - 20) * 1000000)",
    "latitude": _double("100 + (o_orderkey * 7919) % 500 + (o_orderkey * 13) % 15 - 7"),
    "longitude": _double("1100 + (o_orderkey * 104729) % 500 + (o_orderkey * 17) % 15 - 7"),
    "depth_km": _double("(o_orderkey * 29) % 7000"),
    "mag": f"CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE {_double('(o_orderkey * 31) % 90')} END",
    "mag_type": "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE 'Mj' END",
    "max_intensity": "CASE WHEN o_custkey % 3 = 0 THEN '' || (1 + o_custkey % 4) ELSE NULL END",
    "event_type": "CASE o_orderstatus WHEN 'P' THEN 'artificial' ELSE 'earthquake' END",
    "region": "CASE WHEN o_custkey % 3 = 0 THEN 'REGION ' || (o_custkey % 11) ELSE NULL END",
    "region_en": "CASE WHEN o_custkey % 6 = 0 THEN 'Region ' || (o_custkey % 11) ELSE NULL END",
    "agency": "CASE WHEN o_custkey % 5 = 0 THEN 'U' ELSE 'J' END",
    "status": "CASE WHEN year(o_orderdate) >= 2000 THEN 'preliminary' ELSE 'final' END",
    "source": "CASE WHEN year(o_orderdate) >= 2000 THEN 'jma_daily' ELSE 'jma_catalog' END",
    "year": f"CAST(year(AT({ORDER_US} + ((o_orderkey * 7) % 41 - 20) * 1000000)) AS INT)",
}

# A dense pair of agencies for linking: an event every five seconds in a two-degree square.
_DENSE = "1704067200 + event_id * 5"
DENSE_A = {
    "event_id": "'a-' || event_id",
    "event_time": f"AT(({_DENSE}) * 1000000)",
    "latitude": _double("350 + (event_id * 7919) % 20"),
    "longitude": _double("1400 + (event_id * 104729) % 20"),
    "depth_km": _double("event_id % 7000"),
    "mag": _double("(event_id * 37) % 90"),
    "mag_type": "'Mj'",
    "event_type": "CASE event_type WHEN 'signup' THEN 'artificial' ELSE 'earthquake' END",
    "year": "CAST(2024 AS INT)",
}
DENSE_B = {
    "event_id": "'b-' || event_id",
    "event_time": f"AT(({_DENSE} + (event_id * 7) % 41 - 20) * 1000000)",
    "latitude": _double("350 + (event_id * 7919) % 20 + (event_id * 13) % 5 - 2"),
    "longitude": _double("1400 + (event_id * 104729) % 20 + (event_id * 17) % 5 - 2"),
    "depth_km": _double("event_id % 6000"),
    "mag": _double("(event_id * 31) % 90"),
    "mag_type": "'mww'",
    "year": "CAST(2024 AS INT)",
}

# Two swarms of four seconds in a fifth of a degree; in the second one the agencies are 3 s and 20 km apart.
_SWARM_US = "1704067200000000 + (event_id % 2) * 86400000000 + ((event_id * 7919) % 401) * 10000"


def _thousandths(n: str) -> str:
    return f"CAST({n} AS DOUBLE) / CAST(1000 AS DOUBLE)"


SWARM_A = {
    "event_id": "'a-' || event_id",
    "event_time": f"AT({_SWARM_US})",
    "latitude": _thousandths("35000 + (event_id * 104729) % 199"),
    "longitude": _thousandths("140000 + (event_id * 1299709) % 211"),
}
SWARM_B = {
    "event_id": "'b-' || event_id",
    "event_time": f"AT({_SWARM_US} + (event_id % 2) * 3000000 + ((event_id * 7) % 41 - 20) * 10000)",
    "latitude": _thousandths("35000 + (event_id * 104729) % 199 + (event_id % 2) * 180 + (event_id * 13) % 5 - 2"),
    "longitude": _thousandths("140000 + (event_id * 1299709) % 211 + (event_id * 17) % 5 - 2"),
}

# Orders as a clean table with faults for the audit to find.
FAULTY = {
    "event_id": "'us' || (CASE WHEN o_orderkey % 1000 = 9 THEN o_orderkey - 1 ELSE o_orderkey END)",
    "event_time": f"CASE WHEN o_orderkey % 613 = 0 THEN NULL ELSE AT({ORDER_US}) END",
    "updated_at": f"AT({ORDER_US} + ((o_orderkey * 13) % 90000 - 60) * 1000000)",
    "latitude": "CASE WHEN o_orderkey % 1013 = 0 THEN 123.4 ELSE " + _double("100 + (o_orderkey * 7919) % 500") + " END",
    "longitude": "CASE WHEN o_orderkey % 811 = 0 THEN NULL ELSE " + _double("1100 + (o_orderkey * 104729) % 500") + " END",
    "depth_km": _double("(o_orderkey * 31) % 8100"),
    "mag": "CASE WHEN o_orderkey % 503 = 0 THEN NULL ELSE " + _double("(o_orderkey * 37) % 102") + " END",
    "year": "CAST(year(o_orderdate) + (CASE WHEN o_orderkey % 977 = 0 THEN 1 ELSE 0 END) AS INT)",
}
# Reviewed exceptions: one per supplier.
KNOWN = {
    "check": "CASE s_suppkey % 2 WHEN 0 THEN 'depth plausible' ELSE 'magnitude in range' END",
    "event_id": "'us' || (s_suppkey * 13)",
}

# Audit history: events are check results, an hour is a run.
DQ = {
    "run_id": "'r' || YMD(ts) || " + _pad("hour(ts)", 2, "0"),
    "run_at": "AT(US(ts))",
    "check": "CASE event_type WHEN 'view' THEN 'not empty' WHEN 'click' THEN 'data is fresh'"
    " WHEN 'error' THEN 'depth plausible' WHEN 'signup' THEN 'event_id unique' ELSE 'row count did not drop' END",
    "severity": "CASE event_type WHEN 'error' THEN 'warn' ELSE 'error' END",
    "passed": "(event_id * 7) % 29 <> 0",
    "observed": "'' || user_id",
    "expected": "'0'",
    "value": "CAST(floor(value) AS DOUBLE)",
    "dataset": "CASE user_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'usgs' ELSE 'jma' END",
}

# Boundary steps: a user is a boundary, the user's events its steps in order.
_STEP = "((event_id // 500) % 72) * 5 - 180"
STEPS = {
    "boundary": "'B' || user_id",
    "seq": "event_id",
    "step_class": "CASE user_id % 7 WHEN 0 THEN 'SUB' WHEN 1 THEN 'OCB' WHEN 2 THEN 'CCB' WHEN 3 THEN 'OSR'"
    " WHEN 4 THEN (CASE WHEN event_id % 3 = 0 THEN 'CRB' ELSE 'OSR' END) WHEN 5 THEN 'OTF'"
    " ELSE (CASE WHEN event_id % 5 = 0 THEN 'SUB' ELSE 'CTF' END) END",
    "start_lon": f"CAST({_STEP} AS DOUBLE)",
    "start_lat": "CAST(user_id % 60 AS DOUBLE)",
    "end_lon": f"CAST({_STEP} + (CASE WHEN event_id % 19 = 0 THEN 5 WHEN event_id % 23 = 0 THEN 300 ELSE 0 END) AS DOUBLE)",
    "end_lat": "CAST(user_id % 60 AS DOUBLE)",
}

# Name -> (table, columns)
INPUTS: dict[str, tuple[str, dict[str, str]]] = {
    "raw_events": ("lineitem", RAW_EVENTS),
    "catalog_lines": ("lineitem", CATALOG_LINES),
    "daily_lines": ("events", DAILY_LINES),
    "feed": ("events", FEED),
    "felt": ("events", FELT),
    "usgs": ("orders", USGS),
    "jma": ("orders", JMA),
    "dense_a": ("events", DENSE_A),
    "dense_b": ("events", DENSE_B),
    "swarm_a": ("events", SWARM_A),
    "swarm_b": ("events", SWARM_B),
    "faulty": ("orders", FAULTY),
    "known": ("supplier", KNOWN),
    "dq": ("events", DQ),
    "steps": ("events", STEPS),
}


def _render(expression: str, rules: list[tuple[str, str]]) -> str:
    for pattern, replacement in rules:
        expression = re.sub(pattern, replacement, expression)
    return expression


ROWS_OF_A_TASK = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table, dealt out to as many parts as there are cores: its files may be single row groups, which one task reads each.

    By rows, not by bytes: the derived inputs cost far more to make and to work on than the columns they come from.
    A larger table is dealt to more parts, so that what a task sorts and holds does not grow with it; the files
    themselves tell how many rows they have.
    """
    configure(spark)
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.repartition(max(spark.sparkContext.defaultParallelism, -(-rows.count() // ROWS_OF_A_TASK)))


# Columns that cost more to make than a filter on them: Spark moves a filter below a projection and would make them
# a second time there, before the rows are dealt out. It moves none below a generator.
MADE_ONCE = {("catalog_lines", "line")}


def spark_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input as a DataFrame."""
    source, columns = INPUTS[name]
    rows = table(spark, sf_dir, source)
    made = {c: f"explode(array({_render(e, _SPARK)}))" if (name, c) in MADE_ONCE else _render(e, _SPARK) for c, e in columns.items()}
    return rows.selectExpr(*[f"{e} AS `{c}`" for c, e in made.items()])


def duck_input(name: str) -> str:
    """The same projection as a DuckDB subquery."""
    source, columns = INPUTS[name]
    exprs = ", ".join(f'{_render(e, _DUCK)} AS "{c}"' for c, e in columns.items())
    return f"(SELECT {exprs} FROM {source})"
