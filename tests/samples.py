"""Small hand-made raw files in the formats the sources publish."""

from __future__ import annotations

import gzip
import json
import zipfile
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import functions as F

from seismic_lake.vocab import RAW_EVENT_COLUMNS, RAW_EVENT_SCHEMA

JST = timedelta(hours=9)


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def iso(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S.") + f"{moment.microsecond // 1000:03d}Z"


def raw_event(**fields: str) -> dict[str, str]:
    """A text row as downloaded; columns not given are blank."""
    known = {
        "id": "nz100", "time": "2021-06-14T03:20:00.000Z", "updated": "2021-06-14T04:00:00.000Z",
        "latitude": "-17.25", "longitude": "168.5", "depth": "33", "mag": "4.4", "magType": "mww",
        "type": "earthquake", "place": "Vanuatu region",
    }
    return {c: "" for c in RAW_EVENT_COLUMNS} | known | fields


def write_raw(lake, run_id: str, rows: list[dict[str, str]]) -> None:
    data = [tuple(r.get(c, "") for c in RAW_EVENT_COLUMNS) + ("usgs", run_id) for r in rows]
    frame = lake.spark.createDataFrame(data, RAW_EVENT_SCHEMA).coalesce(1)
    frame.write.mode("append").parquet(lake.path("raw/usgs", f"run_id={run_id}"))


def magnitude_code(mag: float | None) -> str:
    if mag is None:
        return "  "
    sign, (units, tenths) = mag < 0, divmod(round(abs(mag) * 10), 10)
    if sign:
        return "-ABC"[units] + str(tenths)
    return f"{units or ' '}{tenths}"


def catalog_line(
    when: datetime, lat: float, lon: float, *, depth=10.0, mag=3.0, kind="J", level=" ", klass="1",
    region="SURUGA BAY", agency="J",
) -> str:
    """96 characters with the fields at their 1-based columns; ``when`` is local time."""
    line = [" "] * 96

    def put(column: int, width: int, text: str) -> None:
        line[column - 1 : column - 1 + width] = text.rjust(width)

    def put_angle(column: int, width: int, value: float) -> None:
        minutes = round(abs(value) * 6000)
        put(column, width, f"{'-' if value < 0 else ''}{minutes // 6000}")
        put(column + width, 4, str(minutes % 6000))

    put(1, 1, agency)
    put(2, 12, f"{when:%Y%m%d%H%M}")
    put(14, 4, str(when.second * 100 + when.microsecond // 10_000))
    put_angle(22, 3, lat)
    put_angle(33, 4, lon)
    put(45, 5, str(round(depth * 100)))
    put(53, 2, magnitude_code(mag))
    put(55, 1, kind if mag is not None else " ")
    put(61, 1, klass)
    put(62, 1, level)
    put(69, 24, region.ljust(24))
    return "".join(line)


def write_catalog(lake, name: str, lines: list[str]) -> None:
    folder = Path(lake.path("raw/jma/catalog"))
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as archive:
        archive.writestr(name.removesuffix(".zip"), "".join(f"{x}\r\n" for x in lines).encode("latin-1"))


def daily_line(when: datetime, lat: float, lon: float, depth="10", mag="1.2", region="駿河湾") -> str:
    """One list line; ``when`` is local time."""
    north, east = (f"{int(v)}°{v % 1 * 60:.1f}'{side}" for v, side in ((lat, "N"), (lon, "E")))
    day = f"{when.year} {when.month} {when.day} {when:%H:%M} {when.second + when.microsecond / 1e6:.1f}"
    return f"{day}  {north} {east}  {depth} {mag}  {region}"


def daily_page(lines: list[str], encoding: str = "utf-8") -> bytes:
    head = f'<html><head><meta http-equiv="Content-Type" content="text/html; charset={encoding}"></head>'
    body = "<br>".join(["<b>一覧表</b>", "日時 位置 深さ 規模", *lines, "以上 &lt;終&gt;"])
    return f"{head}<body><div>{body}</div></body></html>".encode(encoding)


def write_daily(lake, day: str, lines: list[str], encoding: str = "utf-8") -> None:
    folder = Path(lake.path("raw/jma/daily", day[:4]))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{day}.html.gz").write_bytes(gzip.compress(daily_page(lines, encoding)))


def bulletin(eid: str, at: str, **fields) -> dict:
    """A felt bulletin with a field the reader does not know; ``at`` is local time with its offset."""
    known = {
        "eid": eid, "at": at, "rdt": at, "cod": "+34.8+138.6-21000/", "mag": "3.7", "maxi": "2",
        "anm": "静岡県中部", "en_anm": "Central Shizuoka", "extra": [1],
    }
    return known | fields


def write_feed(lake, run_id: str, bulletins: list[dict]) -> None:
    folder = Path(lake.path("raw/jma/feed", f"run_id={run_id}"))
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps(bulletins, ensure_ascii=False)
    (folder / "list.json.gz").write_bytes(gzip.compress(text.encode("utf-8")))


def rows(df, order: str = "event_time") -> list[dict]:
    """Rows as dicts; times as aware UTC datetimes."""
    stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    moved = df.orderBy(order).withColumns({c: F.unix_micros(c) for c in stamps})
    start = utc(1970, 1, 1)
    out = []
    for r in moved.collect():
        d = r.asDict()
        for c in stamps:
            d[c] = None if d[c] is None else start + timedelta(microseconds=d[c])
        out.append(d)
    return out
