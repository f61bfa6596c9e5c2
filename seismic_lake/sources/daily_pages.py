"""Daily hypocenter lists: one gzipped HTML page per day, one text line per event."""

from __future__ import annotations

import gzip
import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismic_lake.functions.times import fixed_offset_local

# Where a page declares its charset, what counts as a tag, and the shape of a line:
# year month day hour:minute seconds lat°min'N lon°min'E depth magnitude region
CHARSET = re.compile(r"charset=[\"']?([\w-]+)")
TAG = re.compile(r"<[^>]+>")
DAILY_LINE = (
    r"(?U)^\s*(\d{4})\s+(\d{1,2})\s+(\d{1,2})\s+(\d{1,2}):(\d{2})\s+(\d{1,2}(?:\.\d+)?)\s+"
    r"(\d{1,3})°\s*(\d{1,2}(?:\.\d+)?)'([NS])\s*(\d{1,3})°\s*(\d{1,2}(?:\.\d+)?)'([EW])\s+"
    r"(-|\d+(?:\.\d+)?)\s+(-|-?\d+(?:\.\d+)?)\s+(\S.*?)\s*$"
)
DAILY_PARTS = [
    "year", "month", "day_no", "hour", "minute", "sec", "lat_deg", "lat_min", "ns",
    "lon_deg", "lon_min", "ew", "depth", "magnitude", "region",
]


def decode_page(page: bytes) -> str:
    """The declared charset if it fits, else UTF-8, else the Windows form of Shift_JIS."""
    declared = CHARSET.search(page[:2000].decode("ascii", "ignore").lower())
    for name in ([declared.group(1)] if declared else []) + ["utf-8"]:
        try:
            return page.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return page.decode("cp932", "replace")


def page_text(markup: str) -> str:
    """Text of a page; a tag ends a line."""
    return html.unescape(TAG.sub("\n", markup))


# Where Python's splitlines() cuts, with a line break at the very end giving no further line.
LINE_END = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def _page_text(column: str, decode) -> callable:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [page_text(decode(page)) for page in batch.pop(column)]
            yield batch.assign(text=pd.Series(texts, index=batch.index, dtype="object"))

    return rows


def _lines(pages: DataFrame, key: str) -> DataFrame:
    """(key, line_no, line): pages cut at line ends, outside Python."""
    body = F.regexp_replace("text", f"({LINE_END})\\z", "")
    cut = F.when(F.col("text") != "", F.split(body, LINE_END, -1))
    return pages.select(key, F.posexplode(cut).alias("at", "line")).select(key, (F.col("at") + 1).cast("bigint").alias("line_no"), "line")


def read_daily_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Text lines of every page with the day its file is named after."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.html.gz")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    named = files.select(F.regexp_extract("path", r"([^/]+)$", 1).substr(1, 8).alias("day"), "content")
    expand = _page_text("content", lambda blob: decode_page(gzip.decompress(blob)))
    return _lines(named.mapInPandas(expand, "day string, text string"), "day")


def html_lines(pages: DataFrame, key: str, column: str) -> DataFrame:
    """The same expansion for pages already held as text in a table."""
    kind = pages.schema[key].dataType.simpleString()
    expand = _page_text(column, lambda markup: markup or "")
    return _lines(pages.select(key, column).mapInPandas(expand, f"{key} {kind}, text string"), key)


def parse_daily(lines: DataFrame) -> DataFrame:
    """Typed events from (day, line); lines of any other shape are not events and are left out."""
    line = F.replace(F.col("line"), F.lit("\u3000"), F.lit(" "))
    # One regex pass pulls all fifteen parts out as a delimited string.
    joined = F.regexp_replace(line, DAILY_LINE, "\x1f".join(f"${i + 1}" for i in range(len(DAILY_PARTS))))
    parts = lines.where(line.rlike(DAILY_LINE)).select("day", F.split(joined, "\x1f").alias("p"))
    named = parts.select("day", *[F.col("p")[i].alias(name) for i, name in enumerate(DAILY_PARTS)])

    def number(name: str):
        # The pattern admits only digits here, or '-' for a value that was not determined.
        return F.nullif(F.col(name), F.lit("-")).try_cast("double")

    def whole(name: str):
        return F.col(name).try_cast("int")

    def coordinate(deg: str, minutes: str, side: str, negative: str):
        sign = F.when(F.col(side) == negative, -1.0).otherwise(1.0)
        return sign * (number(deg) + number(minutes) / F.lit(60.0))

    return named.select(
        fixed_offset_local(
            whole("year"), whole("month"), whole("day_no"), whole("hour"), whole("minute"), number("sec")
        ).alias("event_time"),
        coordinate("lat_deg", "lat_min", "ns", "S").alias("latitude"),
        coordinate("lon_deg", "lon_min", "ew", "W").alias("longitude"),
        number("depth").alias("depth_km"),
        number("magnitude").alias("mag"),
        "region",
        "day",
    )
