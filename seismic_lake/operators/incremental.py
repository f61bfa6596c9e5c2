"""Incremental selection: new revisions, resumable ranges, changed files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.times import instant


def changed_since(
    events: DataFrame,
    mark: datetime | Column | None,
    window_start: datetime | None = None,
    window_end: datetime | None = None,
    min_mag: float | None = None,
) -> DataFrame:
    """Events updated after the high-water mark, within a window of event times.

    All bounds are literals, so they reach the Parquet scan.
    """
    rows = events
    if window_start is not None:
        rows = rows.where(F.col("event_time") >= instant(window_start))
    if window_end is not None:
        rows = rows.where(F.col("event_time") < instant(window_end))
    if min_mag is not None:
        rows = rows.where(F.col("mag") >= min_mag)
    if mark is not None:
        rows = rows.where(F.col("updated_at") > (instant(mark) if isinstance(mark, datetime) else mark))
    return rows


def next_mark(events: DataFrame, previous: Column | None = None) -> DataFrame:
    """One row: the new high-water mark. It comes from the data, never from a clock."""
    newest = F.max("updated_at")
    mark = newest if previous is None else F.greatest(newest, previous)
    return events.agg(mark.alias("max_updated"), F.count("*").alias("events"))


def capped_windows(
    events: DataFrame,
    time_col: str,
    cap: int,
    min_span_s: float = 60.0,
    by: str = "year",
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Cut time into chronological ranges of at most ``cap`` events: (window_start, window_end, n).

    Every calendar year (or month, with ``by='month'``) is halved until a piece holds at most
    ``cap`` events or is no longer than ``min_span_s``. Empty pieces are skipped. Instead of
    counting piece by piece, events are counted once per finest piece and rolled up through all
    levels; a piece is kept when it need not be split but its parent had to be.

    A job may begin and end within a year: ``start`` and ``end`` (exclusive) clip the first and the last
    year, and the clipped piece is what gets halved.
    """
    rows = changed_since(events.withColumn("event_time", F.col(time_col)), None, start, end) if start or end else events
    opens = F.date_trunc(by, time_col)
    closes = opens + F.expr(f"interval 1 {by}")
    if start is not None:
        opens = F.greatest(opens, instant(start))
    if end is not None:
        closes = F.least(closes, instant(end))
    low, span = F.unix_micros(opens), F.unix_micros(closes) - F.unix_micros(opens)
    # A year halves 20 times before its pieces are under a minute.
    longest = (366 if by == "year" else 31) * 86_400.0
    depth = 0
    while longest / 2**depth > min_span_s:
        depth += 1
    pieces = F.lit(2**depth).cast("bigint")
    offset = F.unix_micros(time_col) - F.col("low")
    leaf = F.least(
        F.floor(offset.cast("double") * pieces.cast("double") / F.col("span")).cast("bigint"), pieces - 1
    )
    leaves = (
        rows.where(F.col(time_col).isNotNull())
        .select(time_col, low.alias("low"), span.alias("span"))
        .groupBy("low", "span", leaf.alias("leaf"))
        .agg(F.count("*").alias("n"))
    )
    # Depth at which a piece of this span stops being split whatever it holds.
    last = F.ceil(F.log2(F.col("span") / F.lit(min_span_s * 1e6))).cast("int")
    last = F.greatest(F.lit(0), F.least(last, F.lit(depth)))
    nodes = (
        leaves.withColumn("last", last)
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("node", F.floor(F.col("leaf") / F.pow(F.lit(2.0), F.lit(depth) - F.col("level"))).cast("bigint"))
        .groupBy("low", "span", "last", "level", "node")
        .agg(F.sum("n").alias("n"))
    )
    # Every piece reports itself, and a piece that must be split reports its halves as wanted, so
    # one more aggregate tells which pieces to keep: no join of the counts with themselves.
    must_split = (F.col("n") > cap) & (F.col("level") < F.col("last"))

    def report(level: Column, node: Column, n: Column, wanted: bool) -> Column:
        return F.struct(level.alias("level"), node.alias("node"), n.alias("n"), F.lit(wanted).alias("wanted"))

    itself = report(F.col("level"), F.col("node"), F.col("n"), False)
    unknown = F.lit(None).cast("bigint")
    halves = [report(F.col("level") + 1, F.col("node") * 2 + k, unknown, True) for k in (0, 1)]
    reports = F.when(must_split, F.array(itself, *halves)).otherwise(F.array(itself))
    chosen = (
        nodes.select("low", "span", "last", F.explode(reports).alias("r"))
        .groupBy("low", "span", "last", "r.level", "r.node")
        .agg(F.max("r.n").alias("n"), F.max("r.wanted").alias("wanted"))
        .where(F.col("n").isNotNull() & ~must_split & ((F.col("level") == 0) | F.col("wanted")))
    )
    size = F.col("span") / F.pow(F.lit(2.0), F.col("level"))

    def edge(k: Column) -> Column:
        return F.timestamp_micros(F.col("low") + F.round(size * k).cast("bigint"))

    return chosen.select(
        edge(F.col("node")).alias("window_start"), edge(F.col("node") + 1).alias("window_end"), "n"
    )


def unfinished(planned: DataFrame, finished: DataFrame) -> DataFrame:
    """Planned ranges not yet done. A finished range counts only for the same job start."""
    return planned.join(finished, ["job_start", "window_start", "window_end"], "left_anti")


def changed_files(listed: DataFrame, seen: DataFrame) -> DataFrame:
    """Listed files not seen before, or seen with another size or modification time."""
    same = (
        (listed["name"] == seen["name"])
        & listed["size"].eqNullSafe(seen["size"])
        & listed["last_modified"].eqNullSafe(seen["last_modified"])
    )
    return listed.join(seen, same, "left_anti")
