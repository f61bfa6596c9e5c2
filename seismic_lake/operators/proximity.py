"""Joins on 'close in time' and 'close in time and space', without nested loops."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import degrees
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seismic_lake.functions.geo import great_circle_km
from seismic_lake.functions.times import MICROS
from seismic_lake.vocab import EARTH_RADIUS_KM, LINK_MAX_KM, LINK_MAX_SECONDS

# Buckets are wider than the tolerance, so most rows of the replicated side fall in one bucket.
BUCKET_FACTOR = 8
CELL_FACTOR = 4
# Rows of one side that meet in one group of a join; a cell with more is dealt to several groups.
BLOCK_ROWS = 2_000


def _bucket(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(width)).cast("bigint")


def in_blocks(left: DataFrame, right: DataFrame, keys: list[str], rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides of an equality join on ``keys``, dealt so that no key is one task's work.

    A key with m * ``rows`` left rows and n * ``rows`` right rows becomes m * n groups (_x, _y): each left row is
    in one _x and every _y, each right row in one _y and every _x, so each pair meets once. Keys with
    few rows are one group; only those with more are looked up. Groups go to a fixed number of
    partitions: a group is few bytes and much work, so they must not be merged by their bytes.
    """
    n_left = left.groupBy(*keys).agg(F.ceil(F.count("*") / rows).cast("int").alias("_m"))
    n_right = right.groupBy(*keys).agg(F.ceil(F.count("*") / rows).cast("int").alias("_n"))
    crowded = n_left.join(n_right, keys).where("_m > 1 OR _n > 1")
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(side: DataFrame, own: str, mine: str, other: str, all_of: str) -> DataFrame:
        spread = side.join(crowded, keys, "left").withColumn(own, F.coalesce(F.pmod(F.xxhash64(*side.columns), mine), F.lit(0)).cast("int"))
        others = F.sequence(F.lit(0), F.coalesce(F.col(all_of) - 1, F.lit(0)))
        return spread.withColumn(other, F.explode(others)).drop("_m", "_n").repartition(partitions, *keys, "_x", "_y")

    return dealt(left, "_x", "_m", "_y", "_n"), dealt(right, "_y", "_n", "_x", "_m")


def interval_join(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str, seconds: float
) -> DataFrame:
    """Pairs whose times differ by at most ``seconds`` (inclusive).

    A plain BETWEEN join would be planned as a nested loop. Here both sides get a time bucket, the
    right side one row per bucket its window touches, and the join is an equality on the bucket
    with the exact test on top. Every pair meets in exactly one bucket: the left row's own. A burst that
    fills a bucket is dealt to several groups.
    """
    window = int(seconds * MICROS)
    width = float(max(window, 1) * BUCKET_FACTOR)
    t_left, t_right = F.unix_micros(left_time), F.unix_micros(right_time)
    keyed_left = left.withColumn("_bucket", _bucket(t_left, width))
    keyed_right = right.withColumn(
        "_bucket",
        F.explode(F.sequence(_bucket(t_right - window, width), _bucket(t_right + window, width))),
    )
    close = F.abs(t_left - t_right) <= window
    dealt_left, dealt_right = in_blocks(keyed_left, keyed_right, ["_bucket"])
    return dealt_left.join(dealt_right, ["_bucket", "_x", "_y"]).where(close).drop("_bucket", "_x", "_y")


@dataclass(frozen=True)
class Tolerance:
    seconds: float = LINK_MAX_SECONDS
    km: float = LINK_MAX_KM


def slim(side: DataFrame, prefix: str) -> DataFrame:
    """Only what the search needs: id, time in microseconds, place. Rows lacking one cannot pair.

    Saying so here gives the searches from both sides the same inputs, so they share one shuffle.
    """
    needed = [F.col(c).isNotNull() for c in ("event_id", "event_time", "latitude", "longitude")]
    return side.where(reduce(and_, needed)).select(
        F.col("event_id").alias(f"{prefix}_id"),
        F.unix_micros("event_time").alias(f"{prefix}_t"),
        F.col("latitude").alias(f"{prefix}_lat"),
        F.col("longitude").alias(f"{prefix}_lon"),
    )


@dataclass(frozen=True)
class Grid:
    """Cells of time, latitude and longitude a few tolerances wide; longitude wraps around."""

    tol: Tolerance
    time_factor: int = BUCKET_FACTOR
    cell_factor: int = CELL_FACTOR

    @property
    def window(self) -> int:
        return max(int(self.tol.seconds * MICROS), 1)

    @property
    def width(self) -> float:
        return float(self.window * self.time_factor)

    @property
    def lat_step(self) -> float:
        return min(degrees(self.tol.km / EARTH_RADIUS_KM) * self.cell_factor, 90.0)

    @property
    def columns(self) -> int:
        return max(int(360 / self.lat_step), 1)

    @property
    def lon_step(self) -> float:
        return 360.0 / self.columns


CELL = ["_b", "_i", "_j"]


def own_cell(rows: DataFrame, p: str, grid: Grid) -> DataFrame:
    return rows.selectExpr(
        "*",
        f"floor({p}_t / {grid.width!r}D) AS _b",
        f"floor({p}_lat / {grid.lat_step!r}D) AS _i",
        f"pmod(floor({p}_lon / {grid.lon_step!r}D), {grid.columns}L) AS _j",
    )


def reachable_cells(rows: DataFrame, low: list[str], high: list[str], grid: Grid) -> DataFrame:
    """One row per grid cell within tolerance of the row (usually one to three).

    ``low`` and ``high`` are the row's bounds in time, latitude and longitude as SQL, equal for a point.
    """
    radius = grid.tol.km / EARTH_RADIUS_KM
    reach = degrees(radius) * (1 + 1e-9)
    # Meridians converge: the longitude reach grows with latitude and is everything near a pole.
    lat = f"greatest(abs({low[1]}), abs({high[1]}))"
    at_lat = f"degrees(asin(least(1D, sin({radius!r}D) / cos(radians({lat}))))) * {1 + 1e-9!r}D"
    lon_reach = f"(CASE WHEN {lat} + {reach!r}D >= 90 THEN 180D ELSE {at_lat} END)"
    first_j = f"floor(({low[2]} - {lon_reach}) / {grid.lon_step!r}D)"
    last_j = f"least(floor(({high[2]} + {lon_reach}) / {grid.lon_step!r}D), {first_j} + {grid.columns - 1}L)"

    def span(first: str, last: str, margin: float, width: float) -> str:
        return f"explode(sequence(floor(({first} - {margin!r}D) / {width!r}D), floor(({last} + {margin!r}D) / {width!r}D)))"

    columns = rows.columns
    by_time = rows.selectExpr("*", f"{span(low[0], high[0], float(grid.window), grid.width)} AS _b")
    by_lat = by_time.selectExpr("*", f"{span(low[1], high[1], reach, grid.lat_step)} AS _i")
    by_lon = by_lat.selectExpr("*", f"explode(sequence({first_j}, {last_j})) AS _k")
    return by_lon.selectExpr(*[f"`{c}`" for c in columns], "_b", "_i", f"pmod(_k, {grid.columns}L) AS _j")


GROUP = [*CELL, "_x", "_y"]


def close_pairs(a: DataFrame, b: DataFrame, tol: Tolerance) -> DataFrame:
    """(a_id, b_id, dt, km, score) for slim sides ``a`` and ``b`` within ``tol``.

    The score is seconds and kilometres as shares of the tolerance, 0 when equal.
    """
    grid = Grid(tol)
    place = ["b_t", "b_lat", "b_lon"]
    met_a, met_b = in_blocks(own_cell(a, "a", grid), reachable_cells(b, place, place, grid), CELL)
    dt = F.abs(F.col("a_t") - F.col("b_t")) / F.lit(float(MICROS))
    km = great_circle_km(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    pairs = met_a.join(met_b, GROUP).where(dt <= tol.seconds).withColumn("dt", dt).withColumn("km", km)
    score = F.col("dt") / F.lit(float(tol.seconds)) + F.col("km") / F.lit(float(tol.km))
    return pairs.where(F.col("km") <= tol.km).select("a_id", "b_id", "dt", "km", score.alias("score"))
