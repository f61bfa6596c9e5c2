"""Line and polygon clean-up for map layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seismic_lake.functions.fixed_width import code_label
from seismic_lake.vocab import BOUNDARY_TYPES

DECIMALS = 2  # fixed value: about 1 km
MIN_RING_POINTS = 4  # fixed value
STEPS_PER_CHUNK = 100_000


def step_rejects(steps: DataFrame) -> DataFrame:
    """One row: steps that name no boundary or have no place in it, and so are in no line."""
    return steps.agg(
        F.count_if(F.col("boundary").isNull()).alias("no_boundary"),
        F.count_if(F.col("boundary").isNotNull() & F.col("seq").isNull()).alias("no_seq"),
    )


def merge_steps(steps: DataFrame, decimals: int = DECIMALS, chunk: int = STEPS_PER_CHUNK) -> DataFrame:
    """Join consecutive boundary steps into lines: (boundary, type, line_no, point_no, lon, lat).

    Input: boundary, seq (whole number, unique per boundary), step_class and the step's two ends.
    A line ends where the boundary or the type changes, where a step does not start at the last
    point, and at a step that wraps around the dateline, which is dropped. One row per point, so
    a long boundary is never gathered into one value.

    Steps are numbered inside chunks of ``chunk`` sequence numbers and the chunks' totals carried
    over, so no task sorts a whole boundary; the result does not depend on ``chunk``. Steps without
    boundary or seq are left out and counted by :func:`step_rejects`.
    """
    start = F.struct(F.round("start_lon", decimals).alias("lon"), F.round("start_lat", decimals).alias("lat"))
    end = F.struct(F.round("end_lon", decimals).alias("lon"), F.round("end_lat", decimals).alias("lat"))
    wraps = F.abs(end["lon"] - start["lon"]) > 180
    kind = code_label(F.col("step_class"), BOUNDARY_TYPES)
    # Only the trace is carried along, so the chunk totals read the same shuffle as the steps.
    traced = steps.select(
        "boundary",
        "seq",
        F.floor(F.col("seq") / chunk).cast("bigint").alias("chunk"),
        F.struct(kind.alias("type"), start.alias("start"), end.alias("end"), wraps.alias("wraps")).alias("trace"),
    ).where(F.col("boundary").isNotNull() & F.col("chunk").isNotNull())
    by_chunk = Window.partitionBy("boundary", "chunk").orderBy("seq")
    by_boundary = Window.partitionBy("boundary").orderBy("chunk")
    traced = traced.withColumn("prev", F.lag("trace").over(by_chunk))

    def opens(step: Column, before: Column) -> Column:
        """1 when a step starts a line, 0 when it goes on or is dropped."""
        goes_on = ~before["wraps"] & (before["type"] == step["type"]) & (before["end"] == step["start"])
        return F.when(step["wraps"] | F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)

    # One row per chunk: lines it opens after its first step, its first and its last step.
    inner = F.when(F.col("prev").isNotNull(), opens(F.col("trace"), F.col("prev"))).otherwise(0)
    chunks = traced.groupBy("boundary", "chunk").agg(
        F.sum(inner).alias("inner"), F.min_by("trace", "seq").alias("head"), F.max_by("trace", "seq").alias("tail")
    )
    carried = (
        chunks.withColumn("carried", F.lag("tail").over(by_boundary))
        .withColumn("total", F.col("inner") + opens(F.col("head"), F.col("carried")))
        .select(
            "boundary",
            "chunk",
            "carried",
            F.coalesce(
                F.sum("total").over(by_boundary.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("before"),
        )
    )
    numbered = (
        traced.join(carried, ["boundary", "chunk"])
        .withColumn("opens", opens(F.col("trace"), F.coalesce("prev", "carried")))
        .withColumn(
            "line_no",
            F.col("before")
            + F.sum("opens").over(by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .where(~F.col("trace.wraps"))
    )
    # The opening step gives two points, every other step its end.
    both = F.array("trace.start", "trace.end")
    points = F.when(F.col("opens") == 1, both).otherwise(F.array("trace.end"))
    return numbered.select(
        "boundary", "trace.type", "line_no", "seq", "opens", F.posexplode(points).alias("k", "p")
    ).select(
        "boundary",
        "type",
        "line_no",
        (F.col("seq") * 2 + F.when(F.col("opens") == 1, F.col("k")).otherwise(1)).alias("point_no"),
        F.col("p.lon").alias("lon"),
        F.col("p.lat").alias("lat"),
    )


def line_extents(points: DataFrame) -> DataFrame:
    """One row per line, however long: number of points, first and last point, extent."""
    at = lambda pick, column, name: pick(column, "point_no").alias(name)
    return points.groupBy("boundary", "type", "line_no").agg(
        F.count("*").alias("points"),
        at(F.min_by, "lon", "first_lon"), at(F.min_by, "lat", "first_lat"),
        at(F.max_by, "lon", "last_lon"), at(F.max_by, "lat", "last_lat"),
        F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north"),
    )


def clean_ring(points: Column, decimals: int = DECIMALS) -> Column:
    """Rounded points without consecutive repeats."""
    rounded = F.transform(
        points,
        lambda p: F.struct(F.round(p["lon"], decimals).alias("lon"), F.round(p["lat"], decimals).alias("lat")),
    )
    return rounded_without_repeats(rounded)


def rounded_without_repeats(rounded: Column) -> Column:
    shifted = F.concat(F.array(F.lit(None)), F.slice(rounded, 1, F.greatest(F.size(rounded) - 1, F.lit(0))))
    paired = F.arrays_zip(rounded.alias("p"), shifted.alias("before"))
    kept = F.filter(paired, lambda x: x["before"].isNull() | (x["p"] != x["before"]))
    return F.transform(kept, lambda x: x["p"])


def clean_polygons(features: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """One row per polygon from ``polygons`` (polygon -> ring -> point).

    Rings that collapse to fewer than four points are dropped, and polygons left without a ring.
    """
    others = [c for c in features.columns if c != "polygons"]
    rings = F.transform(F.col("polygon"), lambda ring: clean_ring(ring, decimals))
    return (
        features.select(*others, F.posexplode("polygons").alias("polygon_no", "polygon"))
        .withColumn("rings", F.filter(rings, lambda r: F.size(r) >= MIN_RING_POINTS))
        .where(F.size("rings") > 0)
        .drop("polygon")
    )
