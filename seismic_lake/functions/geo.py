"""Coordinates: boxes, cells, distances, point text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seismic_lake.vocab import EARTH_RADIUS_KM, Box

# Fixed value: latitude, longitude and optional depth in metres, e.g. "+32.0+131.4-10000/".
POINT_TEXT = r"^([+-]\d+(?:\.\d+)?)([+-]\d+(?:\.\d+)?)([+-]\d+(?:\.\d+)?)?/$"
PACIFIC_SPLIT = -30  # fixed value: longitudes west of this are drawn east of 180


def in_box(box: Box, lat: str | Column = "latitude", lon: str | Column = "longitude") -> Column:
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))
    return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)


def cell(degrees: Column, per_degree: int = 10) -> Column:
    """Index of the square cell (0.1 degree by default) a coordinate falls in."""
    return F.floor(degrees * per_degree).cast("int")


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    sin_lat, sin_lon = F.sin(half_lat), F.sin(half_lon)
    chord = sin_lat * sin_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * sin_lon * sin_lon
    # Rounding may lift the chord of antipodal points a hair above 1.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def point_part(text: Column, group: int) -> Column:
    """One number of a point text; NULL when the text is no point or the part is absent."""
    return F.nullif(F.regexp_extract(text, POINT_TEXT, group), F.lit("")).try_cast("double")


def point_depth_km(text: Column) -> Column:
    """Depth below ground in km (the text gives height in metres, negative below ground)."""
    return -point_part(text, 3) / F.lit(1000.0)


def pacific_longitude(lon: Column) -> Column:
    """Longitude on a map centred on the Pacific."""
    return F.when(lon < PACIFIC_SPLIT, lon + 360).otherwise(lon)


def pacific_line(points: Column) -> Column:
    """Shift a whole array of (lon, lat) points by its mean longitude, so lines stay unbroken."""
    total = F.aggregate(points, F.lit(0.0), lambda acc, p: acc + p["lon"])
    west = total / F.size(points) < PACIFIC_SPLIT
    moved = F.transform(points, lambda p: F.struct((p["lon"] + 360).alias("lon"), p["lat"].alias("lat")))
    return F.when(west, moved).otherwise(points)
