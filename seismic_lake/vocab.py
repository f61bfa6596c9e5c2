"""Schemas, code tables and limits shared by every job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STR, DBL, INT, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- Fixed values: names, codes, orders and limits that results depend on. ------------------

# Raw event column -> clean column and type.
RAW_EVENT_COLUMNS: dict[str, tuple[str, T.DataType]] = {
    "id": ("event_id", STR),
    "time": ("event_time", TS),
    "updated": ("updated_at", TS),
    "latitude": ("latitude", DBL),
    "longitude": ("longitude", DBL),
    "depth": ("depth_km", DBL),
    "mag": ("mag", DBL),
    "magType": ("mag_type", STR),
    "nst": ("nst", INT),
    "gap": ("gap", DBL),
    "dmin": ("dmin", DBL),
    "rms": ("rms", DBL),
    "net": ("network", STR),
    "place": ("place", STR),
    "type": ("event_type", STR),
    "horizontalError": ("horizontal_error_km", DBL),
    "depthError": ("depth_error_km", DBL),
    "magError": ("mag_error", DBL),
    "magNst": ("mag_nst", INT),
    "status": ("review_status", STR),
    "locationSource": ("location_source", STR),
    "magSource": ("mag_source", STR),
}

# Felt intensity (shindo): the accepted levels, weakest to strongest. The single levels 5 and 6
# (used until 1996) sit between their lower and upper halves.
SHINDO_ORDER = ["1", "2", "3", "4", "5-", "5", "5+", "6-", "6", "6+", "7"]

# Catalog code columns.
INTENSITY_CODES = {
    "1": "1", "2": "2", "3": "3", "4": "4", "5": "5", "6": "6", "7": "7",
    "A": "5-", "B": "5+", "C": "6-", "D": "6+",
}
EVENT_CLASS_CODES = {"3": "artificial", "4": "volcanic", "5": "low_frequency"}
EVENT_CLASS_DEFAULT = "earthquake"
MAG_TYPE_CODES = {
    "J": "Mj", "D": "Md", "d": "Md", "V": "Mv", "v": "Mv", "W": "Mw", "B": "mb", "S": "Ms",
}

# Ocean/continent plate boundary step classes -> boundary type.
BOUNDARY_TYPES = {
    "SUB": "subduction",
    "OCB": "convergent",
    "CCB": "convergent",
    "OSR": "divergent",
    "CRB": "divergent",
    "OTF": "transform",
    "CTF": "transform",
}

# Place-name words and compass points kept by the readable-name function.
PLACE_WORDS = {
    "PREF": "Pref.", "PEN": "Pen.", "IS": "Is.", "REG": "Region",
    "OFF": "off", "FAR": "far", "NEAR": "near",
}
COMPASS_POINTS = [
    "N", "S", "E", "W", "NE", "NW", "SE", "SW",
    "NNE", "ENE", "ESE", "SSE", "SSW", "WSW", "WNW", "NNW",
]

# Upper bounds (exclusive) and labels of the display bands.
MAG_BANDS = [(3.0, "Below 3"), (4.0, "3–4"), (5.0, "4–5"), (6.0, "5–6"), (None, "6+")]
DEPTH_BANDS = [(30.0, "0–30 km"), (70.0, "30–70 km"), (300.0, "70–300 km"), (None, "300+ km")]

# Fixed local time of the Japanese sources: UTC+9, never daylight saving.
JST_HOURS = 9
EARTH_RADIUS_KM = 6371.0

# Record linkage.
LINK_MAX_SECONDS = 16
LINK_MAX_KM = 100
LINK_MIN_MAG = 1.5

# Gold tables.
MAP_MIN_MAG = 2.5
MAP_DAYS = 30
DAILY_DAYS = 90
STRONGEST_N = 10
RUNS_SHOWN = 30
FELT_SHOWN = 10
JAPAN_MAP_MIN_MAG = 2.0


@dataclass(frozen=True)
class Box:
    """Inclusive latitude/longitude box."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


LINK_BOX = Box(20, 50, 120, 155)
JAPAN_BOX = Box(24, 46, 122, 150)
# --- End of fixed values. --------------------------------------------------------------------

RAW_EVENT_SCHEMA = _struct({**{c: STR for c in RAW_EVENT_COLUMNS}, "_source": STR, "_ingested_at": STR})

USGS_SCHEMA = _struct(
    {**{name: kind for name, kind in RAW_EVENT_COLUMNS.values()}, "source": STR, "ingested_at": STR}
)

JMA_SCHEMA = _struct(
    {
        "event_id": STR, "event_time": TS, "latitude": DBL, "longitude": DBL, "depth_km": DBL,
        "mag": DBL, "mag_type": STR, "max_intensity": STR, "event_type": STR, "region": STR,
        "region_en": STR, "agency": STR, "status": STR, "source": STR,
    }
)

FELT_SCHEMA = _struct(
    {
        "report_id": STR, "event_time": TS, "latitude": DBL, "longitude": DBL, "depth_km": DBL,
        "mag": DBL, "max_intensity": STR, "region": STR, "region_en": STR, "updated_at": TS,
    }
)

MATCH_SCHEMA = _struct(
    {
        "jma_event_id": STR, "usgs_event_id": STR, "jma_event_time": TS, "time_diff_s": DBL,
        "distance_km": DBL, "jma_mag": DBL, "jma_mag_type": STR, "usgs_mag": DBL,
        "usgs_mag_type": STR, "mag_diff": DBL, "jma_depth_km": DBL, "usgs_depth_km": DBL,
        "score": DBL,
    }
)

DQ_SCHEMA = T.StructType(
    [
        T.StructField("run_id", STR),
        T.StructField("run_at", TS),
        T.StructField("check", STR),
        T.StructField("severity", STR),
        T.StructField("passed", T.BooleanType()),
        T.StructField("observed", STR),
        T.StructField("expected", STR),
        T.StructField("value", DBL),
        T.StructField("dataset", STR),
    ]
)

# A felt bulletin; fields not listed here are ignored by the reader.
FEED_SCHEMA = _struct(
    {"eid": STR, "at": STR, "rdt": STR, "cod": STR, "mag": STR, "maxi": STR, "anm": STR, "en_anm": STR}
)


def with_year(schema: T.StructType) -> T.StructType:
    """The schema as readers see it, with the partition column at the end."""
    return T.StructType([*schema.fields, T.StructField("year", INT)])
