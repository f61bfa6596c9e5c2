"""Ids, bands and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seismic_lake.functions.fixed_width import code_label
from seismic_lake.vocab import COMPASS_POINTS, DEPTH_BANDS, MAG_BANDS, PLACE_WORDS, SHINDO_ORDER


def event_key(ts: Column, lat: Column, lon: Column) -> Column:
    """Readable stable id: UTC time to 1/100 s, then four hex digits of the rounded location.

    NULL unless time and location are known. Before 1970 the hundredths count up from the second
    like everywhere else.
    """
    hundredths = F.floor(F.pmod(F.unix_millis(ts), F.lit(1000)) / 10).cast("int")
    place = F.substring(F.md5(F.format_string("%.2f,%.2f", lat, lon)), 1, 4)
    key = F.concat(
        F.lit("jma-"),
        F.date_format(ts, "yyyyMMdd'T'HHmmss"),
        F.lit("."),
        F.lpad(hundredths.cast("string"), 2, "0"),
        F.lit("-"),
        place,
    )
    return F.when(ts.isNotNull() & lat.isNotNull() & lon.isNotNull(), key)


def magnitude_band(mag: Column, cap: int | None = None) -> Column:
    """Whole magnitude, optionally with everything above ``cap`` in one band."""
    band = F.floor(mag).cast("int")
    return band if cap is None else F.when(band > cap, cap).otherwise(band)


def _banded(value: Column, bands: list[tuple[float | None, str]]) -> Column:
    label = None
    for upper, name in bands:
        if upper is None:
            label = label.otherwise(name)
        else:
            label = F.when(value < upper, name) if label is None else label.when(value < upper, name)
    return F.when(value.isNotNull(), label)


def display_mag_band(mag: Column) -> Column:
    return _banded(mag, MAG_BANDS)


def display_depth_band(depth: Column) -> Column:
    return _banded(depth, DEPTH_BANDS)


def shindo_rank(level: Column) -> Column:
    """Position on the scale, weakest 1; NULL for anything that is not a level."""
    position = F.array_position(F.array(*[F.lit(s) for s in SHINDO_ORDER]), level)
    return F.nullif(position, F.lit(0).cast("bigint"))


def shindo_class(level: Column) -> Column:
    """'severe' from 6-, 'strong' for the 5s, else 'normal'."""
    return F.when(level.rlike("^[67]"), "severe").when(level.startswith("5"), "strong").otherwise("normal")


def readable_place(place: Column) -> Column:
    """Upper-case catalog abbreviations in mixed case; other text is returned unchanged."""

    def word(w: Column, i: Column) -> Column:
        known = code_label(w, PLACE_WORDS)
        first_upper = F.concat(F.upper(F.substring(known, 1, 1)), F.substr(known, F.lit(2)))
        return (
            F.when(w.isin(*COMPASS_POINTS), w)
            .when(known.isNotNull() & (i == 0), first_upper)
            .when(known.isNotNull(), known)
            .otherwise(F.concat(F.substring(w, 1, 1), F.lower(F.substr(w, F.lit(2)))))
        )

    words = F.transform(F.split(place, r"\s+"), word)
    shouting = (place == F.upper(place)) & place.rlike("[A-Z]")
    return F.when(shouting, F.array_join(words, " ")).otherwise(place)


def run_status(published: Column, warnings: Column) -> Column:
    return F.when(~published, "critical").when(warnings > 0, "warning").otherwise("good")


def check_status(passed: Column, severity: Column) -> Column:
    return F.when(passed, "good").when(severity == "error", "critical").otherwise("warning")


def status_rank(status: Column) -> Column:
    """Worst first."""
    return F.when(status == "critical", 0).when(status == "warning", 1).otherwise(2)
