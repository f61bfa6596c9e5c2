"""Time arithmetic on UTC instants."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from seismic_lake.vocab import JST_HOURS

MICROS = 1_000_000
JST_MICROS = JST_HOURS * 3600 * MICROS


def instant(moment: datetime) -> Column:
    """A literal instant; naive datetimes are taken as UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(to_micros(aware)))


def to_micros(moment: datetime) -> int:
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    delta = aware - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * MICROS + delta.microseconds


def shift_micros(ts: Column, micros: Column | int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + micros)


def fixed_offset_local(
    year: Column, month: Column, day: Column, hour: Column, minute: Column, seconds: Column
) -> Column:
    """Local wall-clock parts at UTC+9 to a UTC instant; impossible dates are NULL.

    The offset is a constant, not the Asia/Tokyo zone: that zone has daylight saving in 1948-51,
    which the sources do not apply. Seconds are added as an interval, so 60.5 rolls over.
    """
    base = F.try_make_timestamp(year, month, day, hour, minute, F.lit(0))
    micros = F.round(seconds * F.lit(float(MICROS))).cast("bigint")
    return shift_micros(base, micros - F.lit(JST_MICROS))


def jst_date(ts: Column) -> Column:
    """Calendar day at UTC+9."""
    return F.to_date(shift_micros(ts, F.lit(JST_MICROS)))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(float(MICROS))
