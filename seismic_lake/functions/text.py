"""Text to typed values: blanks become NULL, unparsable text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain decimal numbers (or nan/inf), with spaces around them. Keeps Spark from accepting suffixes
# such as '1.5d', and blank text from reaching the cast, where every failure costs an exception.
NUMBER = (
    r"^[\s\u3000\u00a0]*(?:[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:[+-]?(?:nan|inf|infinity)))"
    r"[\s\u3000\u00a0]*$"
)
DATED = r"^[\s\u3000\u00a0]*\d{4,6}-\d"


SPACES = " \u3000\u00a0"  # plain, ideographic and no-break


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(SPACES))


def clean_text(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def _cast(col: Column, kind: str) -> Column:
    # The cast itself skips plain spaces; the others are rare enough to try second.
    return F.coalesce(col.try_cast(kind), strip(col).try_cast(kind))


def to_number(col: Column) -> Column:
    """Text to double; anything but a plain decimal number (or nan/inf) is NULL."""
    return F.when((F.length(col) > 0) & col.rlike(NUMBER), _cast(col, "double"))


def to_integer(col: Column) -> Column:
    """Text to int, rounding fractional text ('12.7' is 13); out-of-range text is NULL."""
    return F.round(to_number(col)).try_cast("int")


def to_timestamp(col: Column) -> Column:
    """ISO date and time to timestamp; text without an offset is read in the session zone (UTC)."""
    return F.when(col.rlike(DATED), _cast(col, "timestamp"))


def typed(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return clean_text(col)
    if isinstance(kind, T.IntegerType):
        return to_integer(col)
    if isinstance(kind, T.TimestampType):
        return to_timestamp(col)
    return to_number(col)
