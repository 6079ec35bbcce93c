"""Date and time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citylake.functions.base import as_col

STAMP = "yyyy-MM-dd HH:mm:ss"


def parse_ts(c: Column | str, pattern: str = STAMP) -> Column:
    """Timestamp from the leading ``yyyy-MM-dd HH:mm:ss``; trailing text is ignored, bad is null."""
    s = as_col(c).cast("string")
    return F.try_to_timestamp(F.substring(s, 1, len(pattern)), F.lit(pattern))


def hour_of(c: Column | str) -> Column:
    """``HH:mm`` of an ISO timestamp text, as written (a zone offset does not shift it)."""
    # From the twelfth character on, so that the date's own hyphens are not taken for an offset.
    c = F.regexp_replace(as_col(c), r"^(.{11,}?)(Z|[+-]\d{2}:?\d{2})$", "$1")
    stamp = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), c).try_cast("timestamp_ntz")
    return F.substring(stamp.cast("string"), 12, 5)


def departure_day(c: Column | str) -> Column:
    return F.date_add(as_col(c), 1)


def weather_day(c: Column | str) -> Column:
    return F.date_sub(as_col(c), 365)


def same_day_last_year(c: Column | str) -> Column:
    return F.add_months(as_col(c), -12)
