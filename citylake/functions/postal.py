"""Postal code checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citylake.functions.base import as_col, let, strip, to_double

# Accepted postal code ranges and prefix classes.
PARIS_RANGE = (75001, 75020)
BARCELONA_RANGE = (8001, 8042)
MADRID_RANGE = (28001, 28080)
PREFIX_CLASSES = {"28": "Madrid", "08": "Barcelona"}
OTHER_CLASS = "Otro"


def postcode_in(
    c: Column | str,
    low: int,
    high: int,
    town: Column | str | None = None,
    expected: str | None = None,
) -> Column:
    """Whole part of a numeric postcode if in range and, when given, the town matches."""
    fits = F.lit(True) if town is None else F.lower(strip(town)) == expected
    return let(
        to_double(c).try_cast("int"), lambda code: F.when(code.between(low, high) & fits, code)
    )


def paris_postcode(c: Column | str, town: Column | str) -> Column:
    return postcode_in(c, *PARIS_RANGE, town, "paris")


def barcelona_postcode(c: Column | str, town: Column | str) -> Column:
    return postcode_in(c, *BARCELONA_RANGE, town, "barcelona")


def madrid_postcode(c: Column | str) -> Column:
    return postcode_in(c, *MADRID_RANGE)


def pad_zip(c: Column | str) -> Column:
    """Left-pad to five characters; longer values stay (``lpad`` alone would cut them)."""
    s = as_col(c).cast("string")
    return F.when(F.length(s) < 5, F.lpad(s, 5, "0")).otherwise(s)


def city_of_postcode(c: Column | str) -> Column:
    s = as_col(c).cast("string")
    out = None
    for prefix, city in PREFIX_CLASSES.items():
        hit = s.startswith(prefix)
        out = F.when(hit, city) if out is None else out.when(hit, city)
    return out.otherwise(OTHER_CLASS)
