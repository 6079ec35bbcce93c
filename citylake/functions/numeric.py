"""Number, coordinate and vector functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citylake.functions.base import as_col, let, to_double

SCALE = 1e7  # fixed value: factor of the scaled coordinates


def to_numeric(c: Column | str) -> Column:
    return to_double(c)


def to_long(c: Column | str) -> Column:
    """Whole part of a number or numeric text; bad is null."""
    c = as_col(c)
    return F.coalesce(c.try_cast("bigint"), to_double(c.cast("string")).try_cast("bigint"))


def round_coord(c: Column | str) -> Column:
    """Half-even rounding to a whole number."""
    return F.bround(as_col(c).try_cast("double"), 0).try_cast("long")


def split_latlon(c: Column | str) -> Column:
    """``"lat, lon"`` to a struct of two doubles; a bad part is null."""
    part = F.split(as_col(c), ",")
    return F.struct(
        to_double(F.get(part, F.lit(0))).alias("lat"), to_double(F.get(part, F.lit(1))).alias("lon")
    )


def scaled_coords(c: Column | str) -> Column:
    """Text before the comma and from two characters after it, each times 1e7.

    Without a comma the first part loses its last character and the second its first.
    """
    c = as_col(c)
    comma = F.instr(c, ",")
    first = F.substring(c, F.lit(1), F.when(comma > 0, comma - 1).otherwise(F.length(c) - 1))
    second = F.substring(c, F.when(comma > 0, comma + 2).otherwise(F.lit(2)), F.length(c))
    return F.struct((to_double(first) * SCALE).alias("x"), (to_double(second) * SCALE).alias("y"))


def point_wkt(lon: Column | str, lat: Column | str) -> Column:
    """``POINT(lon lat)``; null when either is null."""
    return F.concat(
        F.lit("POINT("), as_col(lon).cast("string"), F.lit(" "), as_col(lat).cast("string"), F.lit(")")
    )


def l2_normalise(c: Column | str, scale: float = 1.0) -> Column:
    """Divide by ``scale``, then by the L2 norm when it is positive."""
    return let(
        F.transform(as_col(c), lambda x: x.cast("double") / F.lit(float(scale))),
        lambda v: let(
            F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)),
            lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(x).cast("float")),
        ),
    )
