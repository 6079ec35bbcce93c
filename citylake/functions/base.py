"""Shared helpers of the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's str.strip() and \s understand it. Spark's trim removes
# U+0020 only and Java's \s is ASCII, so both are spelled out here.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\s\x1c-\x1f]"  # use under (?U)
NON_SPACE = r"[^\s\x1c-\x1f]"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(as_col(c), F.lit(SPACES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Spark inlines an expression wherever it is used, and shares it only where every use is
    certain to be evaluated; a lambda variable is computed once in all cases.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


NUMBER = (
    rf"(?U)^{SPACE}*+([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?){SPACE}*+$"
)


def to_double(c: Column | str) -> Column:
    """Text or number to double; anything that is not a plain decimal number is null.

    The pattern keeps out Java-only spellings such as ``1d`` that a bare cast accepts, and spares
    the cast the slow path it takes on bad text.
    """
    return let(
        F.regexp_extract(as_col(c).cast("string"), NUMBER, 1),
        lambda n: F.when(n != "", n.try_cast("double")),
    )
