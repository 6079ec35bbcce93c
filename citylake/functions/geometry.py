"""Planar geometry over closed rings (``array<struct<x:double,y:double>>``), as native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from citylake.functions.base import as_col, let

KM_PER_DEGREE = 111  # fixed value: degrees to kilometres
TOLERANCE = 1e-9


def ring_of(points: list[tuple[Column, Column]]) -> Column:
    return F.array(
        *[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points]
    )


def segments(ring: Column | str) -> Column:
    """Edges with their direction and squared length, which every measure needs."""
    ring = as_col(ring)
    n = F.greatest(F.size(ring) - 1, F.lit(0))

    def edge(a: Column, b: Column) -> Column:
        ends = F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"),
            (b["x"] - a["x"]).alias("dx"), (b["y"] - a["y"]).alias("dy"),
        )
        return let(
            ends,
            lambda e: F.struct(
                e["x1"], e["y1"], e["x2"], e["y2"], e["dx"], e["dy"],
                (e["dx"] * e["dx"] + e["dy"] * e["dy"]).alias("l2"),
            ),
        )

    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), edge)


def box(ring: Column | str) -> Column:
    ring = as_col(ring)
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def _gap2(x: Column, y: Column, s: Column) -> Column:
    """Squared distance from a point to a segment.

    Everything the inner lambda needs is handed over in its argument: Spark compares nested
    lambdas without regard to which outer variables they use, and may take two for the same.
    """
    along = F.try_divide((x - s["x1"]) * s["dx"] + (y - s["y1"]) * s["dy"], s["l2"])
    known = F.struct(
        # greatest and least skip the null of a segment without length.
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)).alias("t"),
        (x - s["x1"]).alias("x"), (y - s["y1"]).alias("y"),
        s["dx"].alias("dx"), s["dy"].alias("dy"),
    )

    def square(k: Column) -> Column:
        gx, gy = k["x"] - k["t"] * k["dx"], k["y"] - k["t"] * k["dy"]
        return gx * gx + gy * gy

    return let(known, square)


def _least(items: Column, measure: Callable[[Column], Column]) -> Column:
    return F.aggregate(
        items, F.lit(float("inf")).cast("double"), lambda acc, s: F.least(acc, measure(s))
    )


def point_boundary(x: Column | str, y: Column | str, ring: Column | str) -> Column:
    """Distance from a point to a ring's boundary; not zero inside."""
    start = F.struct(as_col(x).alias("x"), as_col(y).alias("y"))
    return F.sqrt(
        let(start, lambda p: _least(segments(ring), lambda s: _gap2(p["x"], p["y"], s)))
    )


def km_points(x1: Column | str, y1: Column | str, x2: Column | str, y2: Column | str) -> Column:
    return distance(as_col(x1), as_col(y1), as_col(x2), as_col(y2)) * KM_PER_DEGREE


def km_point_polygon(x: Column | str, y: Column | str, ring: Column | str) -> Column:
    return point_boundary(x, y, ring) * KM_PER_DEGREE


def centroid(ring: Column | str) -> Column:
    """Area centroid; the mean vertex when the ring encloses no area."""
    ring = as_col(ring)
    first = F.get(ring, F.lit(0))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, s: Column, p: Column) -> Column:
        # Relative to the first vertex, which keeps precision for large coordinates.
        ax, ay, bx, by = s["x1"] - p["x"], s["y1"] - p["y"], s["x2"] - p["x"], s["y2"] - p["y"]
        cross = ax * by - bx * ay
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (ax + bx) * cross).alias("x"),
            (acc["y"] + (ay + by) * cross).alias("y"),
        )

    def finish(sums: Column, p: Column) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(1))
        vertices = F.slice(ring, F.lit(1), n)

        def total(axis: str) -> Column:
            return F.aggregate(vertices, F.lit(0.0), lambda acc, q: acc + q[axis])

        mean = [total("x") / n, total("y") / n]
        flat = sums["a"] == 0
        return F.struct(
            F.when(flat, mean[0]).otherwise(p["x"] + F.try_divide(sums["x"], sums["a"] * 3)).alias("x"),
            F.when(flat, mean[1]).otherwise(p["y"] + F.try_divide(sums["y"], sums["a"] * 3)).alias("y"),
        )

    return let(
        first,
        lambda p: let(
            F.aggregate(segments(ring), zero, lambda acc, s: add(acc, s, p)),
            lambda sums: finish(sums, p),
        ),
    )
