"""Shapes of several parts with holes: ``array<array<ring>>``, each part its outer ring, then its holes.

A ring is an ``array<struct<x:double,y:double>>``; open rings are closed. A point is inside where a ray from it meets the
rings of all parts an odd number of times, so neither the order of vertices nor that of rings matters.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from citylake.functions import geometry as G
from citylake.functions.base import as_col, let

SHAPE = "array<array<array<struct<x:double,y:double>>>>"
SURFACES = ("Polygon", "MultiPolygon")  # fixed values


def closed_ring(ring: Column) -> Column:
    """The ring with its first vertex repeated at the end."""
    open_ = F.get(ring, F.lit(0)) != F.get(ring, F.size(ring) - 1)
    return F.when(open_, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def shape_of_ring(ring: Column | str) -> Column:
    """A shape of one part without holes."""
    return F.array(F.array(as_col(ring)))


def closed(shape: Column | str) -> Column:
    """All rings closed; rings without three different vertices go, and parts without rings."""

    def rings(part: Column) -> Column:
        return F.filter(F.transform(part, closed_ring), lambda r: F.size(r) >= 4)

    return F.filter(F.transform(as_col(shape), rings), lambda part: F.size(part) > 0)


def rings(shape: Column | str) -> Column:
    return F.flatten(as_col(shape))


def edges(shape: Column | str) -> Column:
    """Edges of all rings."""
    return F.flatten(F.transform(rings(shape), G.segments))


def box(shape: Column | str) -> Column:
    return G.box(F.flatten(rings(shape)))


def _moments(ring: Column) -> Column:
    """Twice the area of a ring, its first moments (times six), both positive, and the vertex they are relative to."""
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("a", "x", "y")])

    def add(acc: Column, s: Column) -> Column:
        ax, ay, bx, by = s["x1"] - s["ox"], s["y1"] - s["oy"], s["x2"] - s["ox"], s["y2"] - s["oy"]
        cross = ax * by - bx * ay
        return F.struct(
            (acc["a"] + cross).alias("a"), (acc["x"] + (ax + bx) * cross).alias("x"), (acc["y"] + (ay + by) * cross).alias("y")
        )

    def measured(k: Column) -> Column:
        # The origin goes along with each edge: inner lambdas see only their arguments.
        placed = F.transform(k["edges"], lambda s: F.struct(s["x1"], s["y1"], s["x2"], s["y2"], k["ox"].alias("ox"), k["oy"].alias("oy")))
        sums = F.aggregate(placed, zero, add)
        return let(F.struct(sums.alias("s"), k["ox"].alias("ox"), k["oy"].alias("oy")), lambda m: F.struct(
            *[(m["s"][c] * F.signum(m["s"]["a"])).alias(c) for c in ("a", "x", "y")], m["ox"], m["oy"]
        ))

    first = F.get(ring, F.lit(0))
    return let(F.struct(G.segments(ring).alias("edges"), first["x"].alias("ox"), first["y"].alias("oy")), measured)


def centroid(shape: Column | str) -> Column:
    """Centroid of the area of all parts less their holes; the mean vertex where there is no area."""
    shape = as_col(shape)
    names = ("a", "x", "y", "ox", "oy")

    def signed(part: Column) -> Column:
        # Outer rings count as area, holes against it, whichever way they turn.
        return F.transform(F.transform(part, _moments), lambda m, i: F.struct(
            *[(m[c] if c[0] == "o" else F.when(i == 0, m[c]).otherwise(-m[c])).alias(c) for c in names]
        ))

    vertices = F.flatten(F.transform(rings(shape), lambda r: F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(1)))))

    def total(items: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda acc, q: acc + of(q))

    def finish(k: Column) -> Column:
        area = total(k["m"], lambda q: q["a"])
        # A ring's moments are relative to its own first vertex.
        moment = {c: total(k["m"], lambda q, c=c: q[c] / 3 + q["a"] * q["o" + c]) for c in "xy"}
        mean = {c: total(k["v"], lambda q, c=c: q[c]) / F.size(k["v"]) for c in "xy"}
        return F.struct(*[F.when(area == 0, mean[c]).otherwise(F.try_divide(moment[c], area)).alias(c) for c in "xy"])

    known = F.struct(F.flatten(F.transform(shape, signed)).alias("m"), vertices.alias("v"))
    return F.when(F.size(shape) > 0, let(known, finish))


def contains(shape: Column | str, x: Column, y: Column) -> Column:
    """Whether a point is inside, by the even-odd rule over all rings."""
    at = F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    def odd(s: Column) -> Column:
        seen = F.transform(s["edges"], lambda e: F.struct(e.alias("e"), s["x"].alias("x"), s["y"].alias("y")))
        meets = F.filter(seen, lambda k: ((k["e"]["y1"] > k["y"]) != (k["e"]["y2"] > k["y"])) & (
            k["x"] < k["e"]["x1"] + k["e"]["dx"] * F.try_divide(k["y"] - k["e"]["y1"], k["e"]["dy"])
        ))
        return F.size(meets) % 2 == 1

    known = F.struct(edges(shape).alias("edges"), at["x"].alias("x"), at["y"].alias("y"))
    return let(known, odd)


def point_boundary(x: Column, y: Column, shape: Column | str) -> Column:
    """Distance from a point to the nearest ring; not zero inside."""
    start = F.struct(x.alias("x"), y.alias("y"))
    found = let(start, lambda p: G._least(edges(shape), lambda s: G._gap2(p["x"], p["y"], s)))
    return F.sqrt(F.nullif(found, F.lit(float("inf"))))


def km_point_shape(x: Column, y: Column, shape: Column | str) -> Column:
    return point_boundary(x, y, shape) * G.KM_PER_DEGREE


def probes(shape: Column | str) -> Column:
    """Points by which a shape is found inside another: a vertex of each ring and an inner point of each part."""
    shape = as_col(shape)
    starts = F.transform(rings(shape), lambda r: F.struct(r[0]["x"].alias("x"), r[0]["y"].alias("y")))

    def inner(part: Column) -> Column:
        # The middle of the first span on a line between the two lowest heights of vertices.
        heights = F.array_sort(F.array_distinct(F.transform(F.flatten(part), lambda p: p["y"])))
        height = (F.get(heights, F.lit(0)) + F.get(heights, F.lit(1))) / 2

        def span(k: Column) -> Column:
            seen = F.transform(k["edges"], lambda e: F.struct(e.alias("e"), k["y"].alias("y")))
            hit = F.filter(seen, lambda s: (s["e"]["y1"] > s["y"]) != (s["e"]["y2"] > s["y"]))
            xs = F.array_sort(F.transform(hit, lambda s: s["e"]["x1"] + s["e"]["dx"] * F.try_divide(s["y"] - s["e"]["y1"], s["e"]["dy"])))
            return let(xs, lambda v: F.struct(((F.get(v, F.lit(0)) + F.get(v, F.lit(1))) / 2).alias("x"), k["y"].alias("y")))

        return let(F.struct(F.flatten(F.transform(part, G.segments)).alias("edges"), height.alias("y")), span)

    found = F.concat(starts, F.transform(shape, inner))
    return F.filter(found, lambda p: p["x"].isNotNull() & p["y"].isNotNull())


#: An edge as columns: its ends, its direction and its squared length.
EDGE = ("x1", "y1", "x2", "y2", "dx", "dy", "l2")
Edge = dict[str, Column]


def gap2(px: Column, py: Column, s: Edge) -> Column:
    """Squared distance from a point to an edge."""
    ax, ay = px - s["x1"], py - s["y1"]
    dot, cross = ax * s["dx"] + ay * s["dy"], ax * s["dy"] - ay * s["dx"]
    bx, by = px - s["x2"], py - s["y2"]
    ends = F.least(ax * ax + ay * ay, bx * bx + by * by)
    return F.when((dot > 0) & (dot < s["l2"]), cross * cross / s["l2"]).otherwise(ends)


def along(px: Column, py: Column, s: Edge) -> Column:
    """Where on an edge, from 0 to 1, the point nearest to ``px``, ``py`` lies."""
    t = F.coalesce(F.try_divide((px - s["x1"]) * s["dx"] + (py - s["y1"]) * s["dy"], s["l2"]), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def edge_pair(s: Edge, t: Edge, eps: float = 0.0) -> Column:
    """``gap2``, the squared distance of two edges, and whether they ``cross`` at a point farther than ``eps`` from their ends.

    Computed on batches of numbers: as an expression it makes a method too long for the JVM to compile.
    """

    def batch(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series, f: pd.Series, g: pd.Series, h: pd.Series) -> pd.DataFrame:
        p, q, r, u = (np.stack([x.to_numpy(), y.to_numpy()]) for x, y in ((a, b), (c, d), (e, f), (g, h)))

        def cross(v, w):
            return v[0] * w[1] - v[1] * w[0]

        def gap2(point, start, end):
            way = end - start
            square = (way**2).sum(axis=0)
            t = np.clip(((point - start) * way).sum(axis=0) / np.where(square > 0, square, 1), 0, 1)
            return ((point - start - t * way) ** 2).sum(axis=0)

        def apart(start, end, one, two):
            sides = np.stack([cross(end - start, one - start), cross(end - start, two - start)])
            margin = np.sqrt(((end - start) ** 2).sum(axis=0))
            return sides.min(axis=0), sides.max(axis=0), margin

        ways = [apart(p, q, r, u), apart(r, u, p, q)]
        meet, proper = (np.logical_and.reduce([(low < -m * k) & (high > m * k) for low, high, m in ways]) for k in (0.0, eps))
        least = np.minimum.reduce([gap2(p, r, u), gap2(q, r, u), gap2(r, p, q), gap2(u, p, q)])
        return pd.DataFrame({"gap2": np.where(meet, 0.0, least), "cross": proper})

    measure = F.pandas_udf(batch, "gap2 double, cross boolean")
    return measure(*[e[c] for e in (s, t) for c in ("x1", "y1", "x2", "y2")])
