"""Relations of shapes as joins and aggregates over their edges; no task holds the edges of two shapes against each other."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.functions import geometry as G
from citylake.functions import shapes as S
from citylake.operators.joins import lookup
from citylake.operators.schema import named
from citylake.session import materialise

#: An edge as it is shuffled and written.
ENDS = ("x1", "y1", "x2", "y2")
#: Fewest edges of a chunk; larger shapes have chunks of the root of their edges.
CHUNK = 16


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size).cast("long")


def _box(ends: S.Edge, eps: float) -> S.Edge:
    """Corners of an edge's box, widened by ``eps``."""
    low = {f"{c}0": F.least(ends[f"{c}1"], ends[f"{c}2"]) - eps for c in "xy"}
    return {**low, **{f"{c}9": F.greatest(ends[f"{c}1"], ends[f"{c}2"]) + eps for c in "xy"}}


def _cover(box: S.Edge, size: Column) -> Column:
    """Grid cells of side ``size`` that a box meets."""

    def span(low: str, high: str) -> Column:
        return F.sequence(_cell(box[low], size), _cell(box[high], size))

    return F.flatten(
        F.transform(
            span("x0", "x9"),
            lambda cx: F.transform(span("y0", "y9"), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))),
        )
    )


def meeting_edges(edges: DataFrame, eps: float) -> DataFrame:
    """Pairs of edges (``grp``, ``owner``, ``no`` and ends) of one ``grp`` and different ``owner`` whose boxes meet, each once.

    ``l_`` and ``r_`` columns, the lesser owner left. A box owns the grid level whose cells are just wider than
    it, so it covers at most four of them. It is matched on that level and on every coarser one in use:
    small boxes in a dense area meet on fine cells and are not all paired through one big cell. A pair is emitted
    only from the cell that holds the lower corner of the boxes' overlap, so no distinct follows. Edges of one
    level meet in a self-join of one shuffle; only ends are shuffled, boxes follow from them.
    """
    box = _box(_ends(""), eps)
    side = F.greatest(box["x9"] - box["x0"], box["y9"] - box["y0"])
    edges = edges.withColumn("level", F.ceil(F.log2(F.greatest(side, F.lit(1e-12)))).cast("int"))
    # One small integer per power of two present in the data.
    levels = sorted(r.level for r in edges.select("level").distinct().collect() if r.level is not None)
    columns = ["owner", "no", *ENDS]

    def placed(rows: DataFrame, at: Column) -> DataFrame:
        rows = rows.select("grp", *columns, at.alias("at"))
        rows = rows.select("*", F.explode(_cover(box, F.pow(F.lit(2.0), F.col("at")))).alias("c"))
        return rows.select("grp", "at", "c.cx", "c.cy", *columns)

    own = placed(edges, F.col("level"))

    def met(left: DataFrame, once: Column) -> DataFrame:
        l, r = _box(_ends("l."), eps), _box(_ends("r."), eps)
        size = F.pow(F.lit(2.0), F.col("l.at"))
        cell = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("grp", "at", "cx", "cy")]
        meet = [(l[f"{c}0"] <= r[f"{c}9"]) & (r[f"{c}0"] <= l[f"{c}9"]) for c in "xy"]
        here = [_cell(F.greatest(l[f"{c}0"], r[f"{c}0"]), size) == F.col(f"l.c{c}") for c in "xy"]
        pairs = left.alias("l").join(own.alias("r"), reduce(and_, [*cell, *meet, *here, once]))
        ordered = F.col("l.owner") < F.col("r.owner")
        sides = [F.when(ordered, F.col(f"{s}.{c}")).otherwise(F.col(f"{t}.{c}")).alias(f"{s}_{c}") for s, t in ("lr", "rl") for c in columns]
        return pairs.select(F.col("l.grp").alias("grp"), *sides)

    pairs = met(own, F.col("l.owner") < F.col("r.owner"))
    if len(levels) > 1:
        coarser = F.explode(F.filter(F.array(*map(F.lit, levels)), lambda v: v > F.col("level")))
        pairs = pairs.unionByName(met(placed(edges, coarser), F.col("l.owner") != F.col("r.owner")))
    return pairs


def _ends(prefix: str) -> S.Edge:
    return {c: F.col(prefix + c) for c in ENDS}


def _edge(prefix: str) -> S.Edge:
    """An edge with its direction and squared length, from its ends."""
    e = _ends(prefix)
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    return {**e, "dx": dx, "dy": dy, "l2": dx * dx + dy * dy}


def touching(shapes: DataFrame, eps: float = G.TOLERANCE) -> DataFrame:
    """``grp``, ``a``, ``b`` (a < b) of shapes (``grp``, ``owner``, ``shape``) of one group that touch.

    Boundaries meet and interiors do not. Edges meet on a grid. A crossing settles a pair; for the others, points that
    would be inside if interiors met are tested against the other shape: the middles of the pieces into which
    meeting edges are cut, a vertex of each ring, an inner point of each part. A shape's edges are cut
    into strips for that, so a point meets only the edges beside it. ``shapes`` is read several times: give a written
    table, and short owners, since each met edge is written with them.
    """
    shapes = shapes.select("grp", "owner", S.closed("shape").alias("shape")).where(F.size("shape") > 0)
    edges = shapes.select("grp", "owner", F.posexplode(S.edges("shape")).alias("no", "e")).select("grp", "owner", "no", *[f"e.{c}" for c in ENDS])
    near = meeting_edges(edges, eps).withColumn("is", S.edge_pair(_ends("l_"), _ends("r_"), eps))
    near = near.where((F.col("is.gap2") <= eps * eps) | F.col("is.cross")).withColumn("cross", F.col("is.cross"))
    met = materialise(near.drop("is"), "meeting")
    pairs = met.groupBy("grp", "l_owner", "r_owner").agg(F.bool_or("cross").alias("cross")).where("NOT cross")
    pairs = materialise(pairs.select("grp", F.col("l_owner").alias("a"), F.col("r_owner").alias("b")), "met")
    boxes = shapes.select("grp", "owner", S.box("shape").alias("box"))

    def both_ways(df: DataFrame) -> DataFrame:
        back = df.select("grp", F.col("b").alias("a"), F.col("a").alias("b"))
        return df.unionByName(back)

    def side(name: str) -> DataFrame:
        return boxes.select(F.col("grp").alias("_grp"), F.col("owner").alias("_owner"), F.col("box").alias(name))

    of = lambda c: {"_grp": F.col("grp"), "_owner": F.col(c)}
    # Boxes that share no area leave no room for an overlap.
    open_ = lookup(pairs, side("p"), of("a"), "inner").drop("_grp", "_owner")
    open_ = lookup(open_, side("q"), of("b"), "inner").drop("_grp", "_owner")
    open_ = open_.where("p.x1 > q.x0 AND q.x1 > p.x0 AND p.y1 > q.y0 AND q.y1 > p.y0").select("grp", "a", "b")
    once = materialise(open_, "open")
    open_ = both_ways(once)
    wanted = materialise(open_.select("grp", F.col("a").alias("owner")).distinct(), "open-owners")

    # The edges of open pairs are cut; most pairs are settled by their boxes.
    left = [F.col("l_owner") == F.col("a"), F.col("r_owner") == F.col("b")]
    mine = once.withColumnRenamed("grp", "_grp")
    met = met.join(mine, reduce(and_, [F.col("grp") == F.col("_grp"), *left]), "left_semi")
    cuts = []
    for mine, other in (("l_", "r_"), ("r_", "l_")):
        e, f = _edge(mine), _ends(other)
        on = F.array(*[F.when(S.gap2(f[f"x{k}"], f[f"y{k}"], e) <= eps * eps, S.along(f[f"x{k}"], f[f"y{k}"], e)) for k in (1, 2)])
        cuts.append(met.select("grp", F.col(f"{mine}owner").alias("a"), F.col(f"{other}owner").alias("b"), F.col(f"{mine}no").alias("no"),
                               *[e[c].alias(c) for c in ENDS], F.array_compact(on).alias("t"), F.struct(*[f[c].alias(c) for c in ENDS]).alias("f")))
    cuts = materialise(cuts[0].unionByName(cuts[1]), "cuts")
    edge = ["grp", "a", "b", "no"]
    places = cuts.groupBy(*edge).agg(*[F.any_value(c).alias(c) for c in ENDS], F.flatten(F.collect_set("t")).alias("t"))
    at = F.array_sort(F.array_distinct(F.concat("t", F.array(F.lit(0.0), F.lit(1.0)))))
    middles = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda u, v: (u + v) / 2)
    pieces = places.select(*edge, *ENDS, F.explode(middles).alias("t"))
    pieces = pieces.select(*edge, *[(F.col(f"{c}1") + F.col("t") * _edge("")[f"d{c}"]).alias(f"p{c}") for c in "xy"])
    # A piece on the other boundary is not inside; what it lies on is among the edges that its edge meets.
    beside = pieces.join(cuts.select(*edge, "f"), edge)
    off = beside.groupBy("grp", "a", "b", "px", "py").agg(F.min(S.gap2(F.col("px"), F.col("py"), _edge("f."))).alias("gap2"))
    pieces = off.where(F.col("gap2") > eps * eps).select("grp", "a", "b", "px", "py")
    probes = shapes.join(wanted, ["grp", "owner"], "left_semi").select(F.col("grp").alias("_grp"), F.col("owner").alias("_owner"), S.probes("shape").alias("probes"))
    probes = lookup(open_, probes, of("a"), "inner").select("grp", "a", "b", F.explode("probes").alias("p"))
    points = pieces.unionByName(probes.select("grp", "a", "b", F.col("p.x").alias("px"), F.col("p.y").alias("py")))

    # As many strips as the root of the number of edges, in powers of two, across the way the edges spread most.
    edges = edges.join(wanted, ["grp", "owner"], "left_semi")
    spread = edges.groupBy("grp", "owner").agg(
        (F.var_pop(F.col("x1") + F.col("x2")) > F.var_pop(F.col("y1") + F.col("y2"))).alias("turn"),
        *[f(F.least(f"{c}1", f"{c}2") if k == "0" else F.greatest(f"{c}1", f"{c}2")).alias(f"{c}{k}") for c in "xy" for k, f in (("0", F.min), ("9", F.max))],
        F.count(F.lit(1)).alias("n"),
    )
    count = F.pow(F.lit(2.0), F.ceil(F.log2(F.sqrt(F.col("n").cast("double")))))
    low, high = (F.when(F.col("turn"), F.col(f"x{k}")).otherwise(F.col(f"y{k}")) for k in "09")
    strips = spread.select(F.col("grp").alias("_grp"), F.col("owner").alias("_owner"), "turn", low.alias("low"), high.alias("high"), ((high - low) / count).alias("height"))

    def strip(y: Column) -> Column:
        return F.coalesce(F.floor(F.try_divide(y - F.col("low"), F.col("height"))), F.lit(0)).cast("long")

    def turned(df: DataFrame, names: list[str]) -> DataFrame:
        """Coordinates exchanged where strips run the other way."""
        other = {n: n.translate(str.maketrans("xy", "yx")) for n in names}
        return df.withColumns({n: F.when(F.col("turn"), F.col(o)).otherwise(F.col(n)) for n, o in other.items()})

    banded = turned(lookup(edges, strips, of("owner"), "inner"), [*ENDS])
    rows = F.sequence(strip(F.least("y1", "y2") - eps), strip(F.greatest("y1", "y2") + eps))
    banded = banded.select("grp", F.col("owner").alias("b"), F.explode(rows).alias("strip"), *ENDS)
    placed = turned(lookup(points, strips, of("b"), "inner"), ["px", "py"]).where(F.col("py").between(F.col("low"), F.col("high")))
    placed = placed.select("grp", "a", "b", "px", "py", strip(F.col("py")).alias("strip"))
    e = _edge("")
    x = e["x1"] + e["dx"] * F.try_divide(F.col("py") - e["y1"], e["dy"])
    hit = ((e["y1"] > F.col("py")) != (e["y2"] > F.col("py"))) & (F.col("px") < x)
    inside = placed.join(banded, ["grp", "b", "strip"]).groupBy("grp", "a", "b", "px", "py", "strip").agg(
        F.count(F.when(hit, 1)).alias("hits"), F.min(S.gap2(F.col("px"), F.col("py"), e)).alias("gap2")
    ).where((F.col("hits") % 2 == 1) & (F.col("gap2") > eps * eps))
    overlap = inside.select("grp", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(overlap, ["grp", "a", "b"], "left_anti")


def _run(edges: str) -> Column:
    """Edges to a run: the root of their number, not fewer than ``CHUNK``."""
    return F.greatest(F.lit(CHUNK), F.ceil(F.sqrt(F.size(edges).cast("double")))).cast("int")


def _runs(rows: DataFrame, edges: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The edges of a column by ``_row`` and run, and the box and first vertex of each run."""
    each = rows.select("_row", _run(edges).alias("run"), F.posexplode(edges).alias("no", "e"))
    each = each.select("_row", F.floor(F.col("no") / F.col("run")).cast("int").alias(name), "no", F.struct(*[f"e.{c}" for c in S.EDGE]).alias(f"{name}_e"))
    ends = {f"{c}{k}": f(F.col(f"{name}_e.{c}1"), F.col(f"{name}_e.{c}2")) for c in "xy" for k, f in (("0", F.least), ("9", F.greatest))}
    first = F.min_by(F.struct(*[F.col(f"{name}_e.{c}1").alias(c) for c in "xy"]), "no")
    box = F.struct(*[(F.min(v) if k.endswith("0") else F.max(v)).alias(k) for k, v in ends.items()], first.alias("first"))
    return each.drop("no"), each.groupBy("_row", name).agg(box.alias(f"{name}_box"))


def _least_of(pairs: DataFrame, s: str, t: str) -> DataFrame:
    of = [{c: F.col(f"{e}.{c}") for c in S.EDGE} for e in (s, t)]
    return pairs.groupBy("_row").agg(F.sqrt(F.min(S.edge_pair(*of)["gap2"])).alias("_least"))


def with_boundary_distance(df: DataFrame, a: str, b: str, name: str = "distance") -> DataFrame:
    """``df`` with the least distance between the boundaries of two shapes; null without edges, zero where they meet.

    Shapes of few edges are compared edge by edge, one row each. For others, runs of edges bound the distance:
    no pair of runs whose boxes are farther apart than the nearest known vertices can hold it, and only edges of
    the pairs left are joined.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    edges = {f"_{k}": S.edges(S.closed(named(c))) for k, c in (("p", a), ("q", b))}
    rows = materialise(numbered.withColumns(edges), "rows")
    small = (F.size("_p") <= CHUNK) & (F.size("_q") <= CHUNK)
    few = rows.where(small).select("_row", F.explode("_p").alias("s"), "_q").select("_row", "s", F.explode("_q").alias("t"))
    many = rows.where(~small)
    (p, p_runs), (q, q_runs) = _runs(many, "_p", "i"), _runs(many, "_q", "j")
    pairs = p_runs.join(q_runs, "_row")
    gap = [F.greatest(F.lit(0.0), F.col(f"i_box.{c}0") - F.col(f"j_box.{c}9"), F.col(f"j_box.{c}0") - F.col(f"i_box.{c}9")) for c in "xy"]
    u, v = F.col("i_box.first"), F.col("j_box.first")
    pairs = pairs.select("_row", "i", "j", F.sqrt(gap[0] * gap[0] + gap[1] * gap[1]).alias("low"), G.distance(u["x"], u["y"], v["x"], v["y"]).alias("high"))
    most = pairs.groupBy(F.col("_row").alias("_key")).agg(F.min("high").alias("most"))
    # A hair of slack for rounding.
    kept = lookup(pairs, most, {"_key": F.col("_row")}, "inner").where(F.col("low") <= F.col("most") * (1 + 1e-9))
    many = kept.select("_row", "i", "j").join(p, ["_row", "i"]).join(q, ["_row", "j"])
    least = _least_of(few, "s", "t").unionByName(_least_of(many, "i_e", "j_e")).withColumnRenamed("_row", "_key")
    out = lookup(rows, least, {"_key": F.col("_row")}, "left")
    return out.select(*[named(c) for c in df.columns], F.col("_least").alias(name))


def with_km(df: DataFrame, a: str, b: str, name: str = "km") -> DataFrame:
    """Kilometres between two geometries ``struct<type, point, shape>`` by their types; any other type fails.

    Point to point, point to the boundary of a surface in either order, or between two boundaries.
    """
    kind = {c: named(c)["type"] for c in (a, b)}
    surface = {c: kind[c].isin(*S.SURFACES) for c in (a, b)}
    point = {c: kind[c] == "Point" for c in (a, b)}
    both = surface[a] & surface[b]
    columns = df.columns
    df = df.withColumns({f"_{k}": F.when(both, named(c)["shape"]) for k, c in (("p", a), ("q", b))})
    df = with_boundary_distance(df, "_p", "_q", "_gap")

    def to_surface(p: str, s: str) -> Column:
        at = named(p)["point"]
        return S.km_point_shape(at["x"], at["y"], named(s)["shape"])

    u, v = named(a)["point"], named(b)["point"]
    km = (
        F.when(point[a] & point[b], G.km_points(u["x"], u["y"], v["x"], v["y"]))
        .when(both, F.col("_gap") * G.KM_PER_DEGREE)
        .when(point[a] & surface[b], to_surface(a, b))
        .when(surface[a] & point[b], to_surface(b, a))
        .otherwise(F.raise_error(F.concat(F.lit("no distance between "), F.coalesce(kind[a], F.lit("null")), F.lit(" and "), F.coalesce(kind[b], F.lit("null")))).cast("double"))
    )
    return df.select(*[named(c) for c in columns], km.alias(name))


def with_touches(df: DataFrame, a: str, b: str, name: str = "touches", eps: float = G.TOLERANCE) -> DataFrame:
    """``df`` with whether the two shapes of a row touch; false where one is missing."""
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    sides = [rows.select(F.col("_row").alias("grp"), F.lit(k).alias("owner"), named(c).alias("shape")) for k, c in (("a", a), ("b", b))]
    found = touching(sides[0].unionByName(sides[1]).where("shape IS NOT NULL"), eps)
    found = found.select(F.col("grp").alias("_key"), F.lit(True).alias(name))
    out = lookup(rows, found, {"_key": F.col("_row")}, "left")
    return out.select(*[named(c) for c in df.columns], F.coalesce(F.col(name), F.lit(False)).alias(name))
