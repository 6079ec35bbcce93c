"""Geometry on shapes with known answers, and spatial joins against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citylake.functions import geometry as G
from citylake.functions import shapes as S
from citylake.operators import geo, shapes

RING = "array<struct<x:double,y:double>>"


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


UNIT = [(float(x), float(y)) for x, y in box(0, 0, 1, 1)]
# Two arms that leave a notch between x = 1 and x = 2 open at the top.
CUP = [(0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3), (0, 0)]

TOUCH = [
    ("shared edge", UNIT, box(1, 0, 2, 1), True),
    ("corner", UNIT, box(1, 1, 2, 2), True),
    ("corner on an edge", UNIT, [(1, 0.5), (2, 0), (2, 1), (1, 0.5)], True),
    ("part of an edge", UNIT, box(1, 0.25, 2, 0.75), True),
    ("apart", UNIT, box(3, 0, 4, 1), False),
    ("overlap", UNIT, box(0.5, 0.5, 2, 2), False),
    ("same", UNIT, UNIT, False),
    ("same, other start", UNIT, [UNIT[1], UNIT[2], UNIT[3], UNIT[0], UNIT[1]], False),
    ("same, extra vertex", UNIT, [(0, 0), (0.5, 0), (1, 0), (1, 1), (0, 1), (0, 0)], False),
    ("inside, apart", box(0, 0, 9, 9), box(3, 3, 4, 4), False),
    ("inside, at the edge", box(0, 0, 9, 9), box(0, 3, 4, 4), False),
    ("half of it", UNIT, box(0, 0, 0.5, 1), False),
    ("cross", box(0, 1, 3, 2), box(1, 0, 2, 3), False),
    ("fills the notch", CUP, box(1, 1, 2, 3), True),
    ("in the notch, apart", CUP, box(1.25, 1.5, 1.75, 2), False),
    ("spans the arms", CUP, box(0, 2, 3, 3), False),
    ("bridge on top", CUP, box(0, 3, 3, 4), True),
    ("diagonal through corners", UNIT, [(-1, 1), (0, 1), (1, 0), (1, -1), (-1, -1), (-1, 1)], False),
]


def test_touches(spark):
    data = [(n, _floats(a), _floats(b)) for n, a, b, _ in TOUCH]
    df = spark.createDataFrame(data, f"n string, a {RING}, b {RING}").coalesce(1)
    df = df.select("n", S.shape_of_ring("a").alias("a"), S.shape_of_ring("b").alias("b"))
    got = shapes.with_touches(shapes.with_touches(df, "a", "b", "ab"), "b", "a", "ba").collect()
    assert sorted((r.n, r.ab, r.ba) for r in got) == sorted((n, t, t) for n, _, _, t in TOUCH)


FRAME = [[box(0, 0, 4, 4), box(1, 1, 3, 3)[::-1]]]
TWO = [[box(0, 0, 1, 1)], [box(5, 0, 6, 1)]]
#: Parts with holes: name, shapes, whether they touch, distance of their boundaries.
PARTS = [
    ("island fills the hole", FRAME, [[box(1, 1, 3, 3)]], True, 0.0),
    ("island in the hole, apart", FRAME, [[box(1.5, 1.5, 2.5, 2.5)]], False, 0.5),
    ("island at one side of the hole", FRAME, [[box(1, 1.5, 2, 2.5)]], True, 0.0),
    ("island over the hole", FRAME, [[box(0.5, 1, 3, 3)]], False, 0.0),
    ("block over all", FRAME, [[box(0, 0, 4, 4)]], False, 0.0),
    ("same frame", FRAME, FRAME, False, 0.0),
    ("frame, holes in another order of vertices", FRAME, [[box(0, 0, 4, 4), box(1, 1, 3, 3)]], False, 0.0),
    ("between two parts", TWO, [[box(1, 0, 5, 1)]], True, 0.0),
    ("touches one part, overlaps another", TWO, [[box(1, 0, 5.5, 1)]], False, 0.0),
    ("touches one part, has another inside", TWO, [[box(1, 0, 2, 1)], [box(4, -1, 7, 2)]], False, 0.0),
    ("touches one part, is another", TWO, [[box(1, 0, 2, 1)], [box(5, 0, 6, 1)]], False, 0.0),
    ("part in the hole, part outside", FRAME, [[box(1, 1, 3, 3)], [box(4, 0, 5, 4)]], True, 0.0),
    ("apart", TWO, [[box(2, 3, 3, 4)]], False, math.sqrt(5)),
    ("no shape", TWO, None, False, None),
]


def _shape(parts):
    return parts and [[_floats(r) for r in part] for part in parts]


def test_shapes_of_several_parts_with_holes(spark):
    data = [(n, _shape(a), _shape(b)) for n, a, b, _, _ in PARTS]
    df = spark.createDataFrame(data, f"n string, a {S.SHAPE}, b {S.SHAPE}")
    df = shapes.with_touches(shapes.with_touches(df, "a", "b", "ab"), "b", "a", "ba")
    got = {r.n: r for r in shapes.with_boundary_distance(df, "a", "b").collect()}
    for n, _, _, touch, gap in PARTS:
        assert (got[n].ab, got[n].ba) == (touch, touch), n
        assert got[n].distance == gap or abs(got[n].distance - gap) < 1e-12, n


def test_centroid_and_inside_of_shapes(spark):
    off = [[box(0, 0, 4, 4), box(2, 2, 4, 4)], [box(10, 0, 12, 2)[::-1]]]
    df = spark.createDataFrame([(_shape(off),), (_shape([[[(0, 0), (2, 0), (4, 0), (0, 0)]]]),), (None,), ([],)], f"s {S.SHAPE}")
    rows = df.select(S.centroid("s").alias("c"), S.contains("s", F.lit(3.0), F.lit(3.0)).alias("hole"), S.contains("s", F.lit(11.0), F.lit(1.0)).alias("part"),
                     S.point_boundary(F.lit(11.0), F.lit(1.0), "s").alias("gap")).collect()
    # Areas 16 - 4 + 4 with centres (2, 2), (3, 3), (11, 1).
    assert abs(rows[0].c.x - (32 - 12 + 44) / 16) < 1e-12 and abs(rows[0].c.y - (32 - 12 + 4) / 16) < 1e-12
    assert (rows[0].hole, rows[0].part, rows[0].gap) == (False, True, 1.0)
    assert tuple(rows[1].c) == (2.0, 0.0)
    assert rows[2].c is None and rows[3].c is None and rows[3].gap is None


def test_kilometres_by_type(spark):
    point = ("Point", (3.0, 0.5), None)
    area = ("MultiPolygon", None, _shape(TWO))
    other = ("Polygon", None, _shape([[box(1, 3, 2, 4)]]))
    schema = f"type string, point struct<x:double,y:double>, shape {S.SHAPE}"
    df = spark.createDataFrame([(1, point, ("Point", (3.0, 4.5), None)), (2, point, area), (3, area, point), (4, area, other)],
                               f"n int, a struct<{schema}>, b struct<{schema}>".replace("type string, point struct<x:double,y:double>, shape ", "type:string,point:struct<x:double,y:double>,shape:"))
    got = {r.n: r.km for r in shapes.with_km(df, "a", "b").collect()}
    assert got == {1: 444.0, 2: 222.0, 3: 222.0, 4: 222.0}
    bad = df.where("n = 1").withColumn("a", F.struct(F.lit("LineString").alias("type"), F.col("a.point").alias("point"), F.col("a.shape").alias("shape")))
    with pytest.raises(Exception, match="no distance between LineString and Point"):
        shapes.with_km(bad, "a", "b").collect()


def test_random_stars_against_pairs_of_edges(spark):
    """Distances of jagged shapes against every pair of edges, and long borders in bounded memory."""
    draw = random.Random(4)

    def star(cx, cy, n, low=0.5):
        at = [(draw.uniform(low, 1.0), 2 * math.pi * k / n) for k in range(n)]
        ring = [(cx + r * math.cos(t), cy + r * math.sin(t)) for r, t in at]
        return ring + ring[:1]

    pairs = [(k, [[star(0, 0, draw.choice([5, 60, 300]))]], [[star(draw.uniform(1, 4), draw.uniform(1, 4), draw.choice([4, 90]))]]) for k in range(12)]
    df = spark.createDataFrame([(k, _shape(a), _shape(b)) for k, a, b in pairs], f"k int, a {S.SHAPE}, b {S.SHAPE}")
    got = {r.k: r.distance for r in shapes.with_boundary_distance(df, "a", "b").collect()}

    def gap(p, a, b):
        (px, py), (ax, ay), (bx, by) = p, a, b
        d = (bx - ax) ** 2 + (by - ay) ** 2
        t = max(0, min(1, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / d)) if d else 0
        return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))

    def cross(a, b, c, d):
        side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0

    for k, a, b in pairs:
        want = math.inf
        for p, q in zip(a[0][0], a[0][0][1:]):
            for u, v in zip(b[0][0], b[0][0][1:]):
                want = 0 if cross(p, q, u, v) else min(want, gap(p, u, v), gap(q, u, v), gap(u, p, q), gap(v, p, q))
        assert abs(got[k] - want) < 1e-9
    # A border of 2,000 points shared by two shapes, and its distance to a third.
    border = [(k / 2_000, draw.uniform(0, 0.001)) for k in range(2_001)]
    north = [border + [(1, 1), (0, 1), border[0]]]
    south = [border + [(1, -1), (0, -1), border[0]]]
    far = [[[(x, y + 1.5) for x, y in border] + [(1, 3), (0, 3), (0, border[0][1] + 1.5)]]]
    df = spark.createDataFrame([(_shape([north[0] and [north[0]]]), _shape([[south[0]]]), _shape(far))], f"a {S.SHAPE}, b {S.SHAPE}, c {S.SHAPE}")
    row = shapes.with_boundary_distance(shapes.with_touches(df, "a", "b"), "a", "c").first()
    assert row.touches is True and abs(row.distance - (0.5 + min(y for _, y in border))) < 1e-3


def test_shapes_piled_on_one_cell(spark):
    """Many copies and many small shapes in one place of a large one."""
    rows = [(k, _floats(box(k * 0.01, 0, k * 0.01 + 0.01, 0.01))) for k in range(60)] + [(1000 + k, _floats(box(0, 0.01, 50, 60))) for k in range(3)]
    df = spark.createDataFrame(rows, f"COD_POSTAL int, ring {RING}")
    got = {(r.COD_POSTAL_1, r.COD_POSTAL_2) for r in geo.touching_pairs(df).collect()}
    row = {(a, b) for a in range(60) for b in range(60) if abs(a - b) == 1}
    big = {p for a in range(60) for k in range(3) for p in ((a, 1000 + k), (1000 + k, a))}
    assert got == row | big


def _floats(ring):
    return [(float(x), float(y)) for x, y in ring]


def test_distances(spark):
    df = spark.createDataFrame([(_floats(UNIT), _floats(box(3, 0, 4, 1)))], f"a {RING}, b {RING}")
    row = df.select(
        G.km_point_polygon(F.lit(0.5), F.lit(0.5), "a").alias("inside"),
        G.km_point_polygon(F.lit(2.0), F.lit(1.0), "a").alias("outside"),
        G.km_points(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(4.0)).alias("points"),
    ).first()
    assert tuple(row) == (55.5, 111.0, 555.0)


def test_distances_of_rings(spark):
    rows = [(1, UNIT, box(3, 0, 4, 1)), (2, UNIT, UNIT), (3, box(0, 1, 3, 2), box(1, 0, 2, 3))]
    df = spark.createDataFrame([(k, _floats(a), _floats(b)) for k, a, b in rows], f"k int, a {RING}, b {RING}")
    df = df.select("k", S.shape_of_ring("a").alias("a"), S.shape_of_ring("b").alias("b"))
    got = {r.k: r.distance for r in shapes.with_boundary_distance(df, "a", "b").collect()}
    assert got == {1: 2.0, 2: 0.0, 3: 0.0}


@pytest.mark.parametrize(
    "ring, expected",
    [
        ([(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)], (1.0, 0.5)),
        ([(0, 0), (0, 1), (2, 1), (2, 0), (0, 0)], (1.0, 0.5)),
        ([(0, 0), (2, 0), (4, 0), (0, 0)], (2.0, 0.0)),
    ],
)
def test_centroid(spark, ring, expected):
    df = spark.createDataFrame([(_floats(ring),)], f"r {RING}")
    assert tuple(df.select(G.centroid("r").alias("c")).first().c) == pytest.approx(expected)


def squares(spark, n, side=1.0):
    data = [
        (str(i * n + j), _floats(box(j * side, i * side, (j + 1) * side, (i + 1) * side)))
        for i in range(n)
        for j in range(n)
    ]
    return spark.createDataFrame(data, f"COD_POSTAL string, ring {RING}")


def test_grid_of_squares(spark):
    pairs = [tuple(r) for r in geo.adjacency(squares(spark, 3)).collect()]
    assert len(pairs) == 40
    assert sum(1 for p in pairs if p[2] == 1.0) == 24
    assert sum(1 for p in pairs if math.isclose(p[2], math.sqrt(2))) == 16
    assert {(b, a) for a, b, _ in pairs} == {(a, b) for a, b, _ in pairs}


def test_copies_and_mixed_sizes(spark):
    """Copies of one outline are not paired with each other; sizes may differ widely."""
    big = spark.createDataFrame([("big", _floats(box(3, 0, 13, 10)))], f"COD_POSTAL string, ring {RING}")
    copies = spark.createDataFrame(
        [(f"copy{i}", _floats(box(0, 0, 1, 1))) for i in range(30)], f"COD_POSTAL string, ring {RING}"
    )
    got = {tuple(r) for r in geo.touching_pairs(squares(spark, 3).unionByName(big).unionByName(copies)).collect()}
    near_origin = {"1", "3", "4"}
    expected = {(f"copy{i}", k) for i in range(30) for k in near_origin}
    expected |= {("big", k) for k in ("2", "5", "8")}
    expected |= {tuple(r)[:2] for r in geo.touching_pairs(squares(spark, 3)).collect()}
    assert got == expected | {(b, a) for a, b in expected}


def test_touch_join_has_no_pairwise_join(spark):
    plan = geo.adjacency(squares(spark, 2))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("cluster", [False, True])
def test_reverse_geocode_matches_brute_force(spark, cluster):
    """With a cluster, most places sit in one tiny area and the grid has to be refined."""
    rng = random.Random(11)
    places = []
    for i in range(400):
        if cluster and i % 4:
            xy = (3 + rng.random() * 1e-3, 3 + rng.random() * 1e-3)
        else:
            xy = (rng.uniform(-5, 5), rng.uniform(-5, 5))
        places.append((f"a{i}", f"z{i % 50}", xy[1], xy[0]))
    hotels = [(i, rng.uniform(-6, 6), rng.uniform(-6, 6)) for i in range(200)]
    hotels += [(1000 + i, 3.0005, 3.0005) for i in range(50)] + [(2000, None, 1.0), (2001, 1.0, float("nan"))]
    hotels += [(3000 + i, 2.9 + rng.random() / 5, 2.9 + rng.random() / 5) for i in range(100)]
    df = spark.createDataFrame(hotels, "id int, property_latitude double, property_longitude double")
    book = spark.createDataFrame(places, "address string, postcode string, latitude double, longitude double")
    reach = 0.9
    got = {r.id: (r.property_address, r.property_postalcode) for r in geo.reverse_geocode(df, book, reach=reach).collect()}
    expected = {}
    for i, lat, lon in hotels:
        best = None
        if lat is not None and lon is not None and not math.isnan(lon):
            for a, z, y, x in places:
                gap = math.sqrt((x - lon) * (x - lon) + (y - lat) * (y - lat))
                if gap <= reach and (best is None or (gap, a, z) < best):
                    best = (gap, a, z)
        expected[i] = best[1:] if best else (None, None)
    assert got == expected
    depth = geo._depth(geo._sites(book, "latitude", "longitude", ["address", "postcode"]), reach)
    assert depth > 3 if cluster else depth < 3


def test_open_rings_are_closed(spark):
    """Two triangles on one edge touch, whether their rings are closed or not; a line is reported."""
    shape = "COD_POSTAL string, ring array<struct<x: double, y: double>>"
    one, two = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)], [(1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    rows = [("a", one), ("b", [*two, two[0]]), ("c", [(5.0, 5.0), (6.0, 6.0)]), ("d", None)]
    df = spark.createDataFrame(rows, shape)
    pairs = {tuple(r) for r in geo.touching_pairs(df).collect()}
    assert pairs == {("a", "b"), ("b", "a")}
    assert {tuple(r) for r in geo.invalid_rings(df).collect()} == {
        ("c", "fewer than three vertices"), ("d", "no ring"),
    }
