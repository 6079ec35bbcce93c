"""Spatial joins by grid: touching polygons, adjacency graph, nearest place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.functions import geometry as G
from citylake.functions import shapes as S
from citylake.operators.filters import is_known
from citylake.operators.joins import lookup
from citylake.operators.schema import named
from citylake.operators.shapes import touching
from citylake.session import materialise

GRID_STEP = 2  # each finer place grid has cells 2**GRID_STEP times smaller
MAX_DEPTH = 20
SITES_PER_CELL = 32


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size).cast("long")


def invalid_rings(polygons: DataFrame, code: str = "COD_POSTAL", ring: str = "ring") -> DataFrame:
    """Rows (code, problem) whose ring is missing or has fewer than three different vertices."""
    vertices = F.size(F.array_distinct(named(ring)))
    problem = F.when(named(ring).isNull(), "no ring").when(vertices < 3, "fewer than three vertices")
    return polygons.select(named(code), problem.alias("problem")).where("problem IS NOT NULL")


def touching_pairs(
    polygons: DataFrame,
    code: str = "COD_POSTAL",
    ring: str = "ring",
    tolerance: float = G.TOLERANCE,
    with_distance: bool = False,
    shape: str | None = None,
) -> DataFrame:
    """All ordered pairs of rows whose polygons touch; with ``shape``, a column of shapes of several parts with holes.

    Rows with the same outline are reduced to one shape first and expanded last, so copies of a
    polygon are never paired with each other. Open rings are closed; ``invalid_rings`` reports the
    rows that have no area to touch.
    """
    outline = S.closed(shape if shape else S.shape_of_ring(named(ring)))
    rows = polygons.select(named(code).alias("code"), outline.alias("shape")).where(F.size("shape") > 0)
    rows = rows.withColumn("outline", F.unhex(F.sha2(F.to_json("shape"), 256)))
    # Both are read several times below: written once, then scanned by column.
    rows = materialise(rows, "polygons")
    outlines = rows.groupBy("outline").agg(F.any_value("shape").alias("shape"))
    # Numbers are a quarter as long as digests, and each pair of edges carries two; they are fixed by writing them.
    outlines = outlines.select(F.lit(0).alias("grp"), F.monotonically_increasing_id().alias("owner"), "outline", "shape")
    outlines = materialise(outlines.withColumn("c", S.centroid("shape")), "outlines")
    pairs = touching(outlines.select("grp", "owner", "shape"), tolerance).select("a", "b")
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    directed = pairs.select(F.explode(ways).alias("w")).select("w.a", "w.b")
    known = outlines.select(F.col("outline").alias("_outline"), "owner", "c")
    members = lookup(rows.select("code", "outline"), known, {"_outline": F.col("outline")}, "inner").select("owner", "code", "c")
    members = materialise(members, "members")
    for side, name in (("a", f"{code}_1"), ("b", f"{code}_2")):
        own = members.select(F.col("owner").alias(side), F.col("code").alias(name), *([F.col("c").alias(f"c_{side}")] if with_distance else []))
        directed = directed.join(own, side)
    keep = [G.distance(F.col("c_a.x"), F.col("c_a.y"), F.col("c_b.x"), F.col("c_b.y")).alias("distance")] if with_distance else []
    return directed.select(named(f"{code}_1"), named(f"{code}_2"), *keep)


def adjacency(
    polygons: DataFrame,
    code: str = "COD_POSTAL",
    ring: str = "ring",
    tolerance: float = G.TOLERANCE,
    shape: str | None = None,
) -> DataFrame:
    """Touching pairs in both directions with the distance between centroids."""
    return touching_pairs(polygons, code, ring, tolerance, with_distance=True, shape=shape)


def _sites(places: DataFrame, lat: str, lon: str, values: Sequence[str]) -> DataFrame:
    """One row per distinct place position; the least values win where places coincide."""
    known = places.where(is_known(lat) & is_known(lon))
    return known.groupBy(
        F.col(lon).cast("double").alias("sx"), F.col(lat).cast("double").alias("sy")
    ).agg(F.min(F.struct(*[named(v) for v in values])).alias("place"))


def _depth(sites: DataFrame, reach: float) -> int:
    """Levels of refinement until no grid cell holds more than ``SITES_PER_CELL`` positions.

    The cells of all levels are counted by one aggregate; a row for each level comes to the driver.
    """
    finest = F.lit(reach / 2 ** (GRID_STEP * MAX_DEPTH))
    cells = [
        F.struct(F.lit(d).alias("depth"), *[F.shiftright(_cell(F.col(f"s{c}"), finest), GRID_STEP * (MAX_DEPTH - d)).alias(c) for c in "xy"])
        for d in range(MAX_DEPTH)
    ]
    counts = sites.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.depth", "c.x", "c.y").count()
    most = {r.depth: r.most for r in counts.groupBy("depth").agg(F.max("count").alias("most")).collect()}
    return next((d for d in range(MAX_DEPTH) if most.get(d, 0) <= SITES_PER_CELL), MAX_DEPTH)


def nearest_site(points: DataFrame, sites: DataFrame, reach: float) -> DataFrame:
    """Nearest site within ``reach`` of each distinct point ``(px, py)``; exact.

    Sites sit on nested grids. A point starts with the cells around it and goes down level by
    level, keeping only cells that can still hold its nearest site: those no farther away than
    the closest site seen so far. A dense cell is therefore never joined in full, and each
    join meets at most 16 child cells per key.
    """
    depth = _depth(sites, reach)
    finest = F.lit(reach / 2 ** (GRID_STEP * depth))
    sites = sites.withColumns({"ix": _cell(F.col("sx"), finest), "iy": _cell(F.col("sy"), finest)})

    def index(name: str, level: int) -> Column:
        return F.shiftright(F.col(name), GRID_STEP * (depth - level))

    coarse = {
        "ix": F.shiftright(_cell(F.col("px"), finest), GRID_STEP * depth),
        "iy": F.shiftright(_cell(F.col("py"), finest), GRID_STEP * depth),
    }
    around = F.array(
        *[
            F.struct((coarse["ix"] + dx).alias("kx"), (coarse["iy"] + dy).alias("ky"))
            for dx in (-1, 0, 1)
            for dy in (-1, 0, 1)
        ]
    )
    frontier = points.select("px", "py", F.explode(around).alias("k")).select("px", "py", "k.*")

    for level in range(depth):
        cells = (
            sites.groupBy(index("ix", level).alias("cx"), index("iy", level).alias("cy"))
            .agg(F.min(F.struct("sx", "sy")).alias("sample"))
            .withColumns(
                {"_kx": F.shiftright("cx", GRID_STEP), "_ky": F.shiftright("cy", GRID_STEP)}
                if level
                else {"_kx": F.col("cx"), "_ky": F.col("cy")}
            )
        )
        size = reach / 2 ** (GRID_STEP * level)
        gap = [
            F.greatest(F.col(c) * size - F.col(p), F.lit(0.0), F.col(p) - (F.col(c) + 1) * size)
            for c, p in (("cx", "px"), ("cy", "py"))
        ]
        per_point = Window.partitionBy("px", "py")
        frontier = (
            lookup(frontier, cells, {"_kx": F.col("kx"), "_ky": F.col("ky")}, "inner")
            .withColumn("low", F.sqrt(gap[0] * gap[0] + gap[1] * gap[1]))
            .withColumn(
                "seen",
                G.distance(F.col("px"), F.col("py"), F.col("sample.sx"), F.col("sample.sy")),
            )
            .withColumn("best", F.min("seen").over(per_point))
            # A hair of slack keeps a cell whose rounded bound lands just past the true one.
            .where(F.col("low") <= F.least(F.col("best"), F.lit(reach)) * (1 + 1e-9))
            .select("px", "py", F.col("cx").alias("kx"), F.col("cy").alias("ky"))
        )
        if level == depth - 1:
            sites = sites.withColumns(
                {"kx": F.shiftright("ix", GRID_STEP), "ky": F.shiftright("iy", GRID_STEP)}
            )
    if depth == 0:
        sites = sites.withColumns({"kx": F.col("ix"), "ky": F.col("iy")})
    gap = G.distance(F.col("px"), F.col("py"), F.col("sx"), F.col("sy"))
    return (
        frontier.join(sites, ["kx", "ky"])
        .withColumn("gap", gap)
        .where(F.col("gap") <= reach)
        .groupBy("px", "py")
        .agg(F.min(F.struct("gap", "place")).alias("nearest"))
        .select("px", "py", F.col("nearest.gap").alias("gap"), F.col("nearest.place").alias("place"))
    )


def reverse_geocode(
    df: DataFrame,
    places: DataFrame,
    lat: str = "property_latitude",
    lon: str = "property_longitude",
    values: dict[str, str] | None = None,
    place_lat: str = "latitude",
    place_lon: str = "longitude",
    reach: float = 0.01,
) -> DataFrame:
    """Add address and postcode of the nearest place within ``reach`` degrees.

    ``values`` maps new column names to columns of ``places``. Rows without coordinates or
    without a place in reach are kept with nulls. Equal positions are looked up once.
    """
    values = values or {"property_address": "address", "property_postalcode": "postcode"}
    sites = materialise(_sites(places, place_lat, place_lon, list(values.values())), "sites")
    known = is_known(lat) & is_known(lon)
    located = df.where(known).withColumns(
        {"px": named(lon).cast("double"), "py": named(lat).cast("double")}
    )
    points = located.select("px", "py").distinct()
    found = nearest_site(points, sites, reach)
    kept = [named(c) for c in df.columns if c not in values]
    found = found.select(F.col("px").alias("_px"), F.col("py").alias("_py"), "place")
    filled = lookup(located, found, {"_px": F.col("px"), "_py": F.col("py")}, "left").select(
        *kept, *[F.col("place")[source].alias(new) for new, source in values.items()]
    )
    empty = df.where(~F.coalesce(known, F.lit(False))).select(
        *kept,
        *[F.lit(None).cast(places.schema[source].dataType).alias(new) for new, source in values.items()],
    )
    return filled.unionByName(empty)
