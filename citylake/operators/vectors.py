"""Vector table: contract checks, inserts, queries and exact nearest neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.operators.incremental import insert_if_absent
from citylake.operators.schema import named
from citylake.session import materialise

DIMENSION = 1024  # fixed values: default width, longest id, default row limit
ID_LENGTH = 100
LIMIT = 100
BLOCK_BYTES = 64 * 1024 * 1024
PIVOT_BYTES = 16 * 1024 * 1024  # bound of what is sent to every task
OTHER = -1  # cell of the widths that have no pivot
ROW = "id {id}, vector array<double>, width int, cell int, away double"
VISIT = "query_id {query}, vector array<double>, width int, cell int, away double, bound double"


def validate_vectors(
    df: DataFrame, dim: int = DIMENSION, key: str = "id", vector: str = "embedding"
) -> DataFrame:
    """Rows (key, problem) for every breach of the table contract; empty when it holds."""
    ident = named(key)
    checks = {
        "null id": ident.isNull(),
        "long id": F.length(ident.cast("string")) > ID_LENGTH,
        "dimension": F.coalesce(F.size(named(vector)) != dim, F.lit(True)),
    }
    found = F.filter(
        F.array(*[F.when(bad, F.lit(problem)) for problem, bad in checks.items()]),
        lambda p: p.isNotNull(),
    )
    single = df.select(ident.alias("id"), F.explode(found).alias("problem"))
    repeated = (
        df.where(ident.isNotNull()).groupBy(ident.alias("id")).count().where("count > 1")
        .select("id", F.lit("duplicate id").alias("problem"))
    )
    return single.unionByName(repeated)


def insert_vectors(
    store: DataFrame, new: DataFrame, key: str = "id", order_by: Sequence[str] | None = None
) -> DataFrame:
    return insert_if_absent(store, new, key, order_by)


def query_vectors(
    df: DataFrame,
    expr: str = "",
    fields: Sequence[str] | None = None,
    limit: int = LIMIT,
    key: str = "id",
) -> DataFrame:
    """Rows that meet a predicate, least ids first, at most ``limit`` of them."""
    rows = df.where(expr) if expr else df
    names = list(fields or ["id", "embedding"])
    return rows.orderBy(named(key)).limit(limit).select([named(f) for f in names])


class _Cells(NamedTuple):
    """Pivots, and per cell the number of rows and their least and greatest distance to the pivot."""

    pivot: list[np.ndarray]
    rows: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def of_width(self, width: int) -> np.ndarray:
        return np.flatnonzero([len(p) == width for p in self.pivot])


def _distances(data: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(data), len(pivots)))
    for c, pivot in enumerate(pivots):
        gap = data - pivot
        out[:, c] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def _slack(*sizes: np.ndarray | float) -> np.ndarray | float:
    """Room for rounding, so that a bound never excludes an equal distance."""
    return 1e-9 * (1 + sum(np.abs(s) for s in sizes))


def _or_nan(name: str) -> Column:
    """What pandas hands back as null was no number; it sorts last."""
    return F.coalesce(F.col(name), F.lit(float("nan")))


def _assign(rows: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Each row with its nearest pivot and the distance to it; widths without a pivot share the cell -1."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cell, away = np.full(len(part), OTHER), np.full(len(part), np.nan)
            for width, own in part.reset_index(drop=True).groupby("width"):
                known = np.flatnonzero([len(p) == width for p in pivots])
                if len(known) and width:
                    far = _distances(np.stack(own["vector"].to_numpy()).astype("float64"), [pivots[c] for c in known])
                    near = far.argmin(axis=1)
                    cell[own.index], away[own.index] = known[near], far[np.arange(len(own)), near]
            yield part.assign(cell=cell.astype("int32"), away=away)

    return rows.mapInPandas(run, ROW.format(id=rows.schema["id"].dataType.simpleString()))


def _visits(asked: DataFrame, cells: _Cells, k: int, first: bool) -> DataFrame:
    """The cells that each query has to visit, with the distance beyond which no row matters.

    The ``first`` visits go to the nearest cells that hold ``k`` rows. The others go wherever the
    triangle inequality does not rule out a row within ``bound``, the k-th distance found so far.
    """

    def of_query(width: int, vector: np.ndarray, bound: float) -> list[tuple[int, float, float]]:
        known = cells.of_width(width)
        if not len(known) or not width:
            return [(OTHER, np.nan, np.inf)] if first else []
        away = _distances(np.asarray(vector, "float64")[None], [cells.pivot[c] for c in known])[0]
        size, least, most = cells.rows[known], cells.least[known], cells.most[known]
        order = np.argsort(away, kind="stable")
        home = order[: int(np.searchsorted(np.cumsum(size[order]), k)) + 1]
        # So many rows are certain to lie within the farthest place of their cell.
        sure = np.argsort(away + most, kind="stable")
        full = int(np.searchsorted(np.cumsum(size[sure]), k))
        if full < len(sure):
            bound = np.fmin(bound, (away + most)[sure[full]])
        bound += _slack(bound)
        if first:
            return [(int(known[c]), away[c], bound) for c in home]
        low = np.maximum(np.maximum(away - most, least - away), (away - np.fmin.reduce(away)) / 2)
        # Written so that a distance that is no number excludes nothing.
        chosen = ~(low > bound + _slack(away)) & (size > 0)
        chosen[home] = False
        return [(int(known[c]), away[c], bound) for c in np.flatnonzero(chosen)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for label, vector, width, bound in zip(part["query_id"], part["vector"], part["width"], part["bound"]):
                rows += [(label, vector, width, *v) for v in of_query(width, vector, np.inf if pd.isna(bound) else bound)]
            yield pd.DataFrame(rows, columns=["query_id", "vector", "width", "cell", "away", "bound"])

    return asked.mapInPandas(run, VISIT.format(query=asked.schema["query_id"].dataType.simpleString()))


def _nearest(queries: pd.DataFrame, rows: pd.DataFrame, k: int, compared: Accumulator | None) -> pd.DataFrame:
    """The ``k`` nearest rows of one part of a cell to each of its visitors, by width."""
    parts = []
    for width, asked in queries.groupby("width"):
        own = rows[rows["width"] == width]
        if own.empty:
            continue
        ids, away = own["id"].to_numpy(), own["away"].to_numpy()
        data = np.stack(own["vector"].to_numpy()).astype("float64")
        for label, vector, pivot, bound in zip(asked["query_id"], asked["vector"], asked["away"], asked["bound"]):
            near = np.flatnonzero(~(np.abs(away - pivot) > bound + _slack(pivot)))
            if compared is not None:
                compared.add(len(near))
            gap = data[near] - np.asarray(vector, "float64")
            square = np.einsum("ij,ij->i", gap, gap)
            order = np.lexsort((ids[near], square))[:k]
            parts.append(pd.DataFrame({"query_id": label, "id": ids[near[order]], "distance": np.sqrt(square[order])}))
    if parts:
        return pd.concat(parts)
    none = {"query_id": queries["query_id"].iloc[:0], "id": rows["id"].iloc[:0]}
    return pd.DataFrame(none).assign(distance=np.zeros(0))


def _compare(
    rows: DataFrame, visits: DataFrame, sizes: DataFrame, k: int, out: T.StructType, block_bytes: int,
    compared: Accumulator | None,
) -> DataFrame:
    """Rows of each cell against its visitors, in groups of about ``block_bytes`` on both sides."""

    def parts_of(numbers: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(numbers) * 8 / block_bytes)).cast("int")

    load = visits.groupBy("cell").agg(F.sum(F.size("vector").cast("bigint")).alias("asked"))
    plan = sizes.join(load, "cell").select("cell", parts_of("numbers").alias("shards"), parts_of("asked").alias("blocks"))
    plan = F.broadcast(plan)  # one row per pivot and one for the rest
    sides = {}
    for name, side, key, own, other in (
        ("rows", rows, "id", "shard", "block"), ("asked", visits, "query_id", "block", "shard"),
    ):
        sides[name] = side.join(plan, "cell").withColumns(
            {
                own: F.pmod(F.xxhash64(key), F.col(f"{own}s")).cast("int"),
                other: F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)),
            }
        ).drop("shards", "blocks")
    keys = ("cell", "shard", "block")
    both = sides["asked"].groupBy(*keys).cogroup(sides["rows"].groupBy(*keys))
    return both.applyInPandas(lambda q, r: _nearest(q, r, k, compared), out).withColumn("distance", _or_nan("distance"))


def l2_topk(
    df: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "id",
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "query",
    block_bytes: int = BLOCK_BYTES,
    pivot_bytes: int = PIVOT_BYTES,
    compared: Accumulator | None = None,
) -> DataFrame:
    """The ``k`` nearest rows by L2 distance to each query; exact, ties to the least key.

    A query is compared with the rows of its own width; ``validate_vectors`` reports rows of a
    width that breaches the contract. Pivots are the square root of all rows in number, ``pivot_bytes`` in size at
    most. Every row goes to the cell of its nearest pivot. A query first visits the nearest cells that
    hold ``k`` rows, then only cells, and in them only rows, that the triangle inequality does not put
    beyond its k-th distance so far. A table of at most ``block_bytes`` is one cell. Large cells and many visitors are cut by hash into groups of about
    ``block_bytes``. Pivots and one row of figures per cell come to the driver. ``compared`` counts the
    rows that were compared. Rows with their cells are written once below the shared folder.
    """
    id_type, query_type = df.schema[key].dataType, queries.schema[query_key].dataType
    out = T.StructType(
        [T.StructField("query_id", query_type), T.StructField("id", id_type), T.StructField("distance", T.DoubleType())]
    )
    spark, numbers = df.sparkSession, "array<double>"

    def plain(side: DataFrame, own: str, values: str, name: str) -> DataFrame:
        return side.where(named(values).isNotNull()).select(
            named(own).alias(name), named(values).cast(numbers).alias("vector"), F.size(named(values)).alias("width")
        )

    rows, asked = plain(df, key, vector, "id"), plain(queries, query_key, query_vector, "query_id")
    total = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max("width").alias("width"), F.sum(F.col("width").cast("bigint")).alias("numbers")
    ).first()
    unbounded = asked.withColumn("bound", F.lit(None).cast("double"))
    ranked = Window.partitionBy("query_id").orderBy("distance", "id")

    def least(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    if (total["numbers"] or 0) * 8 <= block_bytes:
        placed = rows.withColumns({"cell": F.lit(OTHER), "away": F.lit(float("nan"))})
        visits = unbounded.withColumns(
            {"cell": F.lit(OTHER), "away": F.lit(float("nan")), "bound": F.lit(float("inf"))}
        )
        sizes = spark.createDataFrame([(OTHER, total["numbers"] or 0)], "cell int, numbers bigint")
        return least(_compare(placed, visits, sizes, k, out, block_bytes, compared))

    wanted = max(1, min(math.isqrt(total["n"]), pivot_bytes // (8 * max(total["width"] or 1, 1))))
    drawn = rows.where("width > 0").orderBy(F.xxhash64("id"), "id").limit(wanted).select("vector").collect()
    pivots = [p for r in drawn if np.isfinite(p := np.array(r.vector, "float64")).all()]
    placed = materialise(_assign(rows, pivots).withColumn("away", _or_nan("away")), "cells")
    sizes = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("width").cast("bigint")).alias("numbers"), F.min("away").alias("least"),
        F.max("away").alias("most"),  # not a number counts as greatest, so such a cell is never excluded
    )
    figures = {r.cell: r for r in sizes.collect()}
    of = lambda name: np.array([figures[c][name] if c in figures else 0 for c in range(len(pivots))], "float64")
    cells = _Cells(pivots, of("n"), of("least"), of("most"))
    sizes = spark.createDataFrame([(r.cell, r.numbers) for r in figures.values()], "cell int, numbers bigint")

    first = _compare(placed, _visits(unbounded, cells, k, True), sizes, k, out, block_bytes, compared)
    first = materialise(first, "nearest")
    bounds = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k)
    bounds = bounds.select(F.col("query_id").alias("_query"), F.col("distance").alias("bound"))
    bounded = asked.join(bounds, F.col("query_id").eqNullSafe(F.col("_query")), "left").drop("_query")
    others = _compare(placed, _visits(bounded, cells, k, False), sizes, k, out, block_bytes, compared)
    return least(first.unionByName(others))
