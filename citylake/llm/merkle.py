"""Operator 11: Merkle manifest of a dataset, with a witness that ties every row to the root.

A row's leaf is the SHA-256 of its fields, each written as ``-`` if null, else as its UTF-8 length, a colon and
the value. Within a group, rows ascend by key; every ``ARITY`` consecutive nodes become the digest of their
joined digests until one is left, the group's subroot. The subroots, in the order of their groups, are the
leaves of a last tree of the same kind; it gives the root.

Leaves are appended one after another. A node that still waits for siblings is open and holds the
witness found so far: the siblings before it from the start, those after it as they are completed. When a run
is full it becomes one node of the next level, to which all its witnesses are linked, so whatever that
node learns later extends all of them at once. Blocks of ``ARITY ** LEVELS`` aligned leaves are appended in
parallel; their roots are further leaves for the next turn, which gives each block the rest of its witness.

Defined results: nulls are fields like others, also in the key (first) and the group (a group of its own, first).
Rows with equal keys are ordered by their leaves; equal rows are leaves of their own. Empty and long texts
are digested whole. An empty table gives an empty result. Only the named columns are read, so any others
may be there under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.storage import written
from citylake.operators.joins import lookup
from citylake.operators.schema import named

ARITY = 8
#: A block has ``ARITY ** LEVELS`` leaves: the unit that one task appends.
LEVELS = 4
STEPS = "array<struct<left:string,right:string>>"
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def digest(hashes: Sequence[str]) -> str:
    return hashlib.sha256("".join(hashes).encode()).hexdigest()


class Node:
    """A subtree: its digest, the siblings known so far, and the node it became a part of."""

    __slots__ = ("hash", "left", "right", "parent")

    def __init__(self, hash: str):
        self.hash, self.left, self.right, self.parent = hash, (), [], None

    def steps(self) -> list[tuple[str, str]]:
        """Siblings before and after, level by level."""
        node, out = self, []
        while node is not None and node.parent is not None:
            out.append(("".join(node.left), "".join(node.right)))
            node = node.parent
        return out


class Tree:
    """Appends leaves; each open node's witness grows with every sibling that is completed."""

    def __init__(self, arity: int = ARITY):
        self.arity, self.open, self.count = arity, [[]], [0]

    def append(self, hash: str) -> Node:
        node = Node(hash)
        self._add(node, 0)
        return node

    def _add(self, node: Node, level: int) -> None:
        run = self.open[level]
        node.left = tuple(s.hash for s in run)
        for sibling in run:
            sibling.right.append(node.hash)
        run.append(node)
        self.count[level] += 1
        if len(run) == self.arity:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = Node(digest([s.hash for s in run]))
        for sibling in run:
            sibling.parent = parent
        if level + 1 == len(self.open):
            self.open.append([])
            self.count.append(0)
        self._add(parent, level + 1)

    def finish(self, levels: int | None = None) -> Node:
        """The root: after ``levels`` levels for an aligned part of a larger tree, else when one node is left."""
        level = 0
        while level < levels if levels is not None else self.count[level] > 1:
            if self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0]


def _grown(table: pa.Table) -> tuple[np.ndarray, list[Node], Node]:
    """Order of a block's rows, their nodes in that order, and the block's root."""
    order = np.argsort(table["place"].to_numpy(), kind="stable")
    hashes = table["hash"].to_pylist()
    tree = Tree()
    nodes = [tree.append(hashes[i]) for i in order.tolist()]
    alone = table["total"][0].as_py() <= ARITY**LEVELS
    return order, nodes, tree.finish(None if alone else LEVELS)


def _block_root(table: pa.Table) -> pa.Table:
    _, _, root = _grown(table)
    total = -(-table["total"][0].as_py() // ARITY**LEVELS)
    row = {"part": [table["part"][0].as_py()], "place": [table["block"][0].as_py()], "hash": [root.hash], "total": [total]}
    return pa.table(row)


def _block_witnesses(table: pa.Table, later: pa.Table, columns: Sequence[str]) -> pa.Table:
    """The block's rows with their whole witness: their own steps, then those of the block's root."""
    order, nodes, _ = _grown(table)
    rest = [(s["left"], s["right"]) for s in later["steps"][0].as_py()]
    steps = [n.steps() + rest for n in nodes]
    flat = [s for x in steps for s in x]
    pairs = pa.StructArray.from_arrays(
        [pa.array([s[k] for s in flat], pa.string()) for k in (0, 1)], fields=list(_STEP)
    )
    offsets = pa.array(np.cumsum([0, *map(len, steps)]), pa.int32())
    out = table.take(pa.array(order)).select(columns)
    out = out.append_column("steps", pa.ListArray.from_arrays(offsets, pairs))
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.array([later[name][0].as_py()] * len(out), pa.string()))
    return out


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``place`` within its ``part`` (from 0) and the part's ``total``; no task sorts a whole part.

    Rows are cut into sorted ranges over all parts; the sizes of the ranges give where each of them begins.
    """
    ranged = df.repartitionByRange("part", *order).sortWithinPartitions("part", *order)
    ranged = written(ranged.withColumn("slice", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("part", "slice").agg(F.count(F.lit(1)).alias("n"))
    # One row per range and part in it.
    before = Window.partitionBy("part").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select(
        F.col("part").alias("_part"), F.col("slice").alias("_slice"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_begin"),
        F.sum("n").over(Window.partitionBy("part")).alias("total"),
    )
    own = F.row_number().over(Window.partitionBy("part", "slice").orderBy(*order))
    placed = ranged.withColumn("_own", own.cast("bigint"))
    placed = lookup(placed, begins, {"_part": F.col("part"), "_slice": F.col("slice")}, "inner")
    placed = placed.withColumn("place", F.col("_begin") + F.col("_own") - 1)
    return placed.select(*[c for c in df.columns], "place", "total")


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / F.lit(ARITY**LEVELS)).cast("bigint"))


def _turns(nodes: DataFrame) -> list[DataFrame]:
    """Written tables of nodes, turn by turn: each one's block roots are the next one's leaves; last, one per part."""
    turns = [written(_blocks(nodes), "merkle")]
    while True:
        most = turns[-1].agg(F.max("total")).first()[0]
        roots = turns[-1].groupBy("part", "block").applyInArrow(_block_root, "part string, place bigint, hash string, total bigint")
        turns.append(written(_blocks(roots), "merkle"))
        if (most or 0) <= ARITY**LEVELS:
            return turns


def _extended(nodes: DataFrame, witness: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``nodes`` with the witnesses of their blocks continued: ``columns``, ``steps``, ``subroot``, ``root``."""
    names = list(columns)
    schema = ", ".join(f"{n} {t}" for n, t in columns.items()) + f", steps {STEPS}, subroot string, root string"

    def run(block: pa.Table, later: pa.Table) -> pa.Table:
        return _block_witnesses(block, later, names)

    later = witness.withColumnRenamed("place", "block")
    return nodes.groupBy("part", "block").cogroup(later.groupBy("part", "block")).applyInArrow(run, schema)


def witnesses(
    df: DataFrame, fields: Sequence[str], *, group: str, key: str, tampered: dict[str, Column] | None = None
) -> DataFrame:
    """Per row: ``key``, ``leaf``, ``tampered`` (leaf of the row with the columns in ``tampered`` replaced), ``steps``,
    ``subroot``, ``root``.

    ``steps`` has the joined digests of the siblings before and after, level by level up to the root; the group's
    subroot is one level of them.
    """
    other = {**{f: named(f) for f in fields}, **(tampered or {})}
    part = F.coalesce(F.concat(F.lit("="), named(group).cast("string")), F.lit("-"))  # null comes first
    key_type = df.select(named(key)).schema[0].dataType.simpleString()
    rows = df.select(
        part.alias("part"), named(key).alias("key"), leaf([named(f) for f in fields]).alias("hash"),
        leaf([other[f] for f in fields]).alias("tampered"),
    )
    turns = _turns(numbered(rows, ["key", "hash"]))
    subroots = turns[-1]
    # The last tree: a part's name is its key, and all are in one part.
    top = subroots.select(F.lit("").alias("part"), F.col("part").alias("name"), "hash")
    tops = _turns(numbered(top, ["name"]))
    found = tops[-1].select(
        "part", "place", F.array().cast(STEPS).alias("steps"), F.lit("").alias("subroot"), F.col("hash").alias("root")
    )
    for nodes in reversed(tops[1:-1]):
        found = _extended(nodes, found, {"part": "string", "place": "bigint"})
    found = _extended(tops[0], found, {"name": "string", "hash": "string"})
    found = found.select(F.col("name").alias("part"), F.lit(0).cast("bigint").alias("place"), "steps", F.col("hash").alias("subroot"), "root")
    for nodes in reversed(turns[1:-1]):
        found = _extended(nodes, found, {"part": "string", "place": "bigint"})
    found = written(found, "merkle-blocks")
    out = _extended(turns[0], found, {"key": key_type, "hash": "string", "tampered": "string"})
    return out.withColumnRenamed("hash", "leaf")


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf leads to."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    joined = F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")
    return F.sha2(joined, 256)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
