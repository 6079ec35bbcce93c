"""Connected groups from candidate keys, without writing out all pairs of a group.

Nodes that share a key are candidates. In each round a key compares its nodes with one node of its own
choice only, and confirmed links join nodes to components. Keys whose nodes lie in one component are
done. After the rounds, all nodes that still share a key and lie in different components are compared, so
no candidate is left out: a pair is either compared or already connected. Large keys are then compared in
blocks of bounded size: by a function that gives back one link between a node and a component, or by a join
that gives back the links only.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.storage import written
from citylake.operators.joins import lookup

ROUNDS = 1
#: Keys with more nodes are compared in blocks of about so many nodes, or so much weight, each.
PAIRWISE = 32
BLOCK_NODES, BLOCK_WEIGHT = 1024, 1_000_000
#: Nodes of one side of a block that a join compares.
JOINED_NODES = 256

#: Of a table ``left``, ``node``, ``component``, ``payload``: links ``a``, ``b`` between left rows and others.
BlockLinks = Callable[[pa.Table], pa.Table]


def attach(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join to one row per key, so that a key with very many rows on the left can be split."""
    right = right.withColumnRenamed(key, "_key")
    return lookup(left, right, {"_key": F.col(key)}, how).drop("_key")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is connected to, for edges ``a``, ``b``; every node of an edge.

    Alternates two steps that keep connectivity and shrink the graph to stars: each node's larger
    neighbours move to its smallest neighbour, then its smaller neighbours do. A round's edges are
    written, so lineage stays short.
    """
    star = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    star, before = written(star, "edges"), None
    while True:
        both = star.union(star.select("b", "a"))
        smallest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = attach(both, smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = attach(large, smallest, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*").where("a <> b").distinct()
        star = written(small, "edges")
        state = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return star.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def shared_keys(members: DataFrame) -> DataFrame:
    """Rows (``key``, ``node``) whose key has more than one node."""
    several = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    return attach(members, several.where("lo < hi").select("key"), "key")


def connect(
    members: DataFrame,
    payload: Callable[[DataFrame], DataFrame],
    confirm: Callable[[DataFrame], DataFrame],
    near: str = "true",
    block_links: BlockLinks | None = None,
    traits: DataFrame | None = None,
    rounds: int = ROUNDS,
    once: Column | None = None,
    confirm_rest: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Components of the nodes whose links are confirmed, and the links found.

    ``members``: ``key``, ``node`` (bigint), each pair once. ``traits``: ``node`` with its ``sketch`` or its
    ``weight``. ``near`` is a condition on the sketches ``s``, ``t`` and weights ``v``, ``w`` of two nodes without
    which a pair is no candidate.
    ``payload`` gives ``node``, ``payload`` for a table of nodes. ``confirm`` keeps the linked rows of a table
    ``a``, ``b``, ``payload_a``, ``payload_b``. With ``block_links``, what remains of a large key is compared
    block by block and not written out as pairs. Without, ``payload`` also gives the nodes' ``sketch``, ``weight``,
    ``keys`` and number of ``copies``, what remains is joined block by block, and ``confirm_rest`` (or ``confirm``) is a
    condition of the join. ``once`` is a condition on a ``key`` and the keys ``keys_a``, ``keys_b`` of two nodes: it holds for one
    of the keys that they share.
    """
    active = shared_keys(members.select("key", "node"))
    # Contents of all nodes that share a key.
    if not block_links:
        active = written(active, "shared")
        contents = written(payload(active.select("node").distinct()), "payload")
        traits = contents.select("node", "sketch", "weight", "copies")
    active = attach(active, traits, "node") if traits is not None else active
    for name in ("sketch", "weight", "copies"):
        if name not in active.columns:
            active = active.withColumn(name, F.lit(0).cast("bigint"))
    active = written(active, "active")
    if block_links:
        contents = written(payload(active.select("node").distinct()), "payload")
    active = active.withColumn("component", F.col("node"))
    links, tested = None, None
    for turn in range(rounds + 1):
        last = turn == rounds
        if not last:
            # A node with many copies is near the middle of its group.
            first = F.struct(-F.col("copies"), F.xxhash64("node", "key", F.lit(turn)))
            choice = F.min_by(F.struct("node", "component", "sketch", "weight"), first)
            leader = active.groupBy("key").agg(choice.alias("leader"))
            pairs = attach(active, leader, "key").where("component <> leader.component")
            pairs = pairs.select(F.col("node").alias("x"), F.col("leader.node").alias("y"),
                                 F.col("sketch").alias("s"), F.col("leader.sketch").alias("t"),
                                 F.col("weight").alias("v"), F.col("leader.weight").alias("w")).where(near)
        elif not block_links:
            links = links.union(written(_joined(active, contents, near, once, confirm_rest or confirm), "links"))
            groups = written(components(links), "components")
            break
        else:
            sizes = active.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"))
            active = attach(active, sizes, "key")
            few, many = active.where(F.col("n") <= PAIRWISE), active.where(F.col("n") > PAIRWISE)
            other = few.select("key", F.col("node").alias("y"), F.col("component").alias("other"),
                               F.col("sketch").alias("t"), F.col("weight").alias("w"))
            pairs = few.withColumnRenamed("sketch", "s").withColumnRenamed("weight", "v").join(other, "key")
            pairs = pairs.where("node < y AND component <> other").where(near).select(F.col("node").alias("x"), "y")
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        full = attach(pairs, contents.select(F.col("node").alias("a"), F.col("payload").alias("payload_a")), "a")
        full = attach(full, contents.select(F.col("node").alias("b"), F.col("payload").alias("payload_b")), "b")
        found = confirm(full).select("a", "b")
        if last:
            found = found.union(_blockwise(many, contents, block_links))
        found = written(found, "links")
        links = found if links is None else links.union(found)
        groups = written(components(links), "components")
        if last:
            break
        labelled = attach(active.drop("component"), groups, "node", "left")
        labelled = labelled.withColumn("component", F.coalesce("component", "node"))
        several = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        active = written(attach(labelled, several.where("lo < hi").select("key"), "key"), "active")
        if active.isEmpty():
            break
    return groups, links


def _blocks(many: DataFrame, most_nodes: int, most_weight: int) -> DataFrame:
    """``key``, ``i``, ``j``, ``left``, ``node``, ``component``: the nodes of each pair of bounded blocks of a key.

    The blocks of all nodes outside a key's largest component meet every block of the key.
    """
    counts = many.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    largest = counts.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("largest"))
    side = attach(many, largest, "key").withColumn("out", F.col("component") != F.col("largest"))
    parts = side.groupBy("key", "out").agg(F.count(F.lit(1)).alias("c"), F.sum("weight").alias("w"))
    number = F.ceil(F.greatest(F.col("c") / most_nodes, F.col("w") / most_weight)).cast("int")
    parts = parts.groupBy("key").agg(
        F.max(F.when(F.col("out"), number)).alias("outer"), F.coalesce(F.max(F.when(~F.col("out"), number)), F.lit(0)).alias("inner")
    )
    side = attach(side, parts, "key")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.when(F.col("out"), F.col("outer")).otherwise(F.col("inner"))).cast("int")
    # Outer block i meets outer blocks j >= i and, numbered on from there, every inner block.
    own = F.when(F.col("out"), own).otherwise(F.col("outer") + own)
    every = F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1)
    mates = F.when(F.col("out"), every).otherwise(F.sequence(F.lit(0), F.col("outer") - 1))
    rows = side.withColumn("own", own).withColumn("mate", F.explode(mates))
    return rows.select(
        "key", F.least("own", "mate").alias("i"), F.greatest("own", "mate").alias("j"),
        (F.col("own") <= F.col("mate")).alias("left"), "node", "component",
    )


def _joined(
    active: DataFrame, contents: DataFrame, near: str, once: Column | None, confirm: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Links ``a``, ``b`` between different components of a key, from joins of pairs of bounded blocks of its nodes."""
    rows = _blocks(active, JOINED_NODES, BLOCK_WEIGHT)
    rows = attach(rows, contents.drop("copies"), "node")
    mine = rows.where("left").select(
        "key", "i", "j", F.col("node").alias("a"), F.col("component").alias("own"), F.col("sketch").alias("s"),
        F.col("weight").alias("v"), F.col("keys").alias("keys_a"), F.col("payload").alias("payload_a"),
    )
    others = rows.where("NOT left OR i = j").select(
        "key", "i", "j", F.col("node").alias("b"), F.col("component").alias("other"), F.col("sketch").alias("t"),
        F.col("weight").alias("w"), F.col("keys").alias("keys_b"), F.col("payload").alias("payload_b"),
    )
    pairs = mine.join(others, ["key", "i", "j"]).where("own <> other AND (i < j OR a < b)").where(near)
    found = confirm(pairs if once is None else pairs.where(once))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _blockwise(many: DataFrame, contents: DataFrame, block_links: BlockLinks) -> DataFrame:
    """Links between different components of a key, from pairs of bounded blocks of its nodes."""
    rows = attach(_blocks(many, BLOCK_NODES, BLOCK_WEIGHT), contents, "node")
    return rows.groupBy("key", "i", "j").applyInArrow(block_links, "a bigint, b bigint")
