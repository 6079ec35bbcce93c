"""The Merkle manifest against a tree built in memory."""

import hashlib
import random
import zlib

import pytest

from citylake.llm import merkle
from citylake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """Root, and each leaf's (before, after) level by level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 8 * 8 : place // 8 * 8 + 8]
            paths[i].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
        level = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
        at = [place // 8 for place in at]
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    parts = []
    for g in order:
        ranked = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        parts.append((ranked, *tree([leaf(r, r[1]) for r in ranked])))
    root, above = tree([p[1] for p in parts])
    out = []
    for (ranked, subroot, paths), rest in zip(parts, above):
        for r, path in zip(ranked, paths):
            text, steps = r[1], path + rest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = leaf(r, text)
            for before, after in steps:
                h = sha(before + h + after)
            out.append((r[0], leaf(r, r[1]), subroot, root, sha("".join(a + b for a, b in steps)), h, h == root))
    return sorted(map(repr, out))


def query(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op11_merkle_manifest"](spark, str(tmp_path))
    return sorted(repr(tuple(r)) for r in found.collect())


def random_rows(sizes, seed):
    draw = random.Random(seed)
    ids = iter(draw.sample(range(10 * sum(sizes)), sum(sizes)))
    return [(next(ids), draw.choice(["Ab", "é", "", "xY z" * 9, None]), lang, draw.choice(["s", None]), draw.choice([1, None]))
            for lang, n in zip(["en", None, "fr", "é", "de", "b", "a", "c", "d", "zz"], sizes) for _ in range(n)]


@pytest.mark.parametrize("sizes", [(1,), (8,), (9, 1), (4096, 64), (4097, 1, 65, 512), (9100, 3, 8, 1, 1, 1, 2, 1, 1, 1)])
def test_against_a_tree_in_memory(spark, tmp_path, sizes):
    rows = random_rows(sizes, sum(sizes))
    assert query(spark, tmp_path, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    same = (5, "Same", "en", "s", 4)
    rows = [same] * 11 + [(5, "other", "en", "s", 4), (None, None, None, None, None), (None, "A", "en", None, 0), (7, "B" * 400_000, "", "s", 1)]
    assert query(spark, tmp_path, rows) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == []


def test_witnesses_of_other_columns(spark):
    """Any columns, and columns named like those the operator makes."""
    rows = [(i, f"t{i % 3}", "x", "y") for i in range(40)]
    df = spark.createDataFrame(rows, "`the id` int, hash string, part string, place string")
    found = merkle.witnesses(df, ["the id", "hash"], group="hash", key="the id").collect()
    assert len(found) == 40 and len({r.root for r in found}) == 1 and len({r.subroot for r in found}) == 3
    for r in found:
        h = r.leaf
        for step in r.steps:
            h = sha(step.left + h + step.right)
        assert h == r.root and r.leaf == r.tampered


def test_witnesses_grow_with_each_sibling():
    """An open node knows all siblings completed so far; what its parent learns reaches it too."""
    growing = merkle.Tree()
    nodes = []
    for i in range(20):
        nodes.append(growing.append(sha(str(i))))
        run = i // 8 * 8
        for k in range(run, i + 1):
            assert [*nodes[k].left, nodes[k].hash, *nodes[k].right] == [n.hash for n in nodes[run : i + 1]]
    assert nodes[0].parent.right == [nodes[8].parent.hash]
    root, paths = tree([n.hash for n in nodes])
    assert growing.finish().hash == root and [n.steps() for n in nodes] == paths

