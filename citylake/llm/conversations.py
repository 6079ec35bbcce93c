"""Operator 12: repair of a conversation's role structure with the cheapest, then least, audit of edits.

A conversation's turns are edited so that their role initials read ``(s?(ua)+)?``: keep (K, cost 0), set the role to
user or assistant (R, 1), delete (D, 2; the only edit of blank and duplicate turns), insert an empty turn of user or
assistant anywhere (I, 5). A truncated turn that stays adds 5. Of the cheapest audits, the initials of the
edits in order, the least in ASCII is taken.

The dynamic programme goes turn by turn over four states (nothing yet, system, user, assistant) and keeps one audit
for each. Audits share their prefixes: an audit is a node linked to the audit it extends, with its
binary-lifting ancestors and a rolling hash of the whole string. Equal costs are decided by the first letter
that differs, found by a search for the longest common prefix over ancestors; an equal hash is
believed only after the linked letters were compared.

Turns are sorted over the whole table and cut into ranges, so a very long conversation is spread over tasks. A
range's part of such a conversation gives the best audits from every state it may begin in; these
are composed, one row per range. Only the digest of a conversation that crosses ranges goes, in order and
turn by turn, through one task, as a hash of one string must.

Defined results: a null role or text is one space. Null turns come first. Turns of equal number are ordered
by role, then by the SHA-256 of the text, before damage; repeated rows stay adjacent. A null ``conv_id`` is a conversation of
its own. An empty role is never legal. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.linking import attach
from citylake.llm.storage import written
from citylake.operators.schema import named

#: What has been put out so far: nothing, a system turn, ... user, ... assistant. Only the first and last may end.
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
FINAL = (EMPTY, ASSISTANT)
RANK, DELETE, INSERT, CUT = 1, 2, 5, 5
ORDER = ["conv_id", "turn", "role0", "text0", "copy"]
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003
#: Turns that one batch of results covers, about.
BATCH_TURNS = 20_000
NOT_BLANK = r"[^\x20\x09-\x0D]"


class Audits:
    """Persistent strings: node 0 is the empty one, every other extends its parent by a letter."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[0]]

    def extend(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % _MODULUS)
        up, k = [parent], 0
        while k < len(self.up[up[k]]) and self.up[up[k]][k]:
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(up)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The prefix of ``depth`` letters."""
        while self.depth[node] > depth:
            up = self.up[node]
            k = min(len(up) - 1, (self.depth[node] - depth).bit_length() - 1)
            node = up[k]
        return node

    def _same(self, a: int, b: int) -> bool:
        """Equal strings of equal length: hashes differ, or the letters down to a shared node decide."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def common(self, a: int, b: int) -> int:
        """Letters of the longest common prefix."""
        most = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, most), self.ancestor(b, most)
        if self._same(a, b):
            return most
        # Both differ; go up as far as they still do.
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and k < len(self.up[b]) and not self._same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.depth[a] - 1

    def less(self, a: int, b: int) -> bool:
        if a == b:
            return False
        n = self.common(a, b)
        if n in (self.depth[a], self.depth[b]):
            return self.depth[a] < self.depth[b]
        return self.letter[self.ancestor(a, n + 1)] < self.letter[self.ancestor(b, n + 1)]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class Best:
    """The best audit of each state; ``offer`` takes one as (cost, audit before, letter)."""

    def __init__(self, audits: Audits) -> None:
        self.audits, self.found = audits, [None] * len(STATES)

    def offer(self, state: int, cost: int, before: int, letter: str = "") -> bool:
        old = self.found[state]
        if old is not None and old[0] < cost:
            return False
        node = self.audits.extend(before, letter) if letter else before
        if old is not None and old[0] == cost and not self.audits.less(node, old[1]):
            return False
        self.found[state] = (cost, node)
        return True


def _insert(best: Best) -> None:
    """Turns put in here: to user from nothing, system or assistant, to assistant from user."""
    changed = True
    while changed:
        changed = False
        for state in STATES:
            if best.found[state] is not None:
                cost, node = best.found[state]
                changed |= best.offer(ASSISTANT if state == USER else USER, cost + INSERT, node, "I")


def best_audits(turns: list[tuple[str, bool, bool]], start: int, last: bool) -> list[tuple[int, str] | None]:
    """Per end state the cost and audit of ``turns`` (initial, must go, truncated) from state ``start``.

    With ``last`` turns may be inserted behind the last one.
    """
    audits = Audits()
    best = Best(audits)
    best.offer(start, 0, 0)
    for initial, gone, cut in turns:
        _insert(best)
        after, stay = Best(audits), CUT * cut
        for state in STATES:
            if best.found[state] is None:
                continue
            cost, node = best.found[state]
            after.offer(state, cost + DELETE, node, "D")
            if gone:
                continue
            if state == USER:
                after.offer(ASSISTANT, cost + stay + (initial != "a"), node, "K" if initial == "a" else "R")
            else:
                after.offer(USER, cost + stay + (initial != "u"), node, "K" if initial == "u" else "R")
                if state == EMPTY and initial == "s":
                    after.offer(SYSTEM, cost + stay, node, "K")
        best = after
    if last:
        _insert(best)
    return [None if f is None else (f[0], audits.text(f[1])) for f in best.found]


def least(found: list[tuple[int, str] | None]) -> tuple[int, str]:
    """The best audit that may end here."""
    return min(found[s] for s in FINAL if found[s] is not None)


class Repaired:
    """Digest of the repaired turns, given one by one with an audit."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.user, self.sha, self.lines = audit, 0, True, hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1
        self.user = role[:1] != "u"

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line("user" if self.user else "assistant", "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._line(role, text)
        elif edit == "R":
            self._line("user" if self.user else "assistant", text)

    def digest(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


def damaged(df: DataFrame) -> DataFrame:
    """The rows of ``conv_id``, ``turn``, ``role``, ``text`` after the deterministic damage; dropped ones are marked.

    ``role0``, ``text0`` and ``copy`` order turns of equal number.
    """
    space = F.lit(" ")
    rows = df.select(
        named("conv_id").cast("bigint").alias("conv_id"), named("turn").cast("bigint").alias("turn"),
        F.coalesce(named("role").cast("string"), space).alias("role"), F.coalesce(named("text").cast("string"), space).alias("text"),
    )
    # Rows equal in all columns are counted first, so that their copies have numbers.
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("kind", (F.crc32(name) % 20).cast("int"))
    kind = F.col("kind")
    times = F.col("copies") * F.when(kind == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.col("role").alias("role0"), F.sha2("text", 256).alias("text0"),
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("dropped"), F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    )


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` with each turn's first fault: blank, duplicate (role and text seen before), truncated."""
    sized = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    owner = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    rows = rows.withColumn("same", F.sha2(F.concat(owner, F.lit(":"), sized), 256))
    rows = written(rows, "turns")
    place = F.struct(*[F.col(c) for c in ORDER[1:]])
    first = rows.where("NOT dropped").groupBy("same").agg(F.min(place).alias("first"))
    rows = attach(rows, first, "same", "left")
    blank = ~F.col("text").rlike(NOT_BLANK)
    # The last character that is not white space.
    cut = ~F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")).rlike(r"[.!?]\z")
    fault = F.when(blank, "b").when(~place.eqNullSafe(F.col("first")), "d").when(cut, "t").otherwise("")
    return rows.select(*ORDER, "role", "text", "dropped", fault.alias("fault"))


SEGMENT = (
    "conv_id bigint, slice int, border boolean, n bigint, turns bigint, least bigint, most bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, first string, last string, costs array<array<bigint>>, audits array<array<string>>, sha string"
)
_FIELDS = [x.split()[0] for x in SEGMENT.split(", ")]
_LEGAL = {"su", "ua", "au"}


def _segment(conv, part: int, turns: list, begins: bool, border: bool) -> tuple:
    """What a conversation's turns in one range come to; ``begins``: none of its turns are in a range before."""
    rows = [t for t in turns if not t[3]]
    numbers = [t[0] for t in rows if t[0] is not None]
    initials, faults = [t[1][:1] for t in rows], [t[4] for t in rows]
    symbols = [(i, f in ("b", "d"), f == "t") for i, f in zip(initials, faults)]
    digest, nowhere = None, [None] * len(STATES)
    if border:
        found = [best_audits(symbols, s, False) if s == EMPTY or not begins else nowhere for s in STATES]
    else:
        best = least(best_audits(symbols, EMPTY, True))
        found = [[best, None, None, None]]
        repaired = Repaired(best[1])
        for t in rows:
            repaired.turn(t[1], t[2])
        digest = repaired.digest()
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    return (
        conv, part, border, len(rows), len(set(numbers)), min(numbers, default=None), max(numbers, default=None),
        *map(faults.count, "bdt"), illegal, *((initials[0], initials[-1]) if rows else (None, None)),
        [[x and x[0] for x in f] for f in found], [[x and x[1] for x in f] for f in found], digest,
    )


def _conversations(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bool, list]]:
    """Runs of equal ``conv_id`` of a sorted range, and whether they are at its border."""
    conv, turns, first = None, [], True
    for batch in parts:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped", "fault")]
        for key, *turn in zip(*columns):
            if turns and key != conv:
                yield conv, first, turns
                turns, first = [], False
            conv = key
            turns.append(turn)
    if turns:
        yield conv, True, turns


def _segments(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, out, weight = TaskContext.get().partitionId(), [], 0
    types = pa.schema([(n, _ARROW.get(n, pa.int64())) for n in _FIELDS])

    def batch(rows: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)

    for number, (conv, border, turns) in enumerate(_conversations(parts)):
        out.append(_segment(conv, part, turns, number > 0, border))
        weight += len(turns)
        if weight > BATCH_TURNS:
            yield batch(out)
            out, weight = [], 0
    if out:
        yield batch(out)


_ARROW = {
    "slice": pa.int32(), "border": pa.bool_(), "first": pa.string(), "last": pa.string(), "sha": pa.string(),
    "costs": pa.list_(pa.list_(pa.int64())), "audits": pa.list_(pa.list_(pa.string())),
}

WHOLE = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _composed(table: pa.Table) -> pa.Table:
    """One conversation from its segments: the best audits of one range continue those of the ranges before."""
    rows = sorted(table.to_pylist(), key=lambda r: r["slice"])
    state: list[tuple[int, str] | None] = [(0, ""), None, None, None]
    gaps = illegal = turns = 0
    least_turn = most_turn = last = None
    audits = Audits()
    for r in rows:
        after: list[tuple[int, str] | None] = [None] * len(STATES)
        for s in STATES:
            for e in STATES:
                if state[s] is not None and r["costs"][s][e] is not None:
                    new = (state[s][0] + r["costs"][s][e], state[s][1] + r["audits"][s][e])
                    after[e] = new if after[e] is None else min(after[e], new)
        state = after
        if r["n"]:
            illegal += r["illegal"] + (last is not None and last + r["first"] not in _LEGAL)
            last = r["last"]
        if r["turns"]:
            # A turn's number may go on from the range before.
            turns += r["turns"] - (most_turn == r["least"])
            least_turn = r["least"] if least_turn is None else least_turn
            most_turn = r["most"]
    gaps = most_turn - least_turn + 1 - turns if turns else 0
    # Turns inserted behind the last one.
    best = Best(audits)
    for s in STATES:
        if state[s] is not None:
            node = 0
            for letter in state[s][1]:
                node = audits.extend(node, letter)
            best.found[s] = (state[s][0], node)
    _insert(best)
    cost, audit = least([None if f is None else (f[0], audits.text(f[1])) for f in best.found])
    sums = [sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")]
    out = [rows[0]["conv_id"], gaps, *sums, illegal, cost, audit]
    names = [x.split()[0] for x in WHOLE.split(", ")]
    return pa.table([pa.array([v], pa.string() if n == "audit" else pa.int64()) for n, v in zip(names, out)], names=names)


def _digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest per conversation of a stream of (``conv_id``, audit or null, turn), the audit first."""
    conv, repaired, out = None, None, []
    for batch in parts:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "dropped")]
        for key, audit, role, text, dropped in zip(*columns):
            if audit is not None:
                if repaired is not None:
                    out.append((conv, repaired.digest()))
                conv, repaired = key, Repaired(audit)
            elif not dropped:
                repaired.turn(role, text)
    if repaired is not None:
        out.append((conv, repaired.digest()))
    yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], names=["conv_id", "sha"])


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``judged`` rows: ``gaps``, faults, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``."""
    rows = written(rows, "judged")
    ranged = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    segments = written(ranged.mapInArrow(_segments, SEGMENT), "segments")
    own = segments.where("NOT border").select(
        "conv_id", F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank", "duplicate",
        "truncated", "illegal", F.col("costs")[0][0].alias("cost"), F.col("audits")[0][0].alias("audit"), F.col("sha").alias("repaired_sha256"),
    )
    # At most two conversations a range.
    crossing = segments.where("border").groupBy("conv_id").applyInArrow(_composed, WHOLE)
    crossing = written(crossing, "crossing")
    of = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    wanted = crossing.select(of.alias("of"))
    long = attach(rows.withColumn("of", of), wanted, "of").drop("of")
    heads = crossing.select("conv_id", "audit")
    stream = long.withColumn("audit", F.lit(None).cast("string")).unionByName(heads, allowMissingColumns=True)
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER[1:])
    digests = stream.select("conv_id", "audit", "role", "text", "dropped").mapInArrow(_digests, "conv_id bigint, sha string")
    digests = digests.select(of.alias("of"), F.col("sha").alias("repaired_sha256"))
    crossing = crossing.withColumn("of", of).join(digests, "of").drop("of")
    return own.unionByName(crossing)
