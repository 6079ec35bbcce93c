"""Operator 8: secrets by fixed patterns, and by a linear-chain conditional random field.

Tokens are runs of key characters or of marks. Each token is tagged secret-begin (B), secret-inside (I)
or outside (O) from its shape, its own and its neighbours' words and shapes, and features of its text.
Weights are trained on windows around values that the patterns find and on windows without, from at most
``SAMPLE`` texts with matches and as many without, at most ``PLACES`` of each per text, drawn by hash. Half
of the windows hide all words (a key word, a fixed prefix), so that shapes and the neighbours' shapes carry
weight of their own and secrets are found that no pattern covers. Decoding is exact Viterbi: a token whose O beats B and I by more than any
transitions can gain is O on every best path, so whole texts are decoded as the short runs in between.

Pattern spans always stay; model spans that touch none of them are added as kind ``crf``. Spans count
code points, end exclusive. Null and empty texts have no spans. Equal texts get equal spans. With no
pattern match in the table the model adds nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.wordhash import batches, mix

#: Kinds in their order, with pattern and the least length of the last group (or of the match).
_KEYWORD = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    for w in ("password", "passwd", "secret", "token", "api_?key")
)
ASSIGN = re.compile(rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "crf")
HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")

B, I, O = 0, 1, 2
BUCKETS = 1 << 16
TEMPLATES = 12
#: Templates that hold a word: hidden in half of the training windows.
WORDS = (2, 3, 4, 5, 8)
HIDDEN = -1
SAMPLE = 1500
PLACES = 4
WINDOW = 15
MIN_LENGTH = 8

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Pattern matches that are long enough, by start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    # A run of 16 or more characters is found from its start, since shorter runs cannot match.
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def secret_values(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves are in the matches: without the key word of an assignment."""
    out = []
    for start, end, kind in base_spans(text):
        out.append(ASSIGN.match(text, start, end).span(2) if kind == "assign" else (start, end))
    return out


def written_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# Character classes: 0 gap, 1 lower, 2 upper, 3 digit, 4 key mark, 5 other mark.
_CLASS = np.full(128, 5, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[ord(c) for c in "+/_.=-"]] = 4
_SALT = mix(np.arange(1, TEMPLATES + 1, dtype=np.uint64))


class Tokens(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # first token of each text
    feature: np.ndarray  # buckets, one row per token


def tokens(texts: list[str]) -> Tokens:
    """Tokens of many texts; positions are code points in the texts laid end to end."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    border = np.cumsum([0] + [len(t) for t in texts])
    kind = np.where(code < 128, _CLASS[np.minimum(code, 127)], 1).astype(np.uint8)
    group = np.where(kind == 0, 0, np.where(kind == 5, 2, 1)).astype(np.uint8)
    change = np.ones(len(code) + 1, bool)
    change[1:-1] = group[1:] != group[:-1]
    change[border] = True
    edge = np.flatnonzero(change)
    start, end = edge[:-1], edge[1:]
    real = group[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[real], end[real]
    first = np.searchsorted(start, border)
    if not len(start):
        return Tokens(start, end, first, np.zeros((0, TEMPLATES), np.int64))
    length = end - start

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[end] - total[start]) * 4 // length

    def level(n: np.ndarray, most: int) -> np.ndarray:
        return np.minimum(np.log2(n + 1).astype(np.int64), most)

    turns = np.concatenate(([0], np.cumsum(kind[1:] != kind[:-1]), [0]))
    turns = level(turns[end - 1] - turns[start], 5)
    shape = level(length, 7)
    rough = case = shape
    for k, mask in enumerate((kind == 1, kind == 2, kind == 3, (kind == 3) | ((code >= 97) & (code <= 102)))):
        part = share(mask)
        shape = shape * 5 + part
        case = case * 2 + (part > 0) if k < 3 else case
    rough = (rough * 6 + turns) * 2 + case % 2  # the last class of ``case`` is digits
    shape = (shape * 6 + turns) * 3 + group[start]
    low = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint64)
    place = np.minimum(np.arange(len(code)) - np.repeat(start_of_run(change), np.diff(edge)), 1 << 20)
    letters = np.cumsum(mix(low + (place.astype(np.uint64) << np.uint64(24))), dtype=np.uint64)
    mixed = np.concatenate((np.zeros(1, np.uint64), letters))
    word = mix(mixed[end] - mixed[start])
    # File features: size of the text, share of digits in it.
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    size = level(np.diff(border), 20)
    digits = np.concatenate(([0], np.cumsum(kind == 3)))
    digits = (digits[border[1:]] - digits[border[:-1]]) * 50 // np.maximum(np.diff(border), 1)
    file = (size * 64 + np.minimum(digits, 63))[row]

    def near(values: np.ndarray, shift: int) -> np.ndarray:
        """The value ``shift`` tokens before (or after, if negative) within the text, else 1."""
        out = np.ones_like(values)
        if abs(shift) < len(values):
            a, b = (slice(shift, None), slice(None, -shift)) if shift > 0 else (slice(None, shift), slice(-shift, None))
            out[a] = np.where(row[a] == row[b], values[b], out[a])
        return out

    shape = shape.astype(np.uint64)
    columns = [np.zeros_like(shape), shape, word, near(word, 1), near(word, 2), near(word, -1),
               near(shape, 1), near(shape, -1), mix(near(word, 1)) ^ shape, mix(file.astype(np.uint64)) ^ level(length, 7).astype(np.uint64),
               rough.astype(np.uint64), case.astype(np.uint64)]
    feature = np.stack([mix(c ^ s) & np.uint64(BUCKETS - 1) for c, s in zip(columns, _SALT)], axis=1)
    return Tokens(start, end, first, feature.astype(np.int64))


def start_of_run(change: np.ndarray) -> np.ndarray:
    return np.flatnonzero(change)[:-1]


def labels(found: Tokens, row: int, offset: int, values: list[tuple[int, int]]) -> np.ndarray:
    """Tags of one text's tokens from the secret values in it."""
    a, b = found.first[row], found.first[row + 1]
    tag = np.full(b - a, O)
    if values:
        place = np.array(values) + offset
        for lo, hi in zip(
            np.searchsorted(found.end[a:b], place[:, 0], "right").tolist(),
            np.searchsorted(found.start[a:b], place[:, 1], "left").tolist(),
        ):
            tag[lo:hi] = I
            tag[lo : min(lo + 1, hi)] = B
    return tag


def _sampled(df: DataFrame, limit: int) -> DataFrame:
    """``text`` of at most ``limit`` different texts with a match and as many without, by least hashes.

    One pass hashes the texts and looks for matches; the second keeps what lies below the two last hashes.
    """
    match = F.col("text").rlike(f"{ASSIGN.pattern}|AKIA[A-Z0-9]{{14}}|[0-9a-f]{{16}}")
    hashed = df.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("h"))
    least = Window.partitionBy("match").orderBy("h")
    ranked = hashed.select("h", match.alias("match")).distinct().withColumn("n", F.row_number().over(least))
    last = {r.match: r.h for r in ranked.where(F.col("n") <= limit).groupBy("match").agg(F.max("h").alias("h")).collect()}
    chosen = F.lit(False)
    for found, test in ((True, match), (False, ~match)):
        if found in last:
            chosen = chosen | ((F.col("h") <= last[found]) & test)
    return hashed.where(chosen).dropDuplicates(["h"]).orderBy("h").select("text")


class Model(NamedTuple):
    weight: np.ndarray  # BUCKETS x 3
    transition: np.ndarray  # 3 x 3, from row to column


def training_windows(df: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and tags of windows of ``2 * WINDOW + 1`` tokens; a tag of -1 is beyond the text."""
    wide = 2 * WINDOW + 1

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for lo, hi in batches(batch.column(0)):
                texts = batch.column(0).slice(lo, hi - lo).to_pylist()
                found, offset = tokens(texts), 0
                rows, tags = [], []
                for d, text in enumerate(texts):
                    tag = labels(found, d, offset, secret_values(text))
                    offset += len(text)
                    if not len(tag):
                        continue
                    draw = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
                    begins = np.flatnonzero(tag == B)
                    centres = [*draw.permutation(begins)[:PLACES], *draw.integers(0, len(tag), PLACES)]
                    for n, centre in enumerate(centres):
                        at = centre - WINDOW + np.arange(wide)
                        inside = (at >= 0) & (at < len(tag))
                        at = np.clip(at, 0, len(tag) - 1)
                        feature = found.feature[found.first[d] + at]
                        if (n + len(begins)) % 2:
                            feature[:, WORDS] = HIDDEN
                        rows.append(feature)
                        tags.append(np.where(inside, tag[at], -1))
                if rows:
                    flat = pa.array(np.concatenate(rows).ravel(), pa.int32())
                    offsets = pa.array(np.arange(len(rows) + 1) * wide * TEMPLATES, pa.int32())
                    tag = pa.array(np.concatenate(tags), pa.int32())
                    steps = pa.array(np.arange(len(rows) + 1) * wide, pa.int32())
                    yield pa.record_batch(
                        [pa.ListArray.from_arrays(offsets, flat), pa.ListArray.from_arrays(steps, tag)], names=["f", "t"]
                    )

    found = _sampled(df, limit).mapInArrow(run, "f array<int>, t array<int>").toPandas()
    if not len(found):
        return np.zeros((0, wide, TEMPLATES), np.int64), np.zeros((0, wide), np.int64)
    return np.stack(found["f"]).reshape(-1, wide, TEMPLATES), np.stack(found["t"]).reshape(-1, wide)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def fit(feature: np.ndarray, tag: np.ndarray, rounds: int = 80) -> Model | None:
    """Maximum likelihood by forward-backward and Adam; None where no token is tagged as secret."""
    if not (tag == B).any():
        return None
    n, wide = tag.shape
    real, gold = tag >= 0, np.where(tag >= 0, tag, O)
    names, column = np.unique(feature, return_inverse=True)
    column = column.reshape(n, wide, TEMPLATES)
    weight, transition = np.zeros((len(names), 3)), np.zeros((3, 3))
    aim = np.zeros((n, wide, 3))
    np.put_along_axis(aim, gold[..., None], 1, axis=2)
    pair_aim = np.einsum("nti,ntj->ij", aim[:, :-1], aim[:, 1:])
    states = [[np.zeros_like(weight), np.zeros_like(weight)], [np.zeros_like(transition), np.zeros_like(transition)]]
    for turn in range(1, rounds + 1):
        emit = weight[column].sum(axis=2)
        emit[~real] = (-50.0, -50.0, 0.0)  # beyond the text all is O
        ahead, back = np.empty_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for t in range(1, wide):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + transition, 1) + emit[:, t]
        for t in range(wide - 2, -1, -1):
            back[:, t] = _log_sum(transition + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        total = _log_sum(ahead[:, -1], 1)
        belief = np.exp(ahead + back - total[:, None, None])
        pair = np.exp(ahead[:, :-1, :, None] + transition + (emit[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None])
        error = (belief - aim) * real[..., None]
        slopes = [np.stack([np.bincount(column.ravel(), np.repeat(error[..., k].ravel(), TEMPLATES), minlength=len(names))
                            for k in range(3)], axis=1) / n + 1e-4 * weight, (pair.sum(axis=(0, 1)) - pair_aim) / n]
        changes = []
        for (moment, square), slope in zip(states, slopes):
            moment *= 0.9
            moment += 0.1 * slope
            square *= 0.999
            square += 0.001 * slope**2
            changes.append(0.1 * (moment / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8))
        weight, transition = weight - changes[0], transition - changes[1]
        weight[names == HIDDEN] = 0  # a hidden word says nothing
    full = np.zeros((BUCKETS, 3), np.float32)
    full[names[names != HIDDEN]] = weight[names != HIDDEN]
    # Unseen features say nothing; a token of them alone falls back on the bias template.
    return Model(full, transition.astype(np.float32))


def decode(found: Tokens, model: Model) -> np.ndarray:
    """Best tag of every token, by Viterbi over each whole text."""
    emit = np.zeros((len(found.start), 3), np.float32)
    for k in range(TEMPLATES):
        emit += model.weight[found.feature[:, k]]
    gain = 2 * float(model.transition.max() - model.transition.min())
    open_ = emit[:, O] - emit[:, :O].max(axis=1) <= gain
    tag = np.full(len(emit), O)
    at = np.flatnonzero(open_)
    if not len(at):
        return tag
    text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    new = np.concatenate(([True], (np.diff(at) > 1) | (text[at[1:]] != text[at[:-1]])))
    begin = at[new]
    length = np.diff(np.append(np.flatnonzero(new), len(at)))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    # A run between certain tokens starts and ends beside O, unless its text does.
    before = (begin > 0) & (text[np.maximum(begin - 1, 0)] == text[begin])
    stop = begin + length
    after = (stop < len(emit)) & (text[np.minimum(stop, len(emit) - 1)] == text[begin])
    best = emit[begin] + np.where(before[:, None], model.transition[O], 0)
    trace = []
    for t in range(1, int(length[0])):
        live = int(np.searchsorted(-length, -t, side="left"))
        options = best[:live, :, None] + model.transition
        trace.append(options.argmax(axis=1))
        best[:live] = options.max(axis=1) + emit[begin[:live] + t]
    last = (best + np.where(after[:, None], model.transition[:, O], 0)).argmax(axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        live = int(np.searchsorted(-length, -t, side="left")) if t else len(length)
        tag[begin[:live] + t] = last[:live]
        if t:
            last[:live] = np.take_along_axis(trace[t - 1], last[:live, None], axis=1)[:, 0]
    return tag


def model_spans(found: Tokens, tag: np.ndarray, row: int, offset: int, taken: list[Span]) -> list[Span]:
    """Secrets of one text that touch no pattern span: runs of B, I, ... of enough characters."""
    a, b = found.first[row], found.first[row + 1]
    secret = np.flatnonzero(tag[a:b] != O) + a
    out: list[list[int]] = []
    for t in secret.tolist():
        if out and tag[t] == I and out[-1][2] == t - 1:
            out[-1][1:] = [int(found.end[t]) - offset, t]
        else:
            out.append([int(found.start[t]) - offset, int(found.end[t]) - offset, t])
    begins = [x for x, _, _ in taken]
    reach = [0, *accumulate((y for _, y, _ in taken), max)]  # the farthest end among the first spans
    return [(s, e, "crf") for s, e, _ in out if e - s >= MIN_LENGTH and reach[bisect_left(begins, e)] <= s]


SPANS = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_crf bigint"
)


def find(df: DataFrame, model: Model | None, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every row's whole text."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # 3 * BUCKETS numbers

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in parts:
            for lo, hi in batches(batch.column(1), 1 << 20):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                found = tokens(texts) if model else None
                tag = decode(found, model) if model else None
                offset, rows = 0, []
                for d, text in enumerate(texts):
                    base = base_spans(text)
                    more = model_spans(found, tag, d, offset, base) if model else []
                    offset += len(text)
                    kinds = [k for _, _, k in base]
                    both = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))
                    digest = hashlib.sha256(written_spans(base).encode()).hexdigest()
                    rows.append((*(kinds.count(k) for k in KINDS[:3]), digest, written_spans(both), len(more)))
                columns = [pa.array(c) for c in zip(*rows)]
                names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"]
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *columns], names=names)

    rows = df.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SPANS)


def secrets(df: DataFrame, limit: int = SAMPLE, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on pattern matches of a bounded sample, then find spans in every row."""
    rows = df.select(F.col(id).cast("bigint").alias(id), F.col(text).cast("string").alias("text"))
    model = fit(*training_windows(rows, limit))
    return find(rows, model, id=id, text="text")
