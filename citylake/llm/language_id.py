"""Operator 13: language of whole texts, from labelled spans of their words.

A word is a run of letters and characters beyond ASCII. Its score for a language is the sum of the log ratios of
its character n-grams (3 to 5 bytes, borders included), counted in all training texts. The script of its
first character narrows the candidates: languages that write less than ``SCRIPT_SHARE`` of their words in that
script are put far behind. Over a text's words the best sequence of languages is found by Viterbi, where each change of
language costs ``SWITCH``; runs of equal labels are spans. The predicted language is the one with most
bytes of words, its share of them the score.

The programme runs on pieces of ``CHUNK`` words side by side: first from every possible state before a piece, then,
with the pieces of a text joined, once more from the right one. The work grows with words times languages
squared, the memory with the words of a text.

Defined results: a null text or one without letters is ``und`` with score 0, as is every text where nothing was learned. A
word that the model knows nothing about follows its neighbours; if there are none, the language with most
training words wins, then the first by name. Words of more than ``PIECE`` bytes are scored in parts. Equal texts
get equal results, repeated rows stay. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.wordhash import batches, buffers, mix
from citylake.operators.schema import named

BUCKETS = 1 << 17
SIZES = (3, 4, 5)
PIECE = 1 << 20
#: Weight of the shared distribution of n-grams in each language's.
SMOOTHING = 500.0
SWITCH = 10.0
SCRIPT_SHARE = 0.01
NARROW = -30.0
CHUNK = 128
UNKNOWN = "und"
#: Languages whose counts a task holds before it hands them on.
HELD = 32

#: First and last code points of scripts.
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Sinhala": [(0xD80, 0xDFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Lao": [(0xE80, 0xEFF)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)],
}
_RANGES = sorted((lo, hi, n) for n, ranges in enumerate(SCRIPTS.values(), 1) for lo, hi in ranges)
_LOW, _HIGH, _NUMBER = (np.array(c) for c in zip(*_RANGES))

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Model(NamedTuple):
    """Languages in order of name, weights per n-gram bucket, a penalty per script, and log shares of words."""

    languages: list[str]
    weight: np.ndarray
    narrow: np.ndarray
    prior: np.ndarray


class WordList(NamedTuple):
    """Words of a piece: place in its bytes, row, script; and their n-grams as (word, bucket)."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    script: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]


def scripts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Script number of the UTF-8 characters that begin at ``at``; 0 for any other."""
    wide = np.concatenate((data, np.zeros(4, np.uint8))).astype(np.int64)
    lead, follow = wide[at], [wide[at + k] & 0x3F for k in (1, 2, 3)]
    code = np.select(
        [lead < 0x80, lead < 0xE0, lead < 0xF0],
        [lead, (lead & 0x1F) << 6 | follow[0], (lead & 0x0F) << 12 | follow[0] << 6 | follow[1]],
        (lead & 0x07) << 18 | follow[0] << 12 | follow[1] << 6 | follow[2],
    )
    k = np.searchsorted(_LOW, code, side="right") - 1
    return np.where((k >= 0) & (code <= _HIGH[k]), _NUMBER[k], 0)


def pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, offsets of their rows and number of the first: many short texts, or a part of a long one."""
    for lo, hi in batches(column, PIECE):
        data, offsets = buffers(column.slice(lo, hi - lo))
        if hi - lo > 1 or len(data) <= PIECE:
            yield data, offsets, lo
            continue
        begin = 0
        while begin < len(data):
            end = min(begin + PIECE, len(data))
            if end < len(data):
                gaps = np.flatnonzero(~_LETTER[data[begin:end]])
                # Without a gap between words: before a character.
                end = begin + int(gaps[-1]) + 1 if len(gaps) else end - int(np.argmax((data[end:end - 4:-1] & 0xC0) != 0x80))
            yield data[begin:end], np.array([0, end - begin]), lo
            begin = end


def word_list(data: np.ndarray, offsets: np.ndarray) -> WordList:
    n = len(offsets) - 1
    # A border on both sides of every text.
    row = np.repeat(np.arange(n), np.diff(offsets))
    inside = np.arange(len(data)) + row + 1
    text = np.full(len(data) + n + 1, 32, np.uint8)
    text[inside] = _FOLD[data]
    # Capitals of the Latin-1 letters.
    capital = (text[1:] >= 0x80) & (text[1:] <= 0x9E) & (text[1:] != 0x97) & (text[:-1] == 0xC3)
    text[1:][capital] += 32
    letter = _LETTER[text]
    text[~letter] = 32
    edge = np.diff(letter.astype(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    number = np.cumsum(np.concatenate(([False], edge == 1))) - 1
    gaps = np.concatenate(([0], np.cumsum(~letter)))
    wide, grams = text.astype(np.uint64), []
    for size in SIZES:
        last = len(text) - size + 1
        if last < 1:
            continue
        # No border within: all but the first and the last byte are of the word.
        at = np.flatnonzero(gaps[size - 1 : size - 1 + last] == gaps[1 : last + 1])
        code = np.full(len(at), size, np.uint64)
        for k in range(size):
            code = (code << np.uint64(8)) | wide[at + k]
        grams.append((number[at + 1], (mix(code) & np.uint64(BUCKETS - 1)).astype(np.int64)))
    owner = np.searchsorted(offsets + np.arange(n + 1), start - 1, side="right") - 1
    place = start - 1 - owner
    return WordList(place, place + end - start, owner, scripts(data, place), grams)


def learn(labelled: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Counts n-grams and scripts of all rows with a language."""
    rows = labelled.select(named(text).cast("string").alias("text"), named(lang).cast("string").alias("lang"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    # One row per language.
    languages = sorted((r[0] for r in rows.select("lang").distinct().collect()), key=str.encode)
    place = {name: k for k, name in enumerate(languages)}

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def handed() -> pa.RecordBatch:
            some = [(k, np.flatnonzero(c)) for k, c in held.items()]
            keys = [np.repeat([k for k, _ in some], [len(at) for _, at in some]), np.concatenate([at for _, at in some])]
            return pa.record_batch(
                [pa.array(keys[0], pa.int32()), pa.array(keys[1], pa.int32()), pa.array(np.concatenate([held[k][at] for k, at in some]))],
                names=["lang", "feature", "n"],
            )

        for batch in parts:
            code = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            for data, offsets, first in pieces(batch.column("text")):
                found = word_list(data, offsets)
                of = code[first + found.row]
                for k in np.unique(of).tolist():
                    counts = held.setdefault(k, np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
                    mine = of == k
                    counts[BUCKETS:] += np.bincount(found.script[mine], minlength=len(SCRIPTS) + 1)
                    for word, bucket in found.grams:
                        counts[:BUCKETS] += np.bincount(bucket[mine[word]], minlength=BUCKETS)
                if len(held) > HELD:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    counted = rows.mapInArrow(count, "lang int, feature int, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    # At most one row for each language and bucket: the size of the model.
    table = counted.toArrow()
    counts = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(languages)))
    counts[table["feature"].to_numpy(), table["lang"].to_numpy()] = table["n"].to_numpy()
    grams, written = counts[:BUCKETS], counts[BUCKETS:]
    shared = (grams.sum(axis=1, keepdims=True) + 1) / (grams.sum() + BUCKETS)
    odds = np.log((grams + SMOOTHING * shared) / (grams.sum(axis=0) + SMOOTHING))
    # N-grams overlap, so each size counts in part.
    weight = (odds - odds.mean(axis=1, keepdims=True)) / len(SIZES) if languages else odds
    total = written.sum(axis=0)
    used = written >= SCRIPT_SHARE * np.maximum(total, 1)
    used[0] = True  # characters of no script
    used[~used.any(axis=1)] = True
    prior = np.log((total + 1) / (total.sum() + max(1, len(languages))))
    return Model(languages, weight.astype(np.float32), np.where(used, 0, NARROW).astype(np.float32), prior.astype(np.float32))


def word_scores(found: WordList, model: Model) -> np.ndarray:
    out = model.narrow[found.script]
    for word, bucket in found.grams:
        ahead = np.concatenate((np.zeros((1, out.shape[1])), np.cumsum(model.weight[bucket], axis=0, dtype=np.float64)))
        first = np.searchsorted(word, np.arange(len(out) + 1))
        out = out + (ahead[first[1:]] - ahead[first[:-1]]).astype(np.float32)
    return out


def _forward(state: np.ndarray, step: np.ndarray) -> np.ndarray:
    return np.maximum(state, state.max(axis=-1, keepdims=True) - SWITCH) + step


def viterbi(scores: np.ndarray, first: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Best language of every word; text ``d`` has words ``first[d]`` to ``first[d + 1]``."""
    n = len(prior)
    sizes = np.diff(first)
    chunks = -(-sizes // CHUNK)
    head = np.concatenate(([0], np.cumsum(chunks)))
    text = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(scores)) - first[text]
    chunk, at = head[text] + inner // CHUNK, inner % CHUNK
    steps = np.zeros((CHUNK, head[-1], n), np.float32)  # words that fill up change nothing
    steps[at, chunk] = scores
    # From each state before a chunk to each after it, as differences from a far lower bound.
    through = np.broadcast_to(np.where(np.eye(n, dtype=bool), 0, -1e6).astype(np.float32), (head[-1], n, n))
    long = np.flatnonzero(chunks > 1)
    before = np.zeros(head[-1], np.int64)  # the state before a chunk that continues a text
    if len(long):
        some = np.concatenate([np.arange(head[d], head[d + 1]) for d in long])
        through = through[some]
        for step in steps[:, some]:
            through = _forward(through, step[:, None, :])
        begin = np.cumsum(chunks[long]) - chunks[long]
        came = np.zeros((len(some), n), np.int64)
        state = np.tile(prior, (len(long), 1))
        live = np.arange(len(long))
        for k in range(int(chunks[long].max())):
            live = live[chunks[long][live] > k]
            paths = state[live][:, :, None].astype(np.float64) + through[begin[live] + k]
            came[begin[live] + k] = paths.argmax(axis=1)
            best = paths.max(axis=1)
            state[live] = best - best.max(axis=1, keepdims=True)
        end = state.argmax(axis=1)
        for k in reversed(range(int(chunks[long].max()))):
            live = np.flatnonzero(chunks[long] > k)
            before[head[long[live]] + k] = end[live] = came[begin[live] + k, end[live]]
    state = np.where(np.eye(n, dtype=bool)[before], 0, -1e6).astype(np.float32)
    state[head[:-1][chunks > 0]] = prior
    seen = np.empty((CHUNK + 1, head[-1], n), np.float32)
    seen[0] = state
    for k in range(CHUNK):
        seen[k + 1] = _forward(seen[k], steps[k])
    last = seen[CHUNK].argmax(axis=1)
    # A chunk ends where the next one of its text begins.
    follows = np.ones(head[-1], bool)
    follows[head[:-1][chunks > 0]] = False
    last[np.flatnonzero(follows) - 1] = before[follows]
    labels, every = np.empty((CHUNK, head[-1]), np.int64), np.arange(head[-1])
    for k in reversed(range(CHUNK)):
        labels[k] = last
        top = seen[k].argmax(axis=1)
        last = np.where(seen[k][every, last] >= seen[k][every, top] - np.float32(SWITCH), last, top)
    return labels[at, chunk]


SPANS = "array<struct<lang:string,start:int,end:int>>"


def _batch_result(text: pa.Array, lettered: np.ndarray, model: Model, spans: bool) -> list[pa.Array]:
    """Language, score and spans (in characters) of a batch's texts."""
    n, parts = len(model.languages), []
    shift, where = 0, None
    for data, offsets, first in pieces(text):
        shift = shift if where == first else 0  # a long text goes on in the next piece
        found = word_list(data, offsets)
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        base = chars[offsets[:-1]][found.row] - (shift if len(offsets) == 2 else 0)
        parts.append((first + found.row, found.end - found.start, word_scores(found, model), chars[found.start] - base, chars[found.end] - base))
        shift, where = (shift + int(chars[-1]) if len(offsets) == 2 else 0), first
    row, size, scores, start, end = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
    first = np.searchsorted(row, np.arange(len(text) + 1))
    label = viterbi(scores, first, model.prior) if len(row) and n else np.zeros(0, np.int64)
    share = np.zeros((len(text), max(n, 1)))
    if len(label):
        share = np.bincount(row * n + label, size, minlength=len(text) * n).reshape(len(text), n)
    total = share.sum(axis=1)
    known = lettered & (total > 0)
    best = share.argmax(axis=1)
    score = np.where(known, share.max(axis=1) / np.maximum(total, 1), 0.0)
    names = np.array([*model.languages, UNKNOWN], object)
    out = [pa.array(names[np.where(known, best, n)], pa.string()), pa.array(score)]
    if spans:
        mine = known[row]
        row, start, end, label = row[mine], start[mine], end[mine], label[mine[: len(label)]]
        new = np.ones(len(label), bool)
        new[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        stop = np.append(at[1:], len(label)) - 1 if len(at) else at
        columns = [pa.array(names[label[at]], pa.string()), pa.array(start[at], pa.int32()), pa.array(end[stop], pa.int32())]
        ranges = pa.array(np.searchsorted(row[at], np.arange(len(text) + 1)), pa.int32())
        out.append(pa.ListArray.from_arrays(ranges, pa.StructArray.from_arrays(columns, ["lang", "start", "end"])))
    return out


def identify(df: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", spans: bool = True) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every row, and the ``spans`` of its text in one language each."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # one number for each language and bucket

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "lang_pred", "score", *(["spans"] if spans else [])]
        for batch in parts:
            for lo, hi in batches(batch.column(1), 4 * PIECE):
                key, words, lettered = (batch.column(c).slice(lo, hi - lo) for c in range(3))
                lettered = np.asarray(lettered.to_numpy(zero_copy_only=False), bool)
                yield pa.record_batch([key, *_batch_result(words, lettered, sent.value, spans)], names=names)

    words = named(text).cast("string")
    rows = df.select(named(id).cast("bigint").alias("doc_id"), words.alias("text"), F.coalesce(words.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double" + (f", spans {SPANS}" if spans else ""))
