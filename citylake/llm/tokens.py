"""Token ids of whole texts by the tokenizers library, word by word with a bounded cache.

The tokenizer drops white space and never joins text across it, so the ids of a text are those of its
white-space separated words in turn. Each distinct word is encoded by the library once per worker; a
batch costs one pass over its bytes, one lookup per distinct word, and one gather of ids.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa

from citylake.llm.wordhash import ASCII_SPACE, EXACT, FOLDED, words

CACHE_WORDS = 1_000_000
MARKS = b".,"


class WordEncoder:
    """Ids per word of one tokenizer; ``encode`` gives the ids of a text column.

    The tokenizer must lower-case, drop white space, split letters from marks and end words with
    ``</w>``, as the public ``word_bpe_49k`` does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # Lower-case letters need neither normalising nor splitting.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.whole.get_vocab()
        self.word_end = np.zeros(max(vocab.values()) + 1, bool)
        self.word_end[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.mark_ids = {m: self.whole.encode(chr(m), add_special_tokens=False).ids for m in MARKS}
        self._clear()

    def _clear(self) -> None:
        self.place: dict[int, int] = {}  # word hash -> row of the two arrays below
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, new: list[str]) -> None:
        """Append the ids of words, in their order."""
        low = [w.lower() for w in new]
        # Lower-casing letter by letter: no word with a capital sigma, and none that grows.
        plain = np.array([w.isalpha() and len(w) == len(v) and "Σ" not in v for w, v in zip(low, new)], bool)
        at, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        step = 256
        lines = [" ".join(low[i] for i in at[k : k + step]) for k in range(0, len(at), step)]
        found = [x.ids for x in self.letters.encode_batch_fast(lines, add_special_tokens=False)]
        easy = np.array([i for x in found for i in x], np.uint32)
        stops = np.flatnonzero(self.word_end[easy]) + 1
        if len(stops) != len(at):
            raise ValueError("the tokenizer does not end each word with </w>")
        hard = [x.ids for x in self.whole.encode_batch_fast([new[i] for i in rest], add_special_tokens=False)]
        count = np.zeros(len(new), np.int64)
        count[at] = np.diff(stops, prepend=0)
        count[rest] = [len(x) for x in hard]
        begin = np.zeros(len(new), np.int64)
        begin[at] = np.cumsum(count[at]) - count[at]
        begin[rest] = len(easy) + np.cumsum(count[rest]) - count[rest]
        self.begin = np.concatenate((self.begin, begin + len(self.ids)))
        self.count = np.concatenate((self.count, count))
        self.ids = np.concatenate((self.ids, easy, np.array([i for x in hard for i in x], np.uint32)))

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column's texts, ``end`` after each, and the offsets of the texts in them."""
        found = words(column, ~ASCII_SPACE, FOLDED, MARKS)
        keys = found.hash
        if (found.data == ord("<")).any():  # special tokens are written <|...|> and keep their case
            seen = np.concatenate(([0], np.cumsum(found.data == ord("<"))))
            odd = seen[found.end] > seen[found.start]
            exact = words(column, ~ASCII_SPACE, EXACT, MARKS).hash
            keys = np.where(odd, ~exact, keys)
        number, distinct = pd.factorize(keys)
        if len(self.place) + len(distinct) > CACHE_WORDS:
            self._clear()
        where = np.fromiter(map(self.place.get, distinct.tolist(), _ever(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(where < 0)
        if len(missing):
            first = np.empty(len(distinct), np.int64)
            first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
            at = first[missing]
            raw = found.data.tobytes()
            base = len(self.begin)
            self._learn([raw[s:e].decode() for s, e in zip(found.start[at].tolist(), found.end[at].tolist())])
            where[missing] = np.arange(base, base + len(missing))
            self.place.update(zip(distinct[missing].tolist(), range(base, base + len(missing))))
        return self._spread(where[number], found.tail, found.first, end)

    def _spread(self, row: np.ndarray, tail: np.ndarray, first: np.ndarray, end: int):
        """Ids of the words in ``row``, with their marks, and ``end`` after the words of each text."""
        size = self.count[row]
        extra = np.zeros(256, np.int64)
        for mark, ids in self.mark_ids.items():
            extra[mark] = len(ids)
        full = size + extra[tail]
        before = np.concatenate(([0], np.cumsum(full)))
        offsets = before[first] + np.arange(len(first))
        out = np.full(offsets[-1], end, np.uint32)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        start = before[:-1] + text
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(start, size) + inside] = self.ids[np.repeat(self.begin[row], size) + inside]
        for mark, ids in self.mark_ids.items():
            at = np.flatnonzero(tail == mark)
            for k, i in enumerate(ids):
                out[start[at] + size[at] + k] = i
        return out, offsets


def _ever(value: int):
    while True:
        yield value


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
