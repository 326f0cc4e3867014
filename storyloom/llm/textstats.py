"""Statistics of whole texts, one pass each, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import small_batches, text_bytes

SYMBOLS = b"#*$%&|<>"
#: Whole counts of a text; see `TextCounter`.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_bytes", "n_distinct", "n_upper", "n_digits", "n_stops", "n_short")
_STOPS, _UPPER, _DIGITS = b".!?", bytes(range(65, 91)), bytes(range(48, 58))
_WORDS_KEPT = 400_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class TextCounter:
    """UTF-8 bytes -> COUNTS.  Words are split at the six ASCII spaces; chars are code points."""

    def __init__(self, window: int = 5):
        self.window, self.known = window, {}

    def __call__(self, text: bytes) -> tuple[int, ...]:
        words = text.split()
        joined = b"".join(words)
        less = lambda what: len(joined) - len(joined.translate(None, what))
        lines = text.split(b"\n")
        worded = [x for x in lines if x.strip()]
        distinct = set(words)
        return (
            len(words),
            len(joined.decode()),
            less(SYMBOLS),
            len(worded) - len(set(worded)),
            self._repeated(words, distinct),
            len(lines),
            len(text.decode()),
            len(text),
            len(distinct),
            less(_UPPER),
            less(_DIGITS),
            less(_STOPS),
            sum(map((3).__ge__, map(len, words))),
        )

    def _repeated(self, words: list[bytes], distinct: set[bytes]) -> int:
        """Words in windows that occur twice or more in the text, the first occurrence included."""
        n, width, known = len(words), self.window, self.known
        if n <= width:
            return 0
        if len(known) > _WORDS_KEPT:
            known.clear()
        for w in distinct.difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        key = np.zeros(n - width + 1, np.uint64)
        for i in range(width):
            key = (key ^ h[i : n - width + 1 + i]) * _A
            key ^= key >> np.uint64(29)
            key *= _B
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        if not same.any():
            return 0
        twice = np.zeros(len(key) + 1, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(n + 1, np.int64)
        starts = np.flatnonzero(twice)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + width, -1)
        return int((np.cumsum(edge)[:n] > 0).sum())


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS (bigint) of every whole text; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = TextCounter()
        for b in batches:
            rows = [count(t) for t in b.column("text").to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(COUNTS))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=["doc_id", *COUNTS])

    small_batches(docs.sparkSession)
    return text_bytes(docs).mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))
