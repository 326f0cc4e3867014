"""BPE encoding by forced boundaries, and decoding.

Two neighbouring bytes that stand together inside no vocabulary token can never be merged across, so they mark a
certain cut.  The fragments between cuts are encoded by themselves and their ids concatenated.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from struct import pack

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

_KEPT = 300_000


def byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A word-level BPE vocabulary file: NFC and lower case, a split pattern, byte symbols, a mark on word ends.

    spec: the parsed JSON of a tokenizers file of that kind.  encode() gives what the tokenizers library does
    without adding special tokens; special tokens that stand in a text are recognised, as there by default.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(splits[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        shown = byte_names()
        self.shown = shown
        bytes_of = {c: b for b, c in enumerate(shown)}
        self.inside = set()  # pairs of neighbouring bytes that some token holds
        for token in self.vocab:
            raw = [bytes_of[c] for c in (token.removesuffix(self.end) if self.end else token) if c in bytes_of]
            self.inside.update(zip(raw, raw[1:]))
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def fragments(self, word: bytes) -> list[bytes]:
        """The pieces of a word between certain cuts."""
        cuts = [i for i in range(1, len(word)) if (word[i - 1], word[i]) not in self.inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    def merge(self, symbols: list[str]) -> list[str]:
        """Apply the merges in order of rank, leftmost first: a heap over a linked list."""
        n, ranks = len(symbols), self.ranks
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if not alive[i] or symbols[i] != a or (j := after[i]) < 0 or symbols[j] != b:
                continue
            symbols[i], alive[j] = a + b, False
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return [s for s, live in zip(symbols, alive, strict=True) if live]

    def word_tokens(self, word: str) -> list[str]:
        out = []
        pieces = self.fragments(word.encode())
        for k, piece in enumerate(pieces):
            symbols = [self.shown[b] for b in piece]
            if k == len(pieces) - 1:
                symbols[-1] += self.end
            out += self.merge(symbols)
        return out

    def _word(self, word: str) -> tuple[bytes, bytes]:
        tokens = self.word_tokens(word)
        ids = [self.vocab[t] for t in tokens if t in self.vocab]
        made = pack(f"<{len(ids)}I", *ids), " ".join(self.names[i] for i in ids).encode()
        if len(self.known) >= _KEPT:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = made
        return made

    def normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # letter by letter: no final sigma

    def encode_both(self, text: str) -> tuple[bytes, bytes]:
        """Ids as little-endian 32-bit integers, and the decoded text."""
        ids, shown, known = [], [], self.known
        for k, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if k % 2:
                i = self.special[part]
                ids.append(pack("<I", i))
                shown.append(self.names[i].encode())
                continue
            made = [known.get(w) or self._word(w) for w in self.words.findall(self.normal(part))]
            ids += [a for a, _ in made]
            shown += [b for _, b in made if b]
        return b"".join(ids), b" ".join(shown)

    def encode(self, text: str) -> list[int]:
        raw = self.encode_both(text)[0]
        return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces: such a file has no decoder, so word ends stay marked.  Unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian 32-bit), decoded, of every whole text (null: empty, no tokens).

    vocabulary: path of the vocabulary file on the driver, sent to the executors in a broadcast of that file's
    size.  Repeated rows and null doc_ids are kept; other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(load_spec(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(spec.value)
        for b in batches:
            made = [bpe.encode_both(t) for t in b.column("text").to_pylist()]
            n = pa.array([len(x) // 4 for x, _ in made], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), n, pa.array([x for x, _ in made], pa.binary()), pa.array([y.decode() for _, y in made], pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    small_batches(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded string")
