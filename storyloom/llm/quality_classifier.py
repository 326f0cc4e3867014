"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are flattened into arrays; scoring walks all rows of a batch through all trees at once in numpy.  The fit
takes at most MAX_TRAIN labelled rows, those of least hash of doc_id; everything else covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .textstats import COUNTS, text_counts

MAX_TRAIN = 40_000
FEATURES = 14


def features(counts: np.ndarray) -> np.ndarray:
    """(rows, COUNTS) -> (rows, FEATURES): shares and means, so no document's identity is among them."""
    c = {name: counts[:, i].astype(np.float64) for i, name in enumerate(COUNTS)}
    words, lines, chars = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1), np.maximum(c["word_chars"], 1)
    return np.stack([
        np.log1p(c["n_words"]), np.log1p(c["n_lines"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_words"] / lines, c["n_distinct"] / words, c["n_upper"] / chars, c["n_digits"] / chars, c["n_stops"] / words, c["n_short"] / words,
        c["n_bytes"] / np.maximum(c["n_chars"], 1),
    ], axis=1)


@dataclass
class Trees:
    """All nodes of all trees in one set of arrays; a leaf points at itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.1, bins: int = 64, least: int = 20, ridge: float = 1.0) -> Trees:
    """Logistic boosting; splits are sought over histograms of quantile bins.  No rows, or one class: the base rate."""
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        raw = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, p * (1 - p)
            roots.append(len(nodes))
            _grow(nodes, np.arange(len(y)), binned, edges, g, h, raw, depth, rate, bins, least, ridge)
    if not roots:
        roots, nodes = [0], [[0, 0.0, 0, 0, 0.0]]
    f, t, le, r, v = zip(*nodes, strict=True)
    return Trees(base, np.array(roots), np.array(f), np.array(t, float), np.array(le), np.array(r), np.array(v, float), depth)


def _grow(nodes: list, rows: np.ndarray, binned: np.ndarray, edges: list, g: np.ndarray, h: np.ndarray, raw: np.ndarray, depth: int, rate: float, bins: int, least: int, ridge: float) -> int:
    me, sg, sh = len(nodes), g[rows].sum(), h[rows].sum()
    nodes.append([0, 0.0, me, me, 0.0])
    best, split = 1e-6, None
    if depth and len(rows) >= 2 * least:
        for j, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, j]
            n = np.cumsum(np.bincount(b, minlength=bins))[: len(e)]
            lg, lh = (np.cumsum(np.bincount(b, weights=w[rows], minlength=bins))[: len(e)] for w in (g, h))
            gain = lg**2 / (lh + ridge) + (sg - lg) ** 2 / (sh - lh + ridge) - sg**2 / (sh + ridge)
            gain[(n < least) | (len(rows) - n < least)] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, split = gain[k], (j, k)
    if split is None:
        nodes[me][4] = float(rate * sg / (sh + ridge))
        raw[rows] += nodes[me][4]
        return me
    j, k = split
    low = binned[rows, j] <= k
    nodes[me][:2] = [j, float(edges[j][k])]
    nodes[me][2] = _grow(nodes, rows[low], binned, edges, g, h, raw, depth - 1, rate, bins, least, ridge)
    nodes[me][3] = _grow(nodes, rows[~low], binned, edges, g, h, raw, depth - 1, rate, bins, least, ridge)
    return me


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text divisible by 5 (a null id is none)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold) of every whole text.

    labels: doc_id, quality 0/1; rows without either are ignored, and several labels of one doc_id all count.  Null
    texts count as empty and get a score too.  Without labels, or with one class only, all scores are the base rate.
    Repeated rows score alike; other columns are ignored; no rows give no rows.
    """
    counted = materialize(text_counts(docs), "counts")
    known = labels.filter("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("y")).filter(~held_out(F.col("doc_id")))
    sample = known.join(counted, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_train).select("y", *COUNTS).toPandas()
    trees = fit(features(sample[list(COUNTS)].to_numpy(np.int64)), sample["y"].to_numpy(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in COUNTS], axis=1) if b.num_rows else np.empty((0, len(COUNTS)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(trees.score(features(x)))], names=["doc_id", "score"])

    out = counted.mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
