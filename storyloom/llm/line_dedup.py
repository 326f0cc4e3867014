"""Line dedup over levelled sorted runs of line hashes.

A run holds (key, docs, last) sorted by key: a line hash, the documents it was found in, the largest doc_id.
Batches come in descending order of doc_id.  Each batch merge-anti-joins the runs: keys that no run has are new
and enter with their keeper (no later batch can hold a larger doc_id); known keys only add to their counts.  Every
FANOUT runs of one level are compacted into one run of the next level.  Runs are partitions of one table bucketed and
sorted by key, so a batch is shuffled once and meets every run where it lies, and runs are merged where they lie.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, remove, shared_dir, skewed_join, small_batches, text_bytes

BATCHES = 4
FANOUT = 3
#: Stands for a missing doc_id: below all others.
_NO_ID = -(1 << 63)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line stripped of ASCII space and with A-Z lowered; None below min_chars code points."""
    key = line.strip().lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


class LineRuns:
    """The levels of sorted runs, each a number of its own; all data stay in files of the shared folder."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout, self.levels, self.buckets, self.made = fanout, [], None, 0
        self.name = f"line_runs_{uuid.uuid4().hex}"

    def runs(self) -> list[int]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """batch: (doc_id, key), each key once for a document; doc_ids below those of earlier batches."""
        own = batch.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        if runs := self.runs():
            own = own.repartition(self.buckets, "key")
            for run in runs:
                known = self._read([run]).select("key", F.lit(True).alias("known")).hint("merge")
                own = own.join(known, "key", "left").select("key", "docs", F.when(F.col("known").isNull(), F.col("last")).alias("last"))
        self._put(own, 0)

    def _read(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("run").isin(runs))

    def _merged(self, runs: list[int]) -> DataFrame:
        """Where the runs lie: one scan reads a bucket of all of them, where Spark 4.1 takes a union of bucketed scans for merged and adds up nothing."""
        return self._read(runs).groupBy("key").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def _put(self, run: DataFrame, level: int) -> None:
        if self.buckets is None:
            self.spark = run.sparkSession
            self.buckets, self.path = partitions(self.spark), f"{shared_dir(self.spark)}/{self.name}"
        run = run.repartition(self.buckets, "key").withColumn("run", F.lit(self.made))
        run.write.mode("append").partitionBy("run").bucketBy(self.buckets, "key").sortBy("key").option("path", self.path).format("parquet").saveAsTable(self.name)
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(self.made)
        self.made += 1
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._put(self._merged(merged), level + 1)
            for old in merged:
                remove(self.spark, f"{self.path}/run={old}")
            self.spark.catalog.refreshTable(self.name)

    def frequent(self, min_docs: int) -> DataFrame:
        """(key, docs, last) of the keys found in at least min_docs documents."""
        return self._merged(self.runs()).filter(F.col("docs") >= min_docs)

    def close(self) -> None:
        if self.buckets is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            remove(self.spark, self.path)
        self.levels, self.buckets = [], None


def document_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, key) for each document and each of its distinct long keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = {line_key(x, min_chars) for x in t.split(b"\n")}
                found.discard(None)
                keys += found
                ids += [i] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])

    small_batches(docs.sparkSession)
    return text_bytes(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_ID))).mapInArrow(run, "doc_id bigint, key binary")


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = BATCHES, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_lines (before), n_dropped, text and the string columns in carry: every whole text without repeated lines.

    A line whose key (stripped, A-Z lowered) has min_chars code points or more and is found in min_docs documents
    or more stays only in the largest doc_id that holds it, there with all its repeats.  Null texts count as one
    empty line and come back empty.  Rows of one doc_id are one document, each with its own text; rows that tie on the
    largest doc_id all keep the line.
    A null doc_id ranks below all others.  Other columns are ignored; no rows give no rows.
    """
    lines = materialize(document_lines(docs, min_chars), "lines")
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        lines = materialize(lines.distinct(), "lines")
    cuts = lines.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    runs, upper = LineRuns(), None
    for low in [*sorted(set(cuts), reverse=True), None]:
        part = lines
        if low is not None:
            part = part.filter(F.col("doc_id") > low)
        if upper is not None:
            part = part.filter(F.col("doc_id") <= upper)
        runs.add(part)
        upper = low
    frequent = materialize(runs.frequent(min_docs), "frequent")
    runs.close()
    drops = skewed_join(lines, frequent, "key", "docs").filter(F.col("doc_id") < F.col("last"))
    drops = drops.groupBy("doc_id").agg(F.collect_set("key").alias("drops"))
    whole = text_bytes(docs, *carry).withColumn("at", F.coalesce("doc_id", F.lit(_NO_ID)))
    rows = whole.join(drops.withColumnRenamed("doc_id", "at"), "at", "left").select("doc_id", "text", "drops", *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, dropped, texts = [], [], []
            for t, gone in zip(b.column("text").to_pylist(), b.column("drops").to_pylist(), strict=True):
                n.append(t.count(b"\n") + 1)
                if gone:
                    gone = set(gone)
                    kept = [x for x in t.split(b"\n") if line_key(x, min_chars) not in gone]
                    dropped.append(n[-1] - len(kept))
                    t = b"\n".join(kept)
                else:
                    dropped.append(0)
                texts.append(t.decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string()), *[b.column(c) for c in carry]], names=["doc_id", "n_lines", "n_dropped", "text", *carry])

    return rows.mapInArrow(run, "doc_id bigint, n_lines bigint, n_dropped bigint, text string" + "".join(f", {c} string" for c in carry))
