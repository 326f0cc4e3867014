"""Sharding by longest-processing-time scheduling through a heap, in two levels.

Groups of equal texts stay together.  Groups are dealt to buckets by hash; within a bucket they are read in order of
size, largest first, and each goes to the least-loaded of the bucket's bins.  The bins of all buckets are then
sorted by size and go to the least-loaded shard in the same way.  Bins are far more than shards, so a bin is small
beside a shard: a group larger than a bin has one to itself, and the second level sees it alone.  A small table has a
bin for each group, which is plain scheduling.  A task holds the heap of one bucket, whatever the table's size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, partitions, skewed_join

BUCKETS = 2048
#: Bins of a bucket for up to 1,024 shards; BUCKETS x BINS rows at most reach the driver.
BINS = 32
#: Parts of a shard within which slots are numbered.
PARTS = 256


def lpt(sizes: list[int], bins: int) -> list[int]:
    """The bin of each size, sizes in descending order; ties of load go to the lowest bin."""
    heap = [(0, b) for b in range(bins)]
    out = []
    for s in sizes:
        load, b = heapq.heappop(heap)
        out.append(b)
        heapq.heappush(heap, (load + s, b))
    return out


def packed(groups: DataFrame, buckets: int, bins: int) -> DataFrame:
    """groups (key, load, members) -> key, load, members, bucket, bin: each bucket read as a stream, largest first."""
    dealt = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    dealt = dealt.repartition(partitions(groups.sparkSession), "bucket").sortWithinPartitions("bucket", F.desc("load"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heap = None, []
        for b in batches:
            out = []
            for bucket, load in zip(b.column("bucket").to_pylist(), b.column("load").to_pylist(), strict=True):
                if bucket != at:
                    at, heap = bucket, [(0, k) for k in range(bins)]
                least, k = heap[0]
                out.append(k)
                heapq.heapreplace(heap, (least + load, k))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("key", "load", "members", "bucket")], pa.array(out, pa.int32())], names=["key", "load", "members", "bucket", "bin"])

    return dealt.select("key", "load", "members", "bucket").mapInArrow(run, "key binary, load bigint, members bigint, bucket int, bin int")


def shards(docs: DataFrame, n_shards: int = 16, buckets: int = BUCKETS, bins: int = BINS, parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, law 'bytes', shard, slot (gapless from 0 in a shard), grown_shard (null).

    size: UTF-8 bytes of the text (null: none) plus 1.  Shard sizes are near equal as far as groups of equal texts
    allow: a group larger than a fair share has a shard to itself.  Null texts are one group with empty texts.
    Repeated rows each get a slot; a null doc_id is kept; other columns are ignored; no rows give no rows.
    buckets x bins should be 64 times the shards or more.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"))
    rows = materialize(rows, "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("load"), F.count("*").alias("members"))
    placed = materialize(packed(groups, buckets, bins), "bins")
    loads = placed.groupBy("bucket", "bin").agg(F.sum("load").alias("load")).collect()
    loads.sort(key=lambda r: (-r["load"], r["bucket"], r["bin"]))
    dealt = [(r["bucket"], r["bin"], s) for r, s in zip(loads, lpt([r["load"] for r in loads], n_shards), strict=True)]
    where = spark.createDataFrame(dealt, "bucket int, bin int, shard int")
    homes = placed.join(F.broadcast(where), ["bucket", "bin"]).select("key", "members", "shard")  # a row for each bin
    homes = materialize(homes, "homes")
    rows = skewed_join(rows, homes, "key", "members").select("doc_id", "size", "text_crc32", "shard")

    # slots: numbered within parts of a shard, parts set off by the counts before them
    rows = materialize(rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int")), "placed")
    discard(placed, homes)
    counts = sorted((r["shard"], r["part"], r["count"]) for r in rows.groupBy("shard", "part").count().collect())
    offsets, at, before = [], None, 0
    for shard, part, n in counts:
        before = 0 if shard != at else before
        at = shard
        offsets.append((shard, part, before))
        before += n
    offsets = spark.createDataFrame(offsets, "shard int, part int, before bigint")
    n = F.expr("row_number() over (partition by shard, part order by doc_id, text_crc32, size)")
    rows = rows.withColumn("n", n).join(F.broadcast(offsets), ["shard", "part"])  # a row for each part of a shard
    slot = (F.col("before") + F.col("n") - 1).cast("bigint").alias("slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot, F.lit(None).cast("int").alias("grown_shard"))
