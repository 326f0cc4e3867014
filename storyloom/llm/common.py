"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.plans.store import HOT, discard, materialize, remove, shared_dir, skewed_join

__all__ = ["BATCH_ROWS", "HOT", "SPACES", "discard", "materialize", "partitions", "remove", "shared_dir", "skewed_join", "small_batches", "table", "text_bytes"]

#: Bytes that separate words: space, tab, newline, vertical tab, form feed, return.  bytes.split() uses the same six.
SPACES = r"[\x20\x09-\x0D]+"
#: Rows of an Arrow batch.  Texts run to 100 kB and more, so a batch stays small.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and the text in UTF-8 (null: empty), other columns dropped but for those named."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)
