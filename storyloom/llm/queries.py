"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fingerprints, line_dedup, mixing, near_dedup, quality_classifier, sharding, warc, weak_supervision
from .common import table
from .sql import SQL

__all__ = ["QUERIES", "SQL"]


def vocabulary_path() -> str:
    """Where the public vocabulary file of op3 and the pipeline stands on the driver."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(table(spark, sf_dir, "documents"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 16)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encoded(table(spark, sf_dir, "documents"), vocabulary_path())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.expand(rows.unionByName(more)))


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = weak_supervision.judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_shards, op3_bpe, op4_warc_derivatives, op5_chat, op6_weak_supervision, op7_quality_classifier, op8_near_duplicates, op9_mixing, op10_line_dedup)}
