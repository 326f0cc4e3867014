"""The training-data pipeline over `documents`: quality, line dedup, near dedup, mixing, tokens.

run() writes each stage's rows to the shared folder and reads them back for the next, as the stages are meant to
be used.  Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import bpe, line_dedup, mixing, near_dedup, quality_classifier
from storyloom.llm.common import materialize, table
from storyloom.llm.queries import vocabulary_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; rows without doc_id have no verdict and stay."""
    verdicts = quality_classifier.scored(docs, table(spark, sf_dir, "labels"))
    rejected = verdicts.filter("predicted = 0").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; documents that lose all their text go with them; n_chars follows the text."""
    kept = line_dedup.line_dedup(docs, carry=("lang", "source"))
    kept = kept.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (shingles of five words, similarity 0.8 or more)."""
    gone = near_dedup.near_duplicates(docs, width=5, percent=80).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by calibrated probabilities; this is the sampling stage, so clean documents go too.

    Marginals may miss by half a point, so that a value which the stages before have nearly emptied does not shrink the draw.
    """
    drawn = mixing.mixed(docs, slack=0.005).filter("drawn").select("doc_id").distinct()
    return docs.join(drawn, "doc_id", "left_semi").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, and digests of ids and decoded text."""
    out = bpe.encoded(docs, vocabulary_path())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("near_dedup", near), ("mixing", mix), ("bpe", tokens)]

#: Training trees and BPE merges are beyond SQL: tests/llm hold each stage against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
