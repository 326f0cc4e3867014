"""Enrichment rules: statistics, summaries, embedding text, keywords, mentions, heads, sentiment."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StringType, StructField, StructType

from storyloom.functions.pages import unescaped

_EDGE = r"(?U)^\s+|\s+$"
#: Fixed pattern: an end mark, space, then a capital, a Devanagari or an Arabic letter.
SENTENCE = r"(?<=[.!?।])\s+(?=[A-Zऀ-ॿ؀-ۿ])"
#: Characters of an embedding text, of its context, and of a description worth using.
TEXT_CHARS, CONTEXT_CHARS, LEAST_DESCRIPTION = 400, 300, 40
#: Phrases that are no keywords.
NO_KEYWORDS = (
    "read more", "also read", "read also", "related news", "related stories", "subscribe", "newsletter", "sign up", "follow us", "download app", "click here", "tap here", "watch live", "share this", "share on", "tweet",
    "breaking news", "latest news", "top stories", "more stories", "advertisement", "sponsored", "partner content", "paid post", "terms of use", "privacy policy", "all rights reserved", "copyright", "stay updated", "get latest", "find out more",
    "learn more", "read full story", "read full article",
)


def strip(x: Column) -> Column:
    return F.regexp_replace(F.coalesce(x, F.lit("")), _EDGE, "")


def richest(body: Column, description: Column) -> Column:
    return F.coalesce(F.nullif(strip(body), F.lit("")), strip(description))


def summary(body: Column, description: Column, most: int = 500) -> Column:
    """A description of 150 characters or more; else the first three sentences of 30 or more; else the head of what there is; null of nothing."""
    said, text = unescaped(strip(description)), unescaped(strip(body))
    good = F.slice(F.filter(F.transform(F.split(text, SENTENCE), lambda s: strip(s)), lambda s: F.length(s) >= 30), 1, 3)
    out = F.when(F.length(said) >= 150, said).when(text == "", F.nullif(said, F.lit(""))).when(F.size(good) > 0, F.array_join(good, " ")).otherwise(text)
    return F.left(out, F.lit(most))


# ------------------------------------------------------------------ embedding text
def clean(x: Column) -> Column:
    return strip(F.regexp_replace(unescaped(F.regexp_replace(F.coalesce(x, F.lit("")), "<[^>]+>", " ")), r"(?U)\s+", " "))


def cut_words(x: Column, most: int) -> Column:
    """At most so many characters, cut at the last space of the second half if there is one."""
    head = F.left(x, F.lit(most))
    space = most - F.instr(F.reverse(head), " ")  # 0-based place of the last space
    return F.when(F.length(x) <= most, x).when((F.instr(head, " ") > 0) & (space > most // 2), F.left(head, space)).otherwise(head)


def repeats(title: Column, text: Column) -> Column:
    plain = lambda x: strip(F.regexp_replace(F.lower(x), r"(?U)\W+", " "))
    t, d = plain(title), plain(text)
    return (t != "") & (d.startswith(t) | t.startswith(d))


def lead(body: Column, most: int = CONTEXT_CHARS) -> Column:
    """The first whole sentences within `most` characters, or a cut of the body where the first is longer."""
    start = F.struct(F.lit("").alias("s"), F.lit(True).alias("go"))

    def step(acc: Column, sentence: Column) -> Column:
        longer = strip(F.concat(acc["s"], F.lit(" "), sentence))
        fits = acc["go"] & (F.length(longer) <= most)
        return F.struct(F.when(fits, longer).otherwise(acc["s"]).alias("s"), fits.alias("go"))

    out = F.aggregate(F.split(body, r"(?<=[.!?।])\s+"), start, step)["s"]
    return F.when(out == "", cut_words(body, most)).otherwise(out)


def embedding_text(df: DataFrame, out: str, title: Column, description: Column, body: Column) -> DataFrame:
    """df with '<headline>. <description or lead of the body>', cut at words; '' where there is nothing to embed."""
    df = df.withColumn("_t", clean(title)).withColumn("_d", clean(description)).withColumn("_b", clean(body))
    t, d = F.col("_t"), F.col("_d")
    df = df.withColumn("_lead", lead(F.col("_b")))
    own = (F.length(d) >= LEAST_DESCRIPTION) & ~repeats(t, d)
    context = F.when(own, cut_words(d, CONTEXT_CHARS)).when((F.col("_lead") != "") & ~repeats(t, F.col("_lead")), F.col("_lead")).otherwise("")
    df = df.withColumn("_c", context)
    c = F.col("_c")
    whole = F.when((t != "") & (c != ""), F.concat(t, F.when(t.rlike("[.!?।:]$"), "").otherwise("."), F.lit(" "), c)).otherwise(F.coalesce(F.nullif(t, F.lit("")), c))
    return df.withColumn(out, cut_words(whole, TEXT_CHARS)).drop("_t", "_d", "_b", "_lead", "_c")


@F.pandas_udf(ArrayType(FloatType()))
def hashed_embedding(texts: pd.Series) -> pd.Series:
    """Stand-in for an encoder: words hashed to 64 signed places, length one; null of no words."""

    def one(t: str | None) -> list[float] | None:
        v = np.zeros(64)
        for w in re.findall(r"\w+", (t or "").lower()):
            h = hashlib.md5(w.encode()).hexdigest()
            v[int(h[:4], 16) % 64] += 1 if int(h[4], 16) < 8 else -1
        size = np.linalg.norm(v)
        return (v / size).tolist() if size > 0 else None

    return texts.map(one)


# ------------------------------------------------------------------ keywords
def keywords(df: DataFrame, key: str, title: Column, body: Column, description: Column, most: int = 10) -> DataFrame:
    """key, place, keyword: one- and two-word phrases by a count that favours longer ones and the title; phrases of the frame go.

    Stand-in for a statistical extractor: words of three letters or more from the title and the first 3,000 characters
    of the text; score = count x words, twice for phrases of the title; ties by phrase.
    """
    text = F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.left(richest(body, description), F.lit(3000)))
    words = lambda x: F.array_join(F.regexp_extract_all(F.lower(x), F.lit(r"[\p{L}\p{N}]+"), 0), " ")
    rows = df.select(key, words(F.coalesce(title, F.lit(""))).alias("head"), text.alias("text"))
    rows = rows.select(key, "head", F.when(F.length(strip(F.col("text"))) >= 30, words(F.col("text"))).alias("words"))
    # the words of a key meet, not its phrases, which take far more room
    rows = rows.repartition(F.col(key)).sortWithinPartitions(key)
    schema = StructType([df.schema[key], StructField("place", IntegerType()), StructField("keyword", StringType())])
    return rows.mapInArrow(_keywords(most, to_arrow_schema(schema)), schema)


def _phrases(text: str) -> Counter:
    """Words of three letters or more, and two of them in a row, with their counts."""
    words = text.split(" ")
    out = Counter(w for w in words if len(w) >= 3)
    out.update(f"{a} {b}" for a, b in pairwise(words) if len(a) >= 3 and len(b) >= 3)
    return out


def _best(found: dict[str, Counter], most: int) -> list[str]:
    """The best phrases of one key, whose phrases are counted by head."""
    scored = []
    for head, counts in found.items():
        inside = f" {head} "
        scored += [(-n * (2 if " " in k else 1) * (2 if f" {k} " in inside else 1), k) for k, n in counts.items()]
    good = (k for _, k in sorted(scored) if not any(p in k for p in NO_KEYWORDS))
    return list(islice(good, most))


def _keywords(most: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found = None, {}
        for b in batches:
            out = []
            for key, head, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != own:
                    out += [(own, i, k) for i, k in enumerate(_best(found, most), 1)]
                    own, found = key, {}
                if words is not None:
                    found.setdefault(head, Counter()).update(_phrases(words))
            yield _batch(out, schema)
        yield _batch([(own, i, k) for i, k in enumerate(_best(found, most), 1)], schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# ------------------------------------------------------------------ mentions
def mentions(df: DataFrame, key: str, text: Column, gazetteer: DataFrame) -> DataFrame:
    """article_id, position, text, type: runs of capitalised words, typed by a gazetteer (text, type), else by their form.

    Stand-in for a tagger: a run that ends in a company word is an ORG, one of two words or more a PERSON, others are
    no mention unless the gazetteer (a fixed table) knows them.
    """
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*"), 0)
    flat = df.select(F.col(key).alias("article_id"), F.posexplode(runs).alias("position", "text"))
    known = F.broadcast(gazetteer.select(F.lower("text").alias("low"), F.col("type").alias("known")).distinct())
    flat = flat.join(known, F.lower("text") == F.col("low"), "left")
    form = F.when(F.col("text").rlike(r" (?:Ltd|Inc|Corp|Party|Bank|Court)$"), "ORG").when(F.contains("text", F.lit(" ")), "PERSON")
    return flat.withColumn("type", F.coalesce("known", form)).filter("type is not null").select("article_id", "position", "text", "type")


# ------------------------------------------------------------------ sentiment and heads
def sentiment(pos: Column, neutral: Column, neg: Column, least: float = 0.4) -> Column:
    """struct(sentiment, score, positive, neutral, negative): a class must reach `least`, else neutral; percentages to two digits."""
    label = F.when(pos >= least, "positive").when(neg >= least, "negative").otherwise("neutral")
    percent = lambda x: F.round(x * 100, 2)
    return F.struct(label.alias("sentiment"), F.round(pos - neg, 4).alias("score"), percent(pos).alias("positive"), percent(neutral).alias("neutral"), percent(neg).alias("negative"))


class Head:
    """A linear head: labels, W (labels x size), b, thresholds, and the encoder it was made for."""

    def __init__(self, labels: list[str], w: np.ndarray, b: np.ndarray, encoder: str, thresholds: np.ndarray | None = None, most: int = 3):
        self.labels, self.w, self.b, self.encoder, self.most = labels, np.asarray(w, np.float64), np.asarray(b, np.float64), encoder, most
        self.thresholds = np.full(len(labels), 0.5) if thresholds is None else np.asarray(thresholds, np.float64)

    def _run(self, df: DataFrame, key: str, vector: str, schema: str, decide) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v = b.column(vector)
                x = v.flatten().to_numpy().astype(np.float64).reshape(len(v), -1)
                yield decide(b.column(key), x @ self.w.T + self.b)

        return df.select(key, vector).mapInArrow(run, schema)

    def _of(self, encoder: str) -> None:
        if encoder != self.encoder:
            raise ValueError(f"the head was made for {self.encoder}, not {encoder}")

    def category(self, df: DataFrame, key: str, vector: str, encoder: str) -> DataFrame:
        """key, category, confidence: the label of the largest softmax probability, the first of equals."""
        self._of(encoder)

        def decide(ids: pa.Array, scores: np.ndarray) -> pa.RecordBatch:
            e = np.exp(scores - scores.max(axis=1, keepdims=True))  # no overflow, whatever the scores
            p = e / e.sum(axis=1, keepdims=True)
            at = p.argmax(axis=1)
            return pa.RecordBatch.from_arrays([ids, pa.array([self.labels[k] for k in at], pa.string()), pa.array(p[np.arange(len(at)), at])], names=[key, "category", "confidence"])

        return self._run(df, key, vector, f"{key} bigint, category string, confidence double", decide)

    def tags(self, df: DataFrame, key: str, vector: str, encoder: str) -> DataFrame:
        """key, place, tag, p: tags whose sigmoid reaches their own threshold, best first, at most `most`."""
        self._of(encoder)

        def decide(ids: pa.Array, scores: np.ndarray) -> pa.RecordBatch:
            p = 1 / (1 + np.exp(-scores))
            order = np.argsort(-p, axis=1, kind="stable")
            good = np.take_along_axis(p >= self.thresholds, order, 1)
            place = np.cumsum(good, axis=1)
            row, col = np.nonzero(good & (place <= self.most))
            tag = order[row, col]
            return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(place[row, col].astype(np.int32)), pa.array([self.labels[k] for k in tag], pa.string()), pa.array(p[row, tag])], names=[key, "place", "tag", "p"])

        return self._run(df, key, vector, f"{key} bigint, place int, tag string, p double", decide)
