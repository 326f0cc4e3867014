"""Entity salience, evidence filters and tag decisions over mention tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Names that occur with almost any story, or sign it, and so are no evidence.
STOP = (
    "india", "indian", "indians", "bharat", "new delhi", "delhi", "centre", "government", "govt", "the government", "union government", "pti", "ani", "ians", "reuters", "afp", "ap", "uni", "bloomberg", "x", "twitter", "facebook",
    "instagram", "youtube", "whatsapp", "today", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "भारत", "दिल्ली", "सरकार", "केंद्र",
)
EVIDENCE_TYPES = ("PERSON", "ORG", "GPE", "EVENT", "LAW", "PRODUCT")


def salience(entity: Column, title: Column, body: Column, mentions: Column) -> Column:
    """Half for the title, 0.3 for the first 200 characters, a tenth per mention up to 0.3; at most 1."""
    e = F.lower(entity)
    score = F.when(F.contains(F.lower(title), e), 0.5).otherwise(0.0) + F.when(F.contains(F.lower(F.left(body, F.lit(200))), e), 0.3).otherwise(0.0)
    return F.least(F.round(score + F.least(mentions * 0.1, F.lit(0.3)), 2), F.lit(1.0))


def entities(mentions: DataFrame, articles: DataFrame, least: float = 0.1, most: int = 30) -> DataFrame:
    """mentions: article_id, position, text, type -> article_id, entity_text, entity_type, salience, at (first position), k (rank): the best `most`.

    First spelling and type count; texts under two characters and places written all in lower case go.
    """
    m = mentions.withColumn("text", F.trim("text")).filter((F.length("text") >= 2) & ~((F.col("type") == "GPE") & (F.col("text") == F.lower("text"))))
    once = m.groupBy("article_id", F.lower("text").alias("key")).agg(F.count("*").alias("n"), F.min_by(F.struct("text", "type"), "position").alias("first"), F.min("position").alias("at"))
    scored = once.join(articles.select("article_id", "title", "body"), "article_id").withColumn("salience", salience(F.col("first.text"), F.col("title"), F.col("body"), F.col("n")))
    ranked = scored.filter(F.col("salience") >= least).withColumn("k", F.row_number().over(W.partitionBy("article_id").orderBy(F.desc("salience"), "at")))
    return ranked.filter(F.col("k") <= most).select("article_id", F.col("first.text").alias("entity_text"), F.col("first.type").alias("entity_type"), "salience", "at", "k")


def evidence(found: DataFrame, stop: list[str], least: float = 0.3, most: int = 15) -> DataFrame:
    """Entity keys that count as evidence for one story: salient, of the listed types, not on the stop list."""
    key = F.lower(F.regexp_replace(F.trim("entity_text"), r"\s+", " "))
    rows = found.filter((F.col("salience") >= least) & F.col("entity_type").isin(*EVIDENCE_TYPES)).withColumn("key", key).filter((F.length("key") >= 2) & ~F.col("key").isin(*stop))
    once = rows.groupBy("article_id", "key").agg(F.max("salience").alias("salience"), F.min("k").alias("order"))
    ranked = once.withColumn("k", F.row_number().over(W.partitionBy("article_id").orderBy(F.desc("salience"), "order"))).filter(F.col("k") <= most)
    return ranked.groupBy("article_id").agg(F.sort_array(F.collect_list(F.struct("k", "key"))).getField("key").alias("keys"))


def pick_category(scores: Column, least: float = 0.30, cricket: float = 0.5) -> Column:
    """Best label of a map, first of equals; weak ones are general, and sports may be cricket."""
    pairs = F.map_entries(scores)
    best = F.array_max(F.transform(pairs, lambda x, i: F.struct(x["value"].alias("v"), (-i).alias("i"), x["key"].alias("k"))))
    sub = F.coalesce(F.try_element_at(scores, F.lit("cricket")), F.lit(0.0)) >= cricket
    return F.when(F.size(pairs) == 0, "general").when(best["v"] < least, "general").when((best["k"] == "sports") & sub, "cricket").otherwise(best["k"])


def pick_tags(scores: Column, least: float = 0.35, most: int = 5) -> Column:
    """Labels of a map at or above the threshold, best first."""
    good = F.filter(F.map_entries(scores), lambda x: x["value"] >= least)
    ordered = F.array_sort(F.transform(good, lambda x: F.struct((-x["value"]).alias("v"), x["key"].alias("k"))))
    return F.transform(F.slice(ordered, 1, most), lambda x: x["k"])
