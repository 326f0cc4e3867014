"""Queries of the clustering operators: over the embeddings with SQL, and over hand-made streams with their expected rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storyloom.functions import arrays as A
from storyloom.functions import urls as U
from storyloom.functions import vectors as V
from storyloom.operators import clustering as C
from storyloom.plans.registry import query

#: The test vectors have no story structure, so thresholds are low; half precision is off so that SQL can check.
LOW = C.Rules(join=0.3, gray=0.3, anchor=0.1, merge=0.02, size=64, half=False)
NOW = 10_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ stories made of the embeddings
_MEMBERS = """
m AS (SELECT e.vec_id, e.vec_id // 400 * 97 + e.vec_id % 97 AS cluster_id, 'm' || CAST(e.vec_id % 97 % 2 AS VARCHAR) AS model, e.vec_id * 900 AS t, e.embedding, d.source, d.lang, split_part(d.text, chr(10), 1) AS title
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id)"""
_STORIES = f"""{_MEMBERS},
p AS (SELECT cluster_id, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM m),
v AS (SELECT cluster_id, list(x ORDER BY pos) AS sum FROM (SELECT cluster_id, pos, sum(x) AS x FROM p GROUP BY 1, 2) y GROUP BY 1),
s AS (SELECT m.cluster_id, m.model, v.sum, count(*) AS n, min(t) AS first, max(t) AS last, min(vec_id) AS seed_id, CAST(min_by(embedding, vec_id) AS DOUBLE[]) AS anchor,
  list_sort(list(DISTINCT coalesce(nullif(lower(trim(source)), ''), '(unknown)'))) AS outlets, CASE WHEN m.cluster_id % 19 = 18 THEN 'merged' ELSE 'active' END AS status
  FROM m JOIN v ON v.cluster_id = m.cluster_id GROUP BY m.cluster_id, m.model, v.sum)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a vector: model, article_id, cluster_id, t, vector, domain, language, title."""
    e = read(spark, sf_dir, "embeddings")
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source", "lang", F.substring_index("text", "\n", 1).alias("title"))
    home = F.expr("vec_id div 400 * 97 + vec_id % 97")
    return e.join(d, "vec_id", "left").select(
        F.concat(F.lit("m"), F.expr("vec_id % 97 % 2").cast("string")).alias("model"), F.col("vec_id").alias("article_id"), home.alias("cluster_id"), (F.col("vec_id") * 900).alias("t"),
        F.col("embedding").alias("vector"), F.col("source").alias("domain"), F.col("lang").alias("language"), "title",
    )


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories (STORY) of those articles: every 97th one of a run of 400 belongs to one story."""
    m = members(spark, sf_dir)
    sums = V.vector_sum(m, ["cluster_id"], "vector").drop("n")
    facts = m.groupBy("model", "cluster_id").agg(
        F.count("*").alias("n"), F.min("t").alias("first"), F.max("t").alias("last"), F.min("article_id").alias("seed_id"), F.min_by("vector", "article_id").cast("array<double>").alias("anchor"),
        F.sort_array(F.collect_set(A.norm_domain(F.col("domain")))).alias("outlets"), F.sort_array(F.collect_set("language")).alias("languages"), F.min_by("title", "article_id").alias("headline"),
    )
    none = F.array().cast("array<string>")
    return facts.join(sums, "cluster_id").select(
        "model", "cluster_id", "sum", V.unit(F.col("sum")).alias("centroid"), "anchor", F.col("anchor").alias("representative"), "n", "first", "last", "seed_id", F.col("seed_id").alias("rep_id"), "headline", "outlets", "languages",
        none.alias("entity_set"), F.array().cast("array<struct<text:string,type:string,count:bigint>>").alias("top_entities"), F.array().cast("array<struct<h:bigint,d:string>>").alias("image_hashes"), F.lit(0).cast("bigint").alias("gray_joins"),
        F.when(F.col("cluster_id") % 19 == 18, "merged").otherwise("active").alias("status"), F.when(F.col("cluster_id") % 19 == 18, F.col("cluster_id") - 1).alias("merged_into"),
    )


_COS = "list_inner_product({a}, {b}) / (sqrt(list_inner_product({a}, {a})) * sqrt(list_inner_product({b}, {b})))"


def _fits(art: str = "t") -> str:
    return f"s.last >= {art} - 64800 AND s.first <= {art} + 64800 AND greatest(s.last, {art}) - least(s.first, {art}) <= 432000"


@query("f6_time_compatible", f"WITH {_STORIES} SELECT m.vec_id AS article, s.cluster_id AS cluster FROM m JOIN s ON s.model = m.model AND s.status = 'active' AND {_fits('m.t')}")
def f6_time_compatible(spark, sf_dir):
    """Range join: articles and stories meet in time buckets of one span, then the exact predicate decides."""
    at = lambda c: F.floor(F.col(c) / C.Rules.span)
    s = C.active(stories(spark, sf_dir)).select("model", "cluster_id", "first", "last", F.explode(F.array(at("first") - 1, at("first"), at("first") + 1)).alias("bucket"))
    m = members(spark, sf_dir).select("model", "article_id", "t", at("t").alias("bucket"))
    fits = F.expr("last >= t - 64800 AND first <= t + 64800 AND greatest(last, t) - least(first, t) <= 432000")
    return m.join(s, ["model", "bucket"]).filter(fits).select(F.col("article_id").alias("article"), F.col("cluster_id").alias("cluster"))


def reachable(articles: DataFrame, found: DataFrame, rules: C.Rules, most: int) -> DataFrame:
    """article, cluster, near, link, anchor_sim: the `most` nearest stories by centroid that time allows, for every article."""
    a = articles.filter(V.valid(F.col("vector"), rules.size)).select("model", F.col("article_id").alias("id"), F.col("t").alias("at"), "vector")
    s = C.active(found).select("model", F.col("cluster_id").alias("id"), F.col("first").alias("at"), "first", "last", "n", "sum", "centroid", "anchor")

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        y = y.sort_values("id")
        t, first, last = x["at"].to_numpy()[:, None], y["first"].to_numpy()[None, :], y["last"].to_numpy()[None, :]
        fits = (last >= t - rules.gap) & (first <= t + rules.gap) & (np.maximum(last, t) - np.minimum(first, t) <= rules.span)
        key = C.matrix(x, "vector", rules.half)
        near = np.where(fits, np.round(key @ C.matrix(y, "centroid", rules.half).T, 9), -np.inf)
        hold = key @ C.matrix(y, "anchor", rules.half).T
        link = C.matrix(x, "vector") @ np.stack(y["sum"].to_numpy()).T / y["n"].to_numpy()
        best = np.argsort(-near, axis=1, kind="stable")[:, :most]
        row, col = np.repeat(np.arange(len(x)), best.shape[1]), best.ravel()
        keep = near[row, col] > -np.inf
        row, col = row[keep], col[keep]
        return pd.DataFrame({"article": x["id"].to_numpy()[row], "cluster": y["id"].to_numpy()[col], "near": near[row, col], "link": link[row, col], "anchor_sim": hold[row, col]})

    rows = C.blockwise(a, s, rules.span, run, "article bigint, cluster bigint, near double, link double, anchor_sim double")
    place = F.row_number().over(W.partitionBy("article").orderBy(F.desc("near"), "cluster"))
    return rows.withColumn("place", place).filter(F.col("place") <= most)


_NEAR = f"""d AS (SELECT m.vec_id AS article, s.cluster_id AS cluster, round({_COS.format(a="CAST(m.embedding AS DOUBLE[])", b="s.sum")}, 9) AS near,
  {_COS.format(a="CAST(m.embedding AS DOUBLE[])", b="s.anchor")} AS anchor_sim, list_inner_product(CAST(m.embedding AS DOUBLE[]), s.sum) / sqrt(list_inner_product(CAST(m.embedding AS DOUBLE[]), CAST(m.embedding AS DOUBLE[]))) / s.n AS link
  FROM m JOIN s ON s.model = m.model AND s.status = 'active' AND {_fits('m.t')}),
k AS (SELECT *, row_number() OVER (PARTITION BY article ORDER BY near DESC, cluster) AS place FROM d)"""


@query("j3_nearest_cluster", f"WITH {_STORIES}, {_NEAR} SELECT article, cluster, round(near, 6) AS similarity FROM k WHERE place = 1 AND near >= 0.2")
def j3_nearest_cluster(spark, sf_dir):
    """The nearest story of every article by centroid cosine within the window, where it is near enough."""
    out = reachable(members(spark, sf_dir), stories(spark, sf_dir), LOW, 1).filter("near >= 0.2")
    return out.select("article", "cluster", F.round("near", 6).alias("similarity"))


@query("j5_window_top_clusters", f"""WITH {_STORIES}, {_NEAR}, r AS (SELECT article, cluster, link, anchor_sim, row_number() OVER (PARTITION BY article ORDER BY round(link, 9) DESC, cluster) AS rank FROM k WHERE place <= 5)
SELECT article, cluster, CAST(rank AS INTEGER) AS rank, round(link, 6) AS link, anchor_sim >= 0.1 AS anchor_ok FROM r""")  # fmt: skip
def j5_window_top_clusters(spark, sf_dir):
    """Five nearest stories by centroid in the window, ranked again by average link; whether the anchor agrees."""
    rows = reachable(members(spark, sf_dir), stories(spark, sf_dir), LOW, LOW.candidates)
    rank = F.row_number().over(W.partitionBy("article").orderBy(F.desc(F.round("link", 9)), "cluster"))
    return rows.select("article", "cluster", rank.alias("rank"), F.round("link", 6).alias("link"), (F.col("anchor_sim") >= LOW.anchor).alias("anchor_ok"))


@query("j4_duplicate_pairs", f"""WITH {_STORIES}, d AS (SELECT a.cluster_id AS a, b.cluster_id AS b, round({_COS.format(a="a.sum", b="b.sum")}, 9) AS near FROM s a JOIN s b ON a.model = b.model AND a.cluster_id < b.cluster_id WHERE a.status = 'active' AND b.status = 'active'),
k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY near DESC, b) AS place FROM d) SELECT a, b, round(near, 6) AS similarity FROM k WHERE place = 1 AND near >= 0.25""")  # fmt: skip
def j4_duplicate_pairs(spark, sf_dir):
    """Of each active story the nearest one with a larger id, by blocks of matrix products within a model."""
    s = C.active(stories(spark, sf_dir)).select("model", F.col("cluster_id").alias("id"), F.lit(0).alias("at"), "centroid")

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        y = y.sort_values("id")
        near = np.round(C.matrix(x, "centroid") @ C.matrix(y, "centroid").T, 9)
        near = np.where(x["id"].to_numpy()[:, None] < y["id"].to_numpy()[None, :], near, -np.inf)
        at = near.argmax(axis=1)
        return pd.DataFrame({"a": x["id"].to_numpy(), "b": y["id"].to_numpy()[at], "near": near[np.arange(len(x)), at]}).query("near > -inf")

    rows = C.blockwise(s, s, 1, run, "a bigint, b bigint, near double")
    best = rows.groupBy("a").agg(F.max_by(F.struct("b", "near"), F.struct("near", -F.col("b"))).alias("x")).filter("x.near >= 0.25")
    return best.select("a", "x.b", F.round("x.near", 6).alias("similarity"))


_CANDIDATES = f"""
c AS (SELECT a.cluster_id AS probe, a.n AS probe_n, s.cluster_id AS other, s.n AS other_n, round({_COS.format(a="a.sum", b="s.sum")}, 9) AS near, list_inner_product(a.sum, s.sum) / (a.n * s.n) AS similarity
  FROM s a JOIN s ON s.model = a.model AND s.cluster_id <> a.cluster_id AND s.status = 'active' AND s.last >= a.first - 64800 AND s.first <= a.last + 64800 AND greatest(s.last, a.last) - least(s.first, a.first) <= 432000
  WHERE a.status = 'active' AND {_COS.format(a="a.anchor", b="s.anchor")} >= 0.1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY near DESC, other) AS place FROM c) x WHERE place = 1 AND similarity >= 0.02)"""


@query("j6_merge_candidates", f"WITH {_STORIES}, {_CANDIDATES} SELECT s.cluster_id AS probe, b.other, round(b.similarity, 6) AS similarity FROM s LEFT JOIN b ON b.probe = s.cluster_id WHERE s.status = 'active'")
def j6_merge_candidates(spark, sf_dir):
    return C.merge_candidates(stories(spark, sf_dir), LOW).select("probe", "other", F.round("similarity", 6).alias("similarity"))


@query("c6_plan_merges", f"""WITH RECURSIVE {_STORIES}, {_CANDIDATES},
q AS (SELECT least(probe, other) AS lo, greatest(probe, other) AS hi, max(similarity) AS similarity, max(CASE WHEN probe < other THEN probe_n ELSE other_n END) AS lo_n, max(CASE WHEN probe < other THEN other_n ELSE probe_n END) AS hi_n FROM b GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, lo, hi) AS k FROM q),
f AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS used, false AS took UNION ALL
  SELECT o.k, CASE WHEN list_contains(used, lo) OR list_contains(used, hi) THEN used ELSE list_concat(used, [lo, hi]) END, NOT (list_contains(used, lo) OR list_contains(used, hi)) FROM f JOIN o ON o.k = f.k + 1)
SELECT CASE WHEN lo_n >= hi_n THEN lo ELSE hi END AS winner, CASE WHEN lo_n >= hi_n THEN hi ELSE lo END AS loser, round(similarity, 6) AS similarity FROM f JOIN o ON o.k = f.k WHERE took""")  # fmt: skip
def c6_plan_merges(spark, sf_dir):
    plan = C.plan_merges(C.merge_candidates(stories(spark, sf_dir), LOW), LOW.merge)
    return plan.select("winner", "loser", F.round("similarity", 6).alias("similarity"))


@query("c1_assign_clusters")
def c1_assign_clusters(spark, sf_dir):
    """Every article assigned, parts of the anchor graph folded one by one; tests hold it against one serial fold."""
    rules = C.Rules(join=0.3, gray=0.3, anchor=0.15, size=64)
    decisions, _ = C.assign(members(spark, sf_dir), rules)
    return decisions.select("model", "article_id", "cluster_id", "action", F.round("similarity", 5).alias("similarity"), "article_count", "outlet_count")


@query("c2_separate_models", """SELECT vec_id AS article_id, vec_id AS cluster_id, 'seed' AS action, CAST(1 AS BIGINT) AS article_count FROM embeddings""")
def c2_separate_models(spark, sf_dir):
    """Ten models of their own; at the shipped thresholds none of the test vectors is near another, so all of them seed."""
    rows = members(spark, sf_dir).withColumn("model", (F.col("article_id") % 10).cast("string"))
    return C.assign(rows, C.Rules(size=64), parallel=False)[0].select("article_id", "cluster_id", "action", "article_count")


# ------------------------------------------------------------------ hand-made streams
CASE_RULES = C.Rules(join=0.9, gray=0.8, anchor=0.7, merge=0.9, gap=100, span=300, size=4, half=False)


def at(degrees: float) -> list[float]:
    return [math.cos(math.radians(degrees)), math.sin(math.radians(degrees)), 0.0, 0.0]


_XY = [("X", "ORG"), ("Y", "GPE")]
#: article_id, t, vector, domain, title, language, entities, entity_keys, phash, assigned
STREAM = [
    (1, 0, at(0), "a.com", "One", "en", _XY, ["x", "y"], 5, None),
    (2, 10, at(0), " B.com", "Two", "HI", [("x", "ORG")], ["x"], None, None),
    (3, 20, at(33), "b.com", "Three", "en", [], [], None, None),
    (4, 30, at(-33), "c.com", "Four", None, [], ["y", "x", ""], None, None),
    (5, 40, [0.0, 0.0, 0.0, 0.0], "a.com", "zero", "en", [], [], None, None),
    (6, 41, None, "a.com", "null", "en", [], [], None, None),
    (7, 42, [1.0, 0.0], "a.com", "short", "en", [], [], None, None),
    (8, 43, [float("nan"), 0.0, 0.0, 1.0], "a.com", "nan", "en", [], [], None, None),
    (9, 50, at(0), "z.com", "again", "en", [], [], None, 1),
    (10, 60, at(90), None, "", "en", [], [], None, None),
    (11, 500, at(0), "a.com", "Late", "en", [], [], 5, None),
    (12, 510, at(30), "d.com", "Photo", "en", [], [], 7, None),
    (13, 520, at(15), "d.com", "Middle", "fr", [], [], None, None),
]


def stream(spark: SparkSession) -> DataFrame:
    types = C.ARTICLE
    names = [c for c in types if c != "model"]
    schema = ", ".join(f"{c} {types[c] if c != 'vector' else 'array<double>'}" for c in names)
    return spark.createDataFrame(STREAM, schema).withColumn("model", F.lit("m"))


_R = "round(cos(radians({})), 6)"


@query("c1_stream_decisions", f"""SELECT * FROM (VALUES
(1, 1, 'seed', 1.0, 1, 1, NULL), (2, 1, 'join', 1.0, 2, 2, NULL), (3, 3, 'seed', 1.0, 1, 1, NULL), (4, 1, 'gray_join', {_R.format(33)}, 3, 3, NULL),
(5, NULL, 'invalid', NULL, NULL, NULL, 'zero or NaN vector'), (6, NULL, 'invalid', NULL, NULL, NULL, 'no vector'), (7, NULL, 'invalid', NULL, NULL, NULL, '2 dimensions, expected 4'), (8, NULL, 'invalid', NULL, NULL, NULL, 'zero or NaN vector'),
(9, 1, 'existing', NULL, 3, 3, NULL), (10, 10, 'seed', 1.0, 1, 1, NULL), (11, 11, 'seed', 1.0, 1, 1, NULL), (12, 11, 'gray_join', {_R.format(30)}, 2, 2, NULL), (13, 11, 'join', {_R.format(15)}, 3, 2, NULL))
AS t(article_id, cluster_id, action, similarity, article_count, outlet_count, error)""")  # fmt: skip
def c1_stream_decisions(spark, sf_dir):
    """Seed, join, gray zone by entities and by another outlet's image, gap, idempotence and guards, one fold."""
    out, _ = C.assign(stream(spark), CASE_RULES, parallel=False)
    return out.select("article_id", "cluster_id", "action", F.round("similarity", 6).alias("similarity"), "article_count", "outlet_count", "error")


@query("c4_stream_stories", """SELECT * FROM (VALUES
(1, 3, 0, 30, 1, 'One', 'a.com,b.com,c.com', 'en,hi', 'x,y', 'X:2,Y:1', '5@a.com', 1), (3, 1, 20, 20, 3, 'Three', 'b.com', 'en', '', '', '', 0),
(10, 1, 60, 60, 10, NULL, '(unknown)', 'en', '', '', '', 0), (11, 3, 500, 520, 13, 'Middle', 'a.com,d.com', 'en,fr', '', '', '5@a.com,7@d.com', 1))
AS t(cluster_id, n, first, last, rep_id, headline, outlets, languages, entity_set, entities, images, gray_joins)""")  # fmt: skip
def c4_stream_stories(spark, sf_dir):
    """Sets, tallies, representative swap and headline after the hand-made stream."""
    _, s = C.assign(stream(spark), CASE_RULES, parallel=False)
    tally = F.array_join(F.transform("top_entities", lambda e: F.concat(e["text"], F.lit(":"), e["count"].cast("string"))), ",")
    images = F.array_join(F.transform("image_hashes", lambda e: F.concat(e["h"].cast("string"), F.lit("@"), e["d"])), ",")
    join = lambda c: F.array_join(c, ",").alias(c)
    return s.select("cluster_id", "n", "first", "last", "rep_id", "headline", join("outlets"), join("languages"), join("entity_set"), tally.alias("entities"), images.alias("images"), "gray_joins")


def story(i: int, degrees: list[float], first: int, last: int, outlets: list[str], status: str = "active", into: int | None = None, tally: list | None = None) -> tuple:
    """A story whose members stand at these angles."""
    total = np.sum([at(d) for d in degrees], axis=0)
    centre = (total / np.linalg.norm(total)).tolist()
    return ("m", i, total.tolist(), centre, at(degrees[0]), at(degrees[0]), len(degrees), first, last, i * 10, i * 10, f"head {i}", outlets, ["en"], [f"e{i}"], tally or [], [(i, outlets[0])], 0, status, into)


TWINS = [
    story(1, [0, 0], 0, 50, ["a.com"], tally=[("Delhi", "GPE", 2)]), story(2, [5], 20, 20, ["b.com", "a.com"], tally=[("delhi", "GPE", 1), ("Mumbai", "GPE", 5)]), story(3, [12], 30, 30, ["c.com"]),
    story(4, [90], 0, 10, ["d.com"]), story(5, [92], 900, 910, ["d.com"]), story(6, [3], 10, 10, ["e.com"], "merged", 2), story(7, [91], 20, 40, ["f.com"]),
]


def twins(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TWINS, C.STORY)


@query("c5_merge_clusters", """SELECT * FROM (VALUES (1, 3, 0, 50, 'active', NULL, 'a.com,b.com', 'e1,e2', 'Mumbai:5,Delhi:3', '2,1', round(2 + cos(radians(5)), 6)), (2, 1, 20, 20, 'merged', 1, 'b.com,a.com', 'e2', 'delhi:1,Mumbai:5', '2', round(cos(radians(5)), 6)),
(3, 1, 30, 30, 'active', NULL, 'c.com', 'e3', '', '3', round(cos(radians(12)), 6)), (4, 1, 0, 10, 'active', NULL, 'd.com', 'e4', '', '4', 0.0), (5, 1, 900, 910, 'active', NULL, 'd.com', 'e5', '', '5', round(cos(radians(92)), 6)),
(6, 1, 10, 10, 'merged', 1, 'e.com', 'e6', '', '6', round(cos(radians(3)), 6)), (7, 1, 20, 40, 'active', NULL, 'f.com', 'e7', '', '7', round(cos(radians(91)), 6)))
AS t(cluster_id, n, first, last, status, merged_into, outlets, entity_set, entities, images, sum_x)""")  # fmt: skip
def c5_merge_clusters(spark, sf_dir):
    """1 takes 2: sums, sets, tallies, images; 2 and the tombstone that pointed at it point at 1.  A merge of a tombstone is refused."""
    plan = spark.createDataFrame([(1, 2), (3, 6)], "winner bigint, loser bigint")
    s = C.merge_stories(twins(spark), plan)
    tally = F.array_join(F.transform("top_entities", lambda e: F.concat(e["text"], F.lit(":"), e["count"].cast("string"))), ",")
    images = F.array_join(F.transform("image_hashes", lambda e: e["h"].cast("string")), ",")
    join = lambda c: F.array_join(c, ",").alias(c)
    return s.select("cluster_id", "n", "first", "last", "status", "merged_into", join("outlets"), join("entity_set"), tally.alias("entities"), images.alias("images"), (F.round(F.get("sum", F.lit(0)), 6) + F.lit(0.0)).alias("sum_x"))


@query("c7_merge_rounds", """SELECT * FROM (VALUES (1, 4, 'active', NULL), (2, 1, 'merged', 1), (3, 1, 'merged', 1), (4, 2, 'active', NULL), (5, 1, 'active', NULL), (6, 1, 'merged', 1), (7, 1, 'merged', 4)) AS t(cluster_id, n, status, merged_into)""")
def c7_merge_rounds(spark, sf_dir):
    """First round: 1 takes 2 and 4 takes 7; second round, from the winners: 1 takes 3.  5 is too late for 4."""
    return C.merge_twins(twins(spark), CASE_RULES)[0].select("cluster_id", "n", "status", "merged_into")


@query("c8_maintenance", """SELECT * FROM (VALUES (1, 5, 'active', NULL, 'a.com,q.com', 0, 70), (2, 1, 'merged', 1, 'b.com,a.com', 20, 20), (3, 1, 'merged', 1, 'c.com', 30, 30), (5, 1, 'active', NULL, 'd.com', 900, 910), (6, 1, 'merged', 1, 'e.com', 10, 10), (7, 1, 'merged', 4, 'f.com', 20, 40))
AS t(cluster_id, n, status, merged_into, outlets, first, last)""")  # fmt: skip
def c8_maintenance(spark, sf_dir):
    """Merge, recount from members, drop orphans idle for a week: 4 and 7 together have none and are old, 5 is recent enough."""
    rows = [(100 + k, c, d, t) for k, (c, d, t) in enumerate([(1, "A.com", 0), (1, "a.com", 10), (2, "q.com", 70), (3, "a.com", 30), (6, " a.com ", 5)])]
    articles = spark.createDataFrame(rows, "article_id bigint, cluster_id bigint, domain string, t bigint")
    s, _ = C.maintained(twins(spark), articles, 168 * 3600 + 500, CASE_RULES)
    return s.select("cluster_id", "n", "status", "merged_into", F.array_join("outlets", ",").alias("outlets"), "first", "last")


@query("c9_state_ttl", f"WITH {_STORIES} SELECT cluster_id FROM s WHERE status = 'active' AND last >= (SELECT max(last) FROM s) - 108000")
def c9_state_ttl(spark, sf_dir):
    """State of 30 hours: stories that fresh articles can no longer reach leave."""
    s = stories(spark, sf_dir)
    newest = s.agg(F.max("last")).first()[0] or 0
    return C.pruned(C.active(s), newest - 108000).select("cluster_id")


@query("c10_apply_delta", f"""WITH {_STORIES}, delta AS (SELECT cluster_id, CASE WHEN cluster_id % 4 = 0 THEN 'merged' ELSE status END AS status, n + 1 AS n FROM s WHERE cluster_id % 2 = 0)
SELECT cluster_id, n FROM s WHERE status = 'active' AND model = 'm0' AND cluster_id NOT IN (SELECT cluster_id FROM delta) UNION ALL SELECT cluster_id, n FROM delta WHERE status = 'active'""")  # fmt: skip
def c10_apply_delta(spark, sf_dir):
    """A full load of one model, then a delta in which every fourth story has become a tombstone."""
    s = stories(spark, sf_dir)
    changed = s.filter("cluster_id % 2 = 0").withColumn("status", F.when(F.col("cluster_id") % 4 == 0, "merged").otherwise(F.col("status"))).withColumn("n", F.col("n") + 1)
    return C.with_delta(C.full_load(s, "m0", 0), changed).select("cluster_id", "n")


@query("s18_cluster_state", f"WITH {_STORIES}, newest AS (SELECT max(last) AS t FROM s) SELECT cluster_id, 'full' AS via FROM s, newest WHERE status = 'active' AND model = 'm1' AND last >= t - 108000 UNION ALL SELECT cluster_id, 'delta' AS via FROM s, newest WHERE model = 'm1' AND last > t - 21600")
def s18_cluster_state(spark, sf_dir):
    """The full load (active, in the window) and the delta (any status, changed since the bookmark) of one model."""
    s = stories(spark, sf_dir)
    newest = s.agg(F.max("last")).first()[0] or 0
    full = C.full_load(s, "m1", newest - 108000).select("cluster_id", F.lit("full").alias("via"))
    return full.unionByName(s.filter((F.col("model") == "m1") & (F.col("last") > newest - 21600)).select("cluster_id", F.lit("delta").alias("via")))


@query("a9_purge_rescale", f"""WITH {_STORIES}, x AS (SELECT m.*, coalesce(lang, '') NOT IN ('en', 'fr') AS gone FROM m),
t AS (SELECT cluster_id, count(*) FILTER (gone) AS lost, count(*) FILTER (NOT gone) AS kept, list_sort(list(DISTINCT coalesce(nullif(lower(trim(source)), ''), '(unknown)')) FILTER (NOT gone)) AS ko, min(vec_id) FILTER (NOT gone) AS head, bool_or(gone AND vec_id IN (SELECT seed_id FROM s)) AS reseed FROM x GROUP BY 1)
SELECT s.cluster_id, CASE WHEN lost > 0 THEN kept ELSE n END AS n, array_to_string(CASE WHEN lost > 0 THEN ko ELSE outlets END, ',') AS outlets, CASE WHEN lost > 0 AND reseed THEN head ELSE seed_id END AS seed_id,
  round(list_sum(list_transform(sum, lambda v: abs(v))) * CASE WHEN lost > 0 THEN kept / greatest(n, kept) ELSE 1 END, 5) AS weight FROM s JOIN t ON t.cluster_id = s.cluster_id WHERE kept > 0""")  # fmt: skip
def a9_purge_rescale(spark, sf_dir):
    m = members(spark, sf_dir)
    gone = m.filter("coalesce(language, '') not in ('en', 'fr')").select("article_id")
    s, _ = C.purged(stories(spark, sf_dir), m, gone)
    weight = F.aggregate("sum", F.lit(0.0), lambda acc, x: acc + F.abs(x))
    return s.select("cluster_id", "n", F.array_join("outlets", ",").alias("outlets"), "seed_id", F.round(weight, 5).alias("weight"))


@query("c11_purge_scope", "SELECT e.vec_id AS article_id FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id WHERE d.lang IN ('en', 'fr')")
def c11_purge_scope(spark, sf_dir):
    m = members(spark, sf_dir)
    return C.purged(stories(spark, sf_dir), m, m.filter("coalesce(language, '') not in ('en', 'fr')").select("article_id"))[1].select("article_id")


def flushed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A flush over the hand-made twins: 1 grows, tombstone 6 is not revived, 8 is new, 4 comes again as new and is skipped."""
    changes = [
        (*story(1, [0, 0, 4], 0, 60, ["a.com", "x.com"]), False), (*story(6, [3, 3], 10, 99, ["e.com"]), False), (*story(8, [45], 70, 70, ["h.com"]), True), (*story(4, [90, 90], 0, 20, ["d.com"]), True),
    ]
    changes = spark.createDataFrame(changes, C.STORY + ", is_new boolean")
    articles = spark.createDataFrame([(201, None), (202, 3), (203, None), (204, None)], "article_id bigint, cluster_id bigint")
    stamps = spark.createDataFrame([(201, 1, "join", 0.97), (202, 1, "join", 0.9), (203, 8, "seed", 1.0)], "article_id bigint, cluster_id bigint, action string, similarity double")
    found = spark.createDataFrame([(201, "Pune", "GPE", 0.9), (201, "Delhi", "GPE", 0.5), (201, "", "ORG", 0.8), (204, "Goa", "GPE", 1.0)] + [(203, f"N{i:02}", "ORG", i / 100) for i in range(12)], "article_id bigint, text string, type string, salience double")
    return C.apply_changes(twins(spark), articles, changes, stamps, found)


@query("k7_apply_changes", """SELECT * FROM (VALUES (1, 3, 60, 'active', 'a.com,x.com', 'Delhi:3,Pune:1'), (2, 1, 20, 'active', 'b.com,a.com', 'delhi:1,Mumbai:5'), (3, 1, 30, 'active', 'c.com', ''), (4, 1, 10, 'active', 'd.com', ''), (5, 1, 910, 'active', 'd.com', ''), (6, 1, 10, 'merged', 'e.com', ''), (7, 1, 40, 'active', 'f.com', ''),
(8, 1, 70, 'active', 'h.com', 'N02:1,N03:1,N04:1,N05:1,N06:1,N07:1,N08:1,N09:1,N10:1,N11:1')) AS t(cluster_id, n, last, status, outlets, entities)""")  # fmt: skip
def k7_apply_changes(spark, sf_dir):
    s, _, _ = flushed(spark, sf_dir)
    tally = F.array_join(F.transform("top_entities", lambda e: F.concat(e["text"], F.lit(":"), e["count"].cast("string"))), ",")
    return s.select("cluster_id", "n", "last", "status", F.array_join("outlets", ",").alias("outlets"), tally.alias("entities"))


@query("k7_stamped_articles", """SELECT * FROM (VALUES (201, 1, 'join', 2, 2), (202, 3, NULL, 2, 2), (203, 8, 'seed', 2, 2), (204, NULL, NULL, 2, 2)) AS t(article_id, cluster_id, assignment, clusters_written, articles_written)""")
def k7_stamped_articles(spark, sf_dir):
    """Only articles without a story are stamped; what was written is counted."""
    _, articles, counts = flushed(spark, sf_dir)
    return articles.crossJoin(counts)  # one row of counts


@query("a8_reconcile_cluster_counts", f"""WITH {_STORIES}, mm AS (SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN cluster_id // 97 * 97 ELSE cluster_id END AS cluster_id, source, t FROM m),
r AS (SELECT cluster_id, count(*) AS rn, min(t) AS rf, max(t) AS rl, list_sort(list(DISTINCT coalesce(nullif(lower(trim(source)), ''), '(unknown)'))) AS ro FROM mm GROUP BY 1)
SELECT s.cluster_id, CASE WHEN status = 'active' AND rn IS NOT NULL THEN rn ELSE n END AS n, CASE WHEN status = 'active' AND rn IS NOT NULL THEN rf ELSE first END AS first, CASE WHEN status = 'active' AND rn IS NOT NULL THEN rl ELSE last END AS last,
  array_to_string(CASE WHEN status = 'active' AND rn IS NOT NULL THEN ro ELSE outlets END, ',') AS outlets FROM s LEFT JOIN r ON r.cluster_id = s.cluster_id""")  # fmt: skip
def a8_reconcile_cluster_counts(spark, sf_dir):
    """Every fifth article has moved to the first story of its run, so counts have drifted; they are counted anew."""
    moved = members(spark, sf_dir).withColumn("cluster_id", F.expr("case when article_id % 5 = 0 then cluster_id div 97 * 97 else cluster_id end"))
    return C.reconciled(stories(spark, sf_dir), moved).select("cluster_id", "n", "first", "last", F.array_join("outlets", ",").alias("outlets"))


@query("j12_image_evidence", """WITH i AS (SELECT user_id, list(DISTINCT {'h': event_id * 7 % 512, 'd': event_type}) AS hs FROM events GROUP BY 1)
SELECT e.event_id, len(list_filter(i.hs, lambda x: x.d <> e.event_type AND bit_count(xor(x.h, e.event_id * 11 % 512)) <= 2)) > 0 AS evidence FROM events e JOIN i ON i.user_id = e.user_id""")  # fmt: skip
def j12_image_evidence(spark, sf_dir):
    """Whether another outlet's image hash in the same list is within a few bits."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    lists = e.groupBy("user_id").agg(F.collect_set(F.struct((F.col("event_id") * 7 % 512).alias("h"), F.col("event_type").alias("d"))).alias("hs"))
    found = lambda x: ~x["d"].eqNullSafe(F.col("event_type")) & (U.hamming(x["h"], F.col("event_id") * 11 % 512) <= 2)
    return e.join(lists, "user_id").select("event_id", F.exists("hs", found).alias("evidence"))


# ------------------------------------------------------------------ sums, centroids, average link
@query("a10_centroids", f"WITH {_STORIES} SELECT cluster_id, n, round(sqrt(list_inner_product(sum, sum)) / n, 6) AS tightness, round(sum[1] / sqrt(list_inner_product(sum, sum)), 6) AS c0, round(sum[64] / sqrt(list_inner_product(sum, sum)), 6) AS c63 FROM s")
def a10_centroids(spark, sf_dir):
    """Exact sums and normalised centroids; tightness is the length of the mean."""
    s = stories(spark, sf_dir)
    return s.select("cluster_id", "n", F.round(V.norm(F.col("sum")) / F.col("n"), 6).alias("tightness"), F.round(F.get("centroid", F.lit(0)), 6).alias("c0"), F.round(F.get("centroid", F.lit(63)), 6).alias("c63"))


@query("a11_average_link", f"WITH {_STORIES} SELECT m.vec_id, round(list_inner_product(CAST(m.embedding AS DOUBLE[]), s.sum) / s.n, 6) AS link FROM m JOIN s ON s.cluster_id = m.cluster_id")
def a11_average_link(spark, sf_dir):
    """Mean cosine of each article with the members of its story; story with story is in j6."""
    s = stories(spark, sf_dir).select("cluster_id", "sum", "n")
    return members(spark, sf_dir).join(s, "cluster_id").select(F.col("article_id").alias("vec_id"), F.round(V.dot(F.col("vector"), F.col("sum")) / F.col("n"), 6).alias("link"))


@query("f7_vector_guard", "WITH c AS (SELECT vec_id, CASE vec_id % 5 WHEN 0 THEN list_transform(embedding, lambda x: x * 0) WHEN 1 THEN embedding[1:10] WHEN 2 THEN NULL ELSE embedding END AS v FROM embeddings) SELECT vec_id, coalesce(len(v) = 64 AND list_sum(list_transform(v, lambda x: abs(x))) > 0, false) AND vec_id % 5 <> 3 AS ok FROM c")
def f7_vector_guard(spark, sf_dir):
    """Zero, short, null and NaN vectors are refused."""
    bad = F.expr("case vec_id % 5 when 0 then transform(embedding, x -> x * 0) when 1 then slice(embedding, 1, 10) when 3 then transform(embedding, x -> cast('NaN' as float)) when 4 then embedding end")
    return read(spark, sf_dir, "embeddings").select("vec_id", V.valid(bad, 64).alias("ok"))
