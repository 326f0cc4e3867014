"""Evaluation metrics, health views, samples and orders over whole tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storyloom.functions import arrays as A
from storyloom.operators import clustering as C
from storyloom.operators.stories import read
from storyloom.plans.cases import values
from storyloom.plans.model import NOW, run_sql, with_roles
from storyloom.plans.ranks import numbered, oldest_over, tile
from storyloom.plans.registry import query

DAY = 86_400


# ------------------------------------------------------------------ gold labels
def gold(a: DataFrame, b: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """gid, label, how, cant_tell of two passes (gid, label, cant_tell): agreed, else adjudicated, else left out; both must say cant_tell."""
    rows = a.alias("a").join(b.alias("b"), "gid", "full").join(adjudicated.select("gid", F.col("label").alias("j")), "gid", "full")
    same = F.col("a.label") == F.col("b.label")
    label = F.when(same, F.col("a.label")).otherwise(F.col("j"))
    out = rows.select("gid", label.alias("label"), F.when(same, "agreed").otherwise("adjudicated").alias("how"), (F.coalesce("a.cant_tell", F.lit(False)) & F.coalesce("b.cant_tell", F.lit(False))).alias("cant_tell"))
    return out.filter("label is not null")


#: Two passes over the labelled documents: they differ where doc_id % 9 = 0; a third of those is adjudicated.
_PASSES = "a AS (SELECT doc_id AS gid, quality AS label, doc_id % 6 = 1 AS cant FROM labels WHERE doc_id % 11 <> 0), b AS (SELECT doc_id AS gid, CASE WHEN doc_id % 9 = 0 THEN 1 - quality ELSE quality END AS label, doc_id % 4 = 1 AS cant FROM labels WHERE doc_id % 13 <> 0), j AS (SELECT doc_id AS gid, quality AS label FROM labels WHERE doc_id % 27 = 0 OR doc_id % 22 = 0)"
_GOLD = f"{_PASSES}, g AS (SELECT coalesce(a.gid, b.gid, j.gid) AS gid, CASE WHEN a.label = b.label THEN a.label ELSE j.label END AS label, CASE WHEN a.label = b.label THEN 'agreed' ELSE 'adjudicated' END AS how, coalesce(a.cant, false) AND coalesce(b.cant, false) AS cant_tell FROM a FULL JOIN b ON b.gid = a.gid FULL JOIN j ON j.gid = coalesce(a.gid, b.gid))"


def passes(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("gid"), F.col("quality").alias("label"))
    a = rows.filter("gid % 11 <> 0").withColumn("cant_tell", F.expr("gid % 6 = 1"))
    b = rows.filter("gid % 13 <> 0").select("gid", F.expr("case when gid % 9 = 0 then 1 - label else label end").alias("label"), F.expr("gid % 4 = 1").alias("cant_tell"))
    return a, b, rows.filter("gid % 27 = 0 or gid % 22 = 0")


@query("j16_gold_build", f"WITH {_GOLD} SELECT gid, label, how, cant_tell FROM g WHERE label IS NOT NULL")
def j16_gold_build(spark, sf_dir):
    return gold(*passes(spark, sf_dir))


def kappa(pairs: DataFrame) -> DataFrame:
    """n, agree, kappa of pairs (a, b): agreement corrected for chance, 1 where chance is certain, null of no pairs."""
    cells = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    own = lambda c: cells.groupBy(F.col(c).alias("k")).agg(F.sum("n").alias(f"n_{c}"))
    chance = own("a").join(own("b"), "k").agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("c"))
    total = cells.agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("n"))), F.lit(0)).alias("same"))
    pe, po = F.col("c") / (F.col("n") * F.col("n")), F.col("same") / F.col("n")
    return total.crossJoin(chance).select("n", F.round(po, 6).alias("agree"), F.round(F.when(pe == 1, 1.0).otherwise((po - pe) / (1 - pe)), 6).alias("kappa"))  # one row each


@query("a16_cohen_kappa", f"WITH {_PASSES}, p AS (SELECT a.label AS a, b.label AS b FROM a JOIN b ON b.gid = a.gid), t AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS same FROM p), e AS (SELECT sum(x.n * y.n) AS c FROM (SELECT a AS k, count(*) AS n FROM p GROUP BY a) x JOIN (SELECT b AS k, count(*) AS n FROM p GROUP BY b) y ON y.k = x.k) SELECT n, round(same / n, 6) AS agree, round((same / n - c / (n * n)) / (1 - c / (n * n)), 6) AS kappa FROM t, e")
def a16_cohen_kappa(spark, sf_dir):
    a, b, _ = passes(spark, sf_dir)
    return kappa(a.select("gid", F.col("label").alias("a")).join(b.select("gid", F.col("label").alias("b")), "gid"))


@query("a18_accuracy", f"WITH {_GOLD}, s AS (SELECT d.lang, (CASE WHEN d.n_chars > 700 THEN 1 ELSE 0 END) = g.label AS ok FROM g JOIN documents d ON d.doc_id = g.gid WHERE g.label IS NOT NULL AND NOT g.cant_tell), l AS (SELECT lang, count(*) AS n, count(*) FILTER (ok) AS r FROM s GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(r) / sum(n), 6) AS accuracy, round(avg(r / n), 6) AS macro FROM l")
def a18_accuracy(spark, sf_dir):
    """Accuracy over all gold items that can be told, and its mean over languages; the prediction is by length."""
    g = gold(*passes(spark, sf_dir)).filter("not cant_tell")
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("gid"), "lang", F.when(F.col("n_chars") > 700, 1).otherwise(0).alias("said"))
    by = g.join(d, "gid").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("said") == F.col("label")).alias("r"))
    return by.agg(F.sum("n").alias("n"), F.round(F.sum("r") / F.sum("n"), 6).alias("accuracy"), F.round(F.avg(F.col("r") / F.col("n")), 6).alias("macro"))


@query("a18_confusion", f"WITH {_GOLD}, s AS (SELECT g.label AS gold, d.n_chars // 400 % 4 AS said FROM g JOIN documents d ON d.doc_id = g.gid WHERE g.label IS NOT NULL AND NOT g.cant_tell) SELECT gold, said, count(*) AS n FROM s WHERE gold <> said GROUP BY 1, 2 ORDER BY n DESC, gold, said LIMIT 8")
def a18_confusion(spark, sf_dir):
    """The eight most common errors."""
    g = gold(*passes(spark, sf_dir)).filter("not cant_tell")
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("gid"), F.expr("n_chars div 400 % 4").alias("said"))
    return g.join(d, "gid").filter("label <> said").groupBy(F.col("label").alias("gold"), "said").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "gold", "said").limit(8)


def tag_scores(gold_tags: DataFrame, said_tags: DataFrame) -> DataFrame:
    """micro_p, micro_r, micro_f1, macro_f1 (over tags with support), exact, items, from (gid, tags array); a missing prediction is the empty set."""
    both = gold_tags.select("gid", F.array_distinct("tags").alias("g")).join(said_tags.select("gid", F.array_distinct("tags").alias("p")), "gid", "left").withColumn("p", F.coalesce("p", F.array().cast("array<string>")))
    flat = both.select(F.explode(F.array_union("g", "p")).alias("tag"), "g", "p").select("tag", F.array_contains("g", F.col("tag")).alias("ing"), F.array_contains("p", F.col("tag")).alias("inp"))
    per = flat.groupBy("tag").agg(F.count_if(F.col("ing") & F.col("inp")).alias("tp"), F.count_if(~F.col("ing")).alias("fp"), F.count_if(~F.col("inp")).alias("fn"))
    f1 = lambda t, f, n: 2 * t / (2 * t + f + n)
    t, f, n = F.sum("tp"), F.sum("fp"), F.sum("fn")
    out = per.agg(F.round(t / (t + f), 6).alias("micro_p"), F.round(t / (t + n), 6).alias("micro_r"), F.round(f1(t, f, n), 6).alias("micro_f1"), F.round(F.avg(F.when(F.col("tp") + F.col("fn") > 0, f1(F.col("tp"), F.col("fp"), F.col("fn")))), 6).alias("macro_f1"))
    exact = both.agg(F.count("*").alias("items"), F.round(F.avg((F.array_sort("g") == F.array_sort("p")).cast("double")), 6).alias("exact"))
    return out.crossJoin(exact)  # one row each


_TAGS = """g AS (SELECT doc_id AS gid, list_filter(['short', lang, source], lambda x: x <> 'short' OR n_chars < 600) AS tags FROM documents), p AS (SELECT doc_id AS gid, list_distinct([lang, CASE WHEN doc_id % 3 = 0 THEN 'short' ELSE source END, CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END]) AS tags FROM documents WHERE doc_id % 10 <> 0),
f AS (SELECT gid, unnest(tags) AS tag FROM g), q AS (SELECT gid, unnest(tags) AS tag FROM p), m AS (SELECT coalesce(f.tag, q.tag) AS tag, f.gid IS NOT NULL AS ing, q.gid IS NOT NULL AS inp FROM f FULL JOIN q ON q.gid = f.gid AND q.tag = f.tag), per AS (SELECT tag, count(*) FILTER (ing AND inp) AS tp, count(*) FILTER (NOT ing) AS fp, count(*) FILTER (NOT inp) AS fn FROM m GROUP BY 1)"""


@query("a17_tag_scores", f"WITH {_TAGS} SELECT round(sum(tp) / (sum(tp) + sum(fp)), 6) AS micro_p, round(sum(tp) / (sum(tp) + sum(fn)), 6) AS micro_r, round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS micro_f1, round(avg(2 * tp / (2 * tp + fp + fn)) FILTER (tp + fn > 0), 6) AS macro_f1, (SELECT count(*) FROM g) AS items, (SELECT round(avg(CASE WHEN list_sort(g.tags) = list_sort(p.tags) THEN 1.0 ELSE 0.0 END), 6) FROM g LEFT JOIN p ON p.gid = g.gid) AS exact FROM per")
def a17_tag_scores(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    g = d.select(F.col("doc_id").alias("gid"), F.array_compact(F.array(F.when(F.col("n_chars") < 600, "short"), "lang", "source")).alias("tags"))
    p = d.filter("doc_id % 10 <> 0").select(F.col("doc_id").alias("gid"), F.array(F.col("lang"), F.when(F.col("doc_id") % 3 == 0, "short").otherwise(F.col("source")), F.when(F.col("n_chars") < 500, "short").otherwise("long")).alias("tags"))
    return tag_scores(g, p)


_PAIRS = "pr AS (SELECT vec_id AS a, vec_id + 7 AS b, vec_id % 3 AS grade FROM embeddings WHERE vec_id + 7 IN (SELECT vec_id FROM embeddings)), cl AS (SELECT vec_id, CASE WHEN vec_id % 50 = 0 THEN 1000000 + vec_id ELSE vec_id // 10 END AS c, vec_id % 5 AS outlet FROM embeddings)"


@query("a20_pairwise_quality", f"WITH {_PAIRS}, s AS (SELECT grade, x.c = y.c AS same FROM pr JOIN cl x ON x.vec_id = pr.a JOIN cl y ON y.vec_id = pr.b), n AS (SELECT count(*) FILTER (same AND grade = 2) AS tp, count(*) FILTER (same AND grade <> 2) AS fp, count(*) FILTER (same AND grade = 0) AS fl, count(*) FILTER (NOT same AND grade = 2) AS fn FROM s), z AS (SELECT c, count(*) AS n, count(DISTINCT outlet) AS o FROM cl GROUP BY 1) SELECT round(tp / (tp + fp), 6) AS p, round(tp / (tp + fn), 6) AS r, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp + fp - fl) / (tp + fp), 6) AS p_loose, (SELECT count(*) FROM z) AS clusters, (SELECT round(100.0 * count(*) FILTER (n = 1) / count(*), 4) FROM z) AS singleton_pct, (SELECT count(*) FILTER (o >= 2) FROM z) AS multi_outlet FROM n")
def a20_pairwise_quality(spark, sf_dir):
    """Strict scores (grade 2), loose precision (grade 1 too), singletons and stories of several outlets."""
    e = read(spark, sf_dir, "embeddings").select("vec_id")
    home = e.select("vec_id", F.expr("case when vec_id % 50 = 0 then 1000000 + vec_id else vec_id div 10 end").alias("c"), F.expr("vec_id % 5").alias("outlet"))
    pairs = e.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 7).alias("b"), F.expr("vec_id % 3").alias("grade"))
    at = lambda end: home.select(F.col("vec_id").alias(end), F.col("c").alias(f"c_{end}"))
    same, good = F.col("c_a") == F.col("c_b"), F.col("grade") == 2
    n = pairs.join(at("a"), "a").join(at("b"), "b").agg(F.count_if(same & good).alias("tp"), F.count_if(same & ~good).alias("fp"), F.count_if(same & (F.col("grade") == 0)).alias("fl"), F.count_if(~same & good).alias("fn"))
    stories = home.groupBy("c").agg(F.count("*").alias("n"), F.count_distinct("outlet").alias("o")).agg(F.count("*").alias("clusters"), F.round(100.0 * F.count_if(F.col("n") == 1) / F.count("*"), 4).alias("singleton_pct"), F.count_if(F.col("o") >= 2).alias("multi_outlet"))
    tp, fp, fl, fn = (F.col(c) for c in ("tp", "fp", "fl", "fn"))
    part = lambda x, y: F.round(F.when(y > 0, x / y).otherwise(1.0), 6)
    return n.crossJoin(stories).select(part(tp, tp + fp).alias("p"), part(tp, tp + fn).alias("r"), part(2 * tp, 2 * tp + fp + fn).alias("f1"), part(tp + fp - fl, tp + fp).alias("p_loose"), "clusters", "singleton_pct", "multi_outlet")  # one row each


@query("a19_roc_auc", """WITH s AS (SELECT l.quality AS y, CAST(d.n_chars AS DOUBLE) AS s FROM labels l JOIN documents d ON d.doc_id = l.doc_id), r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM s),
g AS (SELECT sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS pos, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn FROM r) SELECT round((pos - np * (np + 1) / 2) / (np * nn), 6) AS auc FROM g WHERE np > 0 AND nn > 0""")  # fmt: skip
def a19_roc_auc(spark, sf_dir):
    """Mann-Whitney: scores are counted by value first; each value's place comes from the counts of smaller ones."""
    rows = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    by = rows.groupBy(F.col("n_chars").cast("double").alias("s")).agg(F.count_if(F.col("quality") == 1).alias("pos"), F.count_if(F.col("quality") == 0).alias("neg"))
    ranged = numbered(by, F.col("s"))
    # wins of positives over negatives of smaller value, halves for equal ones; sums run over ranges
    cut = ranged.withColumn("block", F.floor((F.col("place") - 1) / 4096))
    below = cut.groupBy("block").agg(F.sum("neg").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row for 4,096 values
    inner = F.coalesce(F.sum("neg").over(W.partitionBy("block").orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    won = cut.withColumn("inner", inner).join(below.select("block", "before"), "block").agg(F.sum(F.col("pos") * (F.col("inner") + F.col("before") + F.col("neg") / 2)).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return won.filter("p > 0 and n > 0").select(F.round(F.col("w") / (F.col("p") * F.col("n")), 6).alias("auc"))


# ------------------------------------------------------------------ coverage
@query("a15_alerts", with_roles(f"""WITH r AS (SELECT coalesce(nullif(lower(trim(domain)), ''), '(unknown)') AS domain, count(*) AS ref_count, count(*) FILTER (NOT is_crawled) AS missing, count(*) FILTER (crawled_at > {NOW - DAY}) AS ours, count(*) FILTER (crawled_at <= {NOW - DAY} AND crawled_at > {NOW - 2 * DAY}) AS prev FROM articles GROUP BY 1),
t AS (SELECT domain FROM r ORDER BY ref_count DESC, domain LIMIT 100) SELECT domain, 'missed' AS alert FROM r WHERE domain IN (SELECT domain FROM t) AND ref_count >= 20 AND round(missing / ref_count, 4) > 0.02 UNION ALL SELECT domain, 'dead source' FROM r WHERE prev >= 20 AND ours < prev * 0.9"""))  # fmt: skip
def a15_alerts(spark, sf_dir):
    """Misses of the hundred largest domains, and sources whose yield fell (by a tenth here) against the last measurement."""
    a = run_sql(spark, sf_dir, "SELECT domain, is_crawled, crawled_at FROM articles").withColumn("domain", A.norm_domain(F.col("domain")))
    day = lambda lo, hi: F.count_if((F.col("crawled_at") > lo) & (F.col("crawled_at") <= hi))
    r = a.groupBy("domain").agg(F.count("*").alias("ref_count"), F.count_if(~F.col("is_crawled")).alias("missing"), day(NOW - DAY, 1 << 60).alias("ours"), day(NOW - 2 * DAY, NOW - DAY).alias("prev"))
    return alerts(r, drop=0.1)


def alerts(rows: DataFrame, top: int = 100, least: int = 20, miss: float = 0.02, drop: float = 0.5) -> DataFrame:
    """domain, alert of rows (domain, ref_count, missing, ours, prev)."""
    best = rows.orderBy(F.desc("ref_count"), "domain").limit(top).select("domain")
    missed = rows.join(best, "domain", "left_semi").filter((F.col("ref_count") >= least) & (F.round(F.col("missing") / F.col("ref_count"), 4) > miss))
    dead = rows.filter((F.col("prev") >= least) & (F.col("ours") < F.col("prev") * (1 - drop)))
    return missed.select("domain", F.lit("missed").alias("alert")).unionByName(dead.select("domain", F.lit("dead source").alias("alert")))


# ------------------------------------------------------------------ health views
@query("a3_cluster_health", with_roles(f"""WITH x AS (SELECT *, CASE WHEN cluster_id IS NULL THEN NULL WHEN id % 5 = 0 THEN 'seed' WHEN id % 5 = 1 THEN 'gray_join' ELSE 'join' END AS how FROM articles), a AS (SELECT * FROM x WHERE enriched_at > {NOW - DAY}), c AS (SELECT * FROM clusters WHERE status = 'active' AND last_seen > {NOW - DAY})
SELECT (SELECT count(*) FROM a) AS enriched_24h, (SELECT round(100.0 * count(how) / nullif(count(*), 0), 1) FROM a) AS clustered_pct, (SELECT round(100.0 * count(*) FILTER (how = 'seed') / nullif(count(how), 0), 1) FROM a) AS seed_pct,
(SELECT round(100.0 * count(*) FILTER (how = 'gray_join') / nullif(count(*) FILTER (how IN ('join', 'gray_join')), 0), 1) FROM a) AS gray_join_pct, (SELECT count(*) FROM c) AS active_clusters_24h, (SELECT count(*) FROM c WHERE outlet_count >= 2) AS multi_outlet_clusters_24h,
(SELECT max(outlet_count) FROM c) AS max_outlet_count_24h, (SELECT round(avg(article_count), 2) FROM c) AS avg_cluster_size_24h, (SELECT count(*) FROM clusters WHERE status = 'merged' AND last_seen > {NOW - DAY}) AS merges_24h"""))  # fmt: skip
def a3_cluster_health(spark, sf_dir):
    """One row: one pass over the day's articles, one over the clusters."""
    a = run_sql(spark, sf_dir, f"SELECT CASE WHEN cluster_id IS NULL THEN NULL WHEN id % 5 = 0 THEN 'seed' WHEN id % 5 = 1 THEN 'gray_join' ELSE 'join' END AS how FROM articles WHERE enriched_at > {NOW - DAY}")
    c = run_sql(spark, sf_dir, "SELECT status, last_seen, outlet_count, article_count FROM clusters")
    percent = lambda x, y: F.round(100.0 * x / F.nullif(y, F.lit(0)), 1)
    some = F.count("how")
    left = a.agg(F.count("*").alias("enriched_24h"), percent(some, F.count("*")).alias("clustered_pct"), percent(F.count_if(F.col("how") == "seed"), some).alias("seed_pct"), percent(F.count_if(F.col("how") == "gray_join"), F.count_if(F.col("how").isin("join", "gray_join"))).alias("gray_join_pct"))
    recent = F.col("last_seen") > NOW - DAY
    live = recent & (F.col("status") == "active")
    right = c.agg(F.count_if(live).alias("active_clusters_24h"), F.count_if(live & (F.col("outlet_count") >= 2)).alias("multi_outlet_clusters_24h"), F.max(F.when(live, F.col("outlet_count"))).alias("max_outlet_count_24h"), F.round(F.avg(F.when(live, F.col("article_count"))), 2).alias("avg_cluster_size_24h"), F.count_if(recent & (F.col("status") == "merged")).alias("merges_24h"))
    return left.crossJoin(right)  # one row each


@query("a5_enrichment_health", with_roles("SELECT count(*) AS total_articles, count(enriched_at) AS enriched, count(*) - count(enriched_at) AS pending, CAST(round(count(enriched_at) / count(*) * 100) AS INTEGER) AS enriched_pct, count(*) FILTER (n_chars % 3 <> 0) AS has_category, count(cluster_id) AS clustered, count(language_code) AS language_detected, count(*) FILTER (id % 8 = 0) AS has_image_hash, (SELECT count(*) FROM clusters) AS total_clusters, (SELECT count(*) FROM events) AS total_entities FROM articles"))
def a5_enrichment_health(spark, sf_dir):
    """Coverage of each output column; categories, hashes and entities are played by other columns of the test data."""
    a = run_sql(spark, sf_dir, "SELECT enriched_at, cluster_id, language_code, CASE WHEN n_chars % 3 <> 0 THEN 'x' END AS category, CASE WHEN id % 8 = 0 THEN id END AS image_phash FROM articles")
    n, done = F.count("*"), F.count("enriched_at")
    out = a.agg(n.alias("total_articles"), done.alias("enriched"), (n - done).alias("pending"), F.round(done / n * 100).cast("int").alias("enriched_pct"), F.count("category").alias("has_category"), F.count("cluster_id").alias("clustered"), F.count("language_code").alias("language_detected"), F.count("image_phash").alias("has_image_hash"))
    clusters = run_sql(spark, sf_dir, "SELECT id FROM clusters").agg(F.count("*").alias("total_clusters"))
    return out.crossJoin(clusters).crossJoin(read(spark, sf_dir, "events").agg(F.count("*").alias("total_entities")))  # one row each


@query("w7_recent_runs", "SELECT o_orderkey AS run_id, CAST(epoch(o_orderdate) AS BIGINT) AS started_at FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100")
def w7_recent_runs(spark, sf_dir):
    """The latest hundred runs; orders play them."""
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("started_at"))
    return rows.orderBy(F.desc("started_at"), F.desc("run_id")).limit(100)


@query("w3_ordered_first_last", "SELECT source, min_by(doc_id, (n_chars, doc_id)) AS first_id, max_by(doc_id, (n_chars, doc_id)) AS last_id FROM documents GROUP BY 1")
def w3_ordered_first_last(spark, sf_dir):
    key = F.struct("n_chars", "doc_id")
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.min_by("doc_id", key).alias("first_id"), F.max_by("doc_id", key).alias("last_id"))


@query("w5_unclustered_ingested", with_roles(f"SELECT id, CASE WHEN length(coalesce(description, '')) < 40 THEN left(body, 1500) END AS lead FROM (SELECT *, CASE WHEN id % 3 = 0 THEN left(body, 30) ELSE left(body, 200) END AS description FROM articles) a WHERE cluster_id IS NULL AND crawled_at > {NOW - 5 * DAY} AND coalesce(published_at, crawled_at) <= {NOW + 3600} ORDER BY crawled_at, id LIMIT 200"))
def w5_unclustered_ingested(spark, sf_dir):
    """By ingest time; the body's lead is read only where the description is too short."""
    rows = run_sql(spark, sf_dir, f"SELECT id, body, crawled_at, CASE WHEN id % 3 = 0 THEN left(body, 30) ELSE left(body, 200) END AS description FROM articles WHERE cluster_id IS NULL AND crawled_at > {NOW - 5 * DAY} AND coalesce(published_at, crawled_at) <= {NOW + 3600}")
    lead = F.when(F.length(F.coalesce("description", F.lit(""))) < 40, F.left("body", F.lit(1500)))
    return rows.select("id", "crawled_at", lead.alias("lead")).orderBy("crawled_at", "id").limit(200).drop("crawled_at")


# ------------------------------------------------------------------ orders and samples of whole tables
@query("w8_prune_oldest", "WITH n AS (SELECT count(*) AS n FROM documents), k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS k FROM documents) SELECT doc_id AS id FROM k, n WHERE n > 150 AND k > 120 ORDER BY id LIMIT 200")
def w8_prune_oldest(spark, sf_dir):
    """Over the hard limit (150) all but the newest 120 go, the oldest first, 200 at a time."""
    return oldest_over(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), 150, 120, 200)


def neighbour_pairs(vectors: DataFrame, most: int) -> DataFrame:
    """a, b, similarity: pairs of each row (model, id, vector) with its `most` nearest of the same model, every pair once."""
    rows = vectors.select("model", "id", F.lit(0).alias("at"), "vector")

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        y = y.sort_values("id")
        near = np.round(C.matrix(x, "vector") @ C.matrix(y, "vector").T, 9)
        near[x["id"].to_numpy()[:, None] == y["id"].to_numpy()[None, :]] = -np.inf
        every, found = np.arange(len(x)), []
        for _ in range(min(most, len(y))):
            at = near.argmax(axis=1)  # the first of equals, which has the smallest id
            found.append(pd.DataFrame({"a": x["id"].to_numpy(), "b": y["id"].to_numpy()[at], "similarity": near[every, at]}))
            near[every, at] = -np.inf
        out = pd.concat(found, ignore_index=True)
        return out[out["similarity"] > -np.inf]

    def nearest(found: pd.DataFrame) -> pd.DataFrame:
        return found.sort_values(["a", "similarity", "b"], ascending=[True, False, True]).groupby("a", sort=False).head(most)

    near = C.blockwise(rows, rows, 1, run, "a bigint, b bigint, similarity double", nearest)
    place = F.row_number().over(W.partitionBy("a").orderBy(F.desc("similarity"), "b"))
    near = near.withColumn("place", place).filter(F.col("place") <= most)
    return near.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("similarity").alias("similarity"))


@query("w11_decile_pool", """WITH s AS (SELECT x.vec_id AS a, y.vec_id AS b, round(list_inner_product(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) / sqrt(list_inner_product(CAST(x.embedding AS DOUBLE[]), CAST(x.embedding AS DOUBLE[]))) / sqrt(list_inner_product(CAST(y.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[]))), 9) AS s FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id),
k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS k FROM s), p AS (SELECT least(a, b) AS a, greatest(a, b) AS b, max(s) AS s FROM k WHERE k <= 3 GROUP BY 1, 2), d AS (SELECT a, b, ntile(10) OVER (ORDER BY s, a, b) AS decile FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY decile ORDER BY md5('pool' || CAST(a AS VARCHAR) || '-' || CAST(b AS VARCHAR))) AS o FROM d) SELECT a, b, decile FROM o WHERE o <= 8""")  # fmt: skip
def w11_decile_pool(spark, sf_dir):
    """Pairs of three nearest neighbours, pooled, cut into deciles of likeness, eight of each in a seeded order."""
    e = read(spark, sf_dir, "embeddings").select(F.lit("m").alias("model"), F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    pairs = numbered(neighbour_pairs(e, 3), F.col("similarity"), F.col("a"), F.col("b"))
    rows = pairs.withColumn("decile", tile(F.col("place"), pairs.count(), 10))
    seeded: Column = F.md5(F.concat(F.lit("pool"), F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string")).cast("binary"))
    return rows.withColumn("o", F.row_number().over(W.partitionBy("decile").orderBy(seeded))).filter("o <= 8").select("a", "b", "decile")


@query("w13_time_order", with_roles("SELECT id, row_number() OVER (ORDER BY coalesce(published_at, crawled_at), id) AS place FROM articles WHERE cluster_id IS NULL"))
def w13_time_order(spark, sf_dir):
    rows = run_sql(spark, sf_dir, "SELECT id, coalesce(published_at, crawled_at) AS t FROM articles WHERE cluster_id IS NULL")
    return numbered(rows, F.col("t"), F.col("id")).select("id", "place")


@query("w14_poll_order", with_roles("SELECT id, row_number() OVER (ORDER BY last_polled_at NULLS FIRST, id) AS place FROM feeds"))
def w14_poll_order(spark, sf_dir):
    return numbered(run_sql(spark, sf_dir, "SELECT id, last_polled_at FROM feeds"), F.asc_nulls_first("last_polled_at"), F.col("id")).select("id", "place")


# ------------------------------------------------------------------ arrays
_LISTS = "e AS (SELECT user_id, event_id, event_type, CASE event_id % 4 WHEN 0 THEN upper(event_type) WHEN 1 THEN ' ' ELSE event_type END AS text, event_id % 2 AS new FROM events)"


@query("r1_merge_top_entities", f"WITH {_LISTS}, s AS (SELECT user_id, lower(text) AS k, min_by(text, (new, event_id)) AS t, count(*) AS n FROM e WHERE trim(text) <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, k) AS r FROM s) SELECT user_id, string_agg(t || ':' || CAST(n AS VARCHAR), ',' ORDER BY r) AS merged FROM r WHERE r <= 3 GROUP BY 1")
def r1_merge_top_entities(spark, sf_dir):
    """Two lists of each user: counts add by lower-cased text, the first spelling stays, blanks go, three are kept."""
    text = F.expr("case event_id % 4 when 0 then upper(event_type) when 1 then ' ' else event_type end")
    e = read(spark, sf_dir, "events").select("user_id", "event_id", text.alias("text"))
    entity = F.struct("text", F.lit("x").alias("type"), F.lit(None).cast("bigint").alias("count"))
    of = lambda k: A.list_in_order(F.when(F.col("event_id") % 2 == k, F.col("event_id")), F.when(F.col("event_id") % 2 == k, entity))
    lists = e.groupBy("user_id").agg(F.filter(of(0), lambda x: x.isNotNull()).alias("old"), F.filter(of(1), lambda x: x.isNotNull()).alias("new"))
    merged = A.merged_entities(F.col("old"), F.col("new"), 3)
    return lists.select("user_id", F.array_join(F.transform(merged, lambda x: F.concat(x["text"], F.lit(":"), x["count"].cast("string"))), ",").alias("merged")).filter("merged <> ''")


@query("r2_ordered_union", "WITH x AS (SELECT doc_id, list_concat(string_split(left(text, 200), ' '), string_split(right(text, 200), ' ')) AS l FROM documents), f AS (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM x), m AS (SELECT doc_id, w, min(i) AS i FROM f WHERE w <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM m) SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS u FROM r WHERE r <= 20 GROUP BY 1")
def r2_ordered_union(spark, sf_dir):
    """Union of two word lists in order of first appearance, blanks dropped, twenty kept."""
    both = A.union(F.split(F.left("text", F.lit(200)), " "), F.split(F.right("text", F.lit(200)), " "), 20)
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(both, " ").alias("u")).filter("u <> ''")


@query("r3_merge_image_hashes", "WITH e AS (SELECT user_id, event_id * 7 % 8 AS h, event_type AS d, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2, event_id) AS o FROM events), l AS (SELECT user_id, h, max_by(d, o) AS d, max(o) AS o FROM e GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o DESC) AS r FROM l) SELECT user_id, string_agg(CAST(h AS VARCHAR) || d, ',' ORDER BY o) AS merged FROM r WHERE r <= 5 GROUP BY 1")
def r3_merge_image_hashes(spark, sf_dir):
    """Two lists of hashes: each stays where it stands last, the newest five, oldest first."""
    e = read(spark, sf_dir, "events").select("user_id", "event_id", F.struct((F.col("event_id") * 7 % 8).alias("h"), F.col("event_type").alias("d")).alias("v"))
    of = lambda k: F.filter(A.list_in_order(F.when(F.col("event_id") % 2 == k, F.col("event_id")), F.when(F.col("event_id") % 2 == k, F.col("v"))), lambda x: x.isNotNull())
    lists = e.groupBy("user_id").agg(of(0).alias("a"), of(1).alias("b"))
    return lists.select("user_id", F.array_join(F.transform(A.merged_images(F.col("a"), F.col("b"), 5), lambda x: F.concat(x["h"].cast("string"), x["d"])), ",").alias("merged"))


@query("r5_concat_with_offset", "WITH x AS (SELECT doc_id, [lang, source] AS a, string_split(left(text, 40), ' ') AS b FROM documents) SELECT doc_id, unnest(a) AS w, generate_subscripts(a, 1) - 1 AS place FROM x UNION ALL SELECT doc_id, unnest(b) AS w, generate_subscripts(b, 1) - 1 + 1000000 AS place FROM x")
def r5_concat_with_offset(spark, sf_dir):
    """Both lists with their places, those of the second set off by a million."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.array("lang", "source").alias("a"), F.split(F.left("text", F.lit(40)), " ").alias("b"))
    placed = F.concat(F.transform("a", lambda w, i: F.struct(w.alias("w"), i.alias("place"))), F.transform("b", lambda w, i: F.struct(w.alias("w"), (i + 1_000_000).alias("place"))))
    return rows.select("doc_id", F.inline(placed))


@query("r6_contains_append", "WITH o AS (SELECT source, lang, doc_id, ['en', 'fr'] AS s FROM documents) SELECT doc_id, list_contains(s, lang) AS had, array_to_string(CASE WHEN list_contains(s, lang) THEN s ELSE list_append(s, lang) END, ',') AS outlets FROM o")
def r6_contains_append(spark, sf_dir):
    """An outlet enters a set unless it is there."""
    own = F.array(F.lit("en"), F.lit("fr"))
    had = F.array_contains(own, F.col("lang"))
    return read(spark, sf_dir, "documents").select("doc_id", had.alias("had"), F.array_join(F.when(had, own).otherwise(F.array_append(own, F.col("lang"))), ",").alias("outlets"))


@query("r7_json_unnest_build", "SELECT event_id, k AS key, json_extract_string(props, '$.\"' || k || '\"') AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) x")
def r7_json_unnest(spark, sf_dir):
    """JSON objects taken apart into keys and values."""
    rows = read(spark, sf_dir, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return rows


@query("r7_json_build", "SELECT user_id, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY 1")
def r7_json_build(spark, sf_dir):
    """Rows of a user built into one JSON array of objects, and read back."""
    lists = read(spark, sf_dir, "events").groupBy("user_id").agg(F.to_json(F.collect_list(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")))).alias("j"))
    back = lists.select("user_id", F.explode(F.from_json("j", "array<struct<id:bigint,type:string>>")).alias("x"))
    return back.groupBy("user_id").agg(F.count("*").alias("n"), F.min("x.id").alias("first"), F.max("x.id").alias("last"))


@query("r11_safe_entry", values([(1, '{"link":"https://a.example","published":"2026-01-05T00:00:00.000Z","tags":["x"]}'), (2, '{"link":null}')], "id, entry"))
def r11_safe_entry(spark, sf_dir):
    """An entry as JSON text; nested values stay, missing ones are left out but for the link."""
    rows = spark.createDataFrame([(1, "https://a.example", "2026-01-05", ["x"]), (2, None, None, None)], "id bigint, link string, published string, tags array<string>").withColumn("published", F.col("published").cast("timestamp"))
    whole = F.to_json(F.struct("link", "published", "tags"))
    return rows.select("id", F.when(F.col("link").isNull(), F.lit('{"link":null}')).otherwise(whole).alias("entry"))


@query("x36_usable_phash", "SELECT event_id, CASE WHEN (user_id - 3) IN (0, -1) THEN NULL ELSE user_id - 3 END AS phash, regexp_replace(lower(trim('  ' || event_type || '   Rate ')), '\\s+', ' ', 'g') AS entity FROM events")
def x36_usable_phash(spark, sf_dir):
    """Hashes of blank images are nulled; entity keys are lower-cased with single spaces."""
    h = F.col("user_id") - 3
    key = F.lower(F.regexp_replace(F.trim(F.concat(F.lit("  "), "event_type", F.lit("   Rate "))), r"(?U)\s+", " "))
    return read(spark, sf_dir, "events").select("event_id", F.when(~h.isin(0, -1), h).alias("phash"), key.alias("entity"))


@query("x40_catalogue_values", values([(1, True, 1.5, None, "hourly"), (2, True, None, "x", "unknown"), (3, False, -2.0, "y z", "daily"), (4, False, None, None, "unknown"), (5, True, 1000.0, "w", "realtime")], "id, flag, number, label, cadence"))
def x40_catalogue_values(spark, sf_dir):
    """Catalogue cells: truth words, numbers or null, blanks, cadences."""
    rows = [(1, " TRUE ", "1.5", "  ", "Hourly"), (2, "1", "n/a", " x", "weekly"), (3, "no", " -2 ", "y z", "daily"), (4, None, None, None, None), (5, "Yes", "1e3", "w", " realtime ")]
    df = spark.createDataFrame(rows, "id bigint, flag string, number string, label string, cadence string")
    cadence = F.lower(F.trim(F.coalesce("cadence", F.lit(""))))
    return df.select("id", F.coalesce(F.lower(F.trim("flag")).isin("true", "1", "yes", "t", "y"), F.lit(False)).alias("flag"), F.expr("try_cast(trim(number) as double)").alias("number"), F.nullif(F.trim("label"), F.lit("")).alias("label"), F.when(cadence.isin("realtime", "hourly", "daily"), cadence).otherwise("unknown").alias("cadence"))
