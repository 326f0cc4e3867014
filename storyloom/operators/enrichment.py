"""Queries of the enrichment rules over documents and embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storyloom.functions import enrich as E
from storyloom.functions import vectors as V
from storyloom.operators import entities as N
from storyloom.operators import heads
from storyloom.operators.stories import read
from storyloom.plans.cases import literal, values
from storyloom.plans.registry import query
from storyloom.plans.store import discard, materialize

#: title, description and body of an article: every seventh has no body, every fifth a long description.
_ART = r"""art AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, CASE doc_id % 5 WHEN 0 THEN left(text, 300) WHEN 1 THEN NULL WHEN 2 THEN ' &amp; short ' ELSE left(text, 90) END AS description, CASE WHEN doc_id % 7 = 0 THEN '  ' ELSE text END AS body FROM documents),
c AS (SELECT doc_id, title, regexp_replace(coalesce(body, ''), '^\s+|\s+$', '', 'g') AS b, regexp_replace(coalesce(description, ''), '^\s+|\s+$', '', 'g') AS d FROM art)"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    description = F.when(k == 0, F.left("text", F.lit(300))).when(k == 1, None).when(k == 2, " &amp; short ").otherwise(F.left("text", F.lit(90)))
    return read(spark, sf_dir, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("title"), description.alias("description"), F.when(F.col("doc_id") % 7 == 0, "  ").otherwise(F.col("text")).alias("body"), "source", "lang")


@query("x1_text_stats", rf"""WITH {_ART}, t AS (SELECT doc_id, CASE WHEN b <> '' THEN b ELSE d END AS t FROM c), w AS (SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE len(regexp_split_to_array(t, '\s+')) END AS n FROM t)
SELECT doc_id, CAST(n AS INTEGER) AS word_count, round(n / 200.0, 1) AS reading_mins FROM w""")  # fmt: skip
def x1_text_stats(spark, sf_dir):
    """Words and minutes of the body, or of the description where there is none.  Halves round up, as SQL has it."""
    text = E.richest(F.col("body"), F.col("description"))
    n = F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))
    return articles(spark, sf_dir).select("doc_id", n.alias("word_count"), F.round(n / 200.0, 1).alias("reading_mins"))


@query("x2_summary", rf"""WITH {_ART}, u AS (SELECT doc_id, replace(b, '&amp;', '&') AS b, replace(d, '&amp;', '&') AS d FROM c),
s AS (SELECT doc_id, b, d, list_filter(list_transform(string_split(regexp_replace(b, '([.!?।])\s+([A-Zऀ-ॿ؀-ۿ])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) >= 30)[1:3] AS g FROM u)
SELECT doc_id, left(CASE WHEN length(d) >= 150 THEN d WHEN b = '' THEN nullif(d, '') WHEN len(g) > 0 THEN array_to_string(g, ' ') ELSE b END, 500) AS summary FROM s""")  # fmt: skip
def x2_summary(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", E.summary(F.col("body"), F.col("description")).alias("summary"))


_LONG = "Ministers agreed on a plan for the coast. " * 12
_CASES = [
    (1, "Rain &amp; wind", "<b>Heavy</b> rain fell on the coast and the hills all day long", "Body.", "Rain & wind. Heavy rain fell on the coast and the hills all day long"), (2, "Rain stops play today!", "Rain stops play today, and more words than forty in it", "First sentence here. Second one.", "Rain stops play today! First sentence here. Second one."),
    (3, "Title", "short", _LONG, "Title. " + ("Ministers agreed on a plan for the coast. " * 7).strip()), (4, None, None, "Only body text.", "Only body text."), (5, "Alone", None, "Alone", "Alone"), (6, "", "", "", ""),
    (7, "T" * 10, None, "word " * 100, "T" * 10 + ". " + ("word " * 60).strip()), (8, "x" * 450, None, None, "x" * 400), (9, "Ends:", "A description that is longer than forty characters in all", None, "Ends: A description that is longer than forty characters in all"),
]


@query("x3_embedding_text", values([(k, text) for k, *_, text in _CASES], "id, text"))
def x3_embedding_text(spark, sf_dir):
    """Headline with description or lead: markup, repeated headlines, whole sentences, cuts at words."""
    rows = spark.createDataFrame([c[:4] for c in _CASES], "id bigint, title string, description string, body string")
    return E.embedding_text(rows, "text", F.col("title"), F.col("description"), F.col("body")).select("id", "text")


@query("x33_hashed_embeddings", r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(split_part(text, chr(10), 1)), '[\p{L}\p{N}_]+')) AS w FROM documents), h AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 4) AS INTEGER) % 64 AS place, CASE WHEN CAST('0x' || substr(md5(w), 5, 1) AS INTEGER) < 8 THEN 1 ELSE -1 END AS s FROM w),
v AS (SELECT doc_id, place, CAST(sum(s) AS DOUBLE) AS x FROM h GROUP BY 1, 2), n AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM v GROUP BY 1) SELECT v.doc_id, CAST(place AS INTEGER) AS place, round(x / n, 4) AS x FROM v JOIN n ON n.doc_id = v.doc_id WHERE x <> 0 AND n > 0""")  # fmt: skip
def x33_hashed_embeddings(spark, sf_dir):
    """The stand-in encoder over headlines; a headline without words, or whose words cancel out, has no vector."""
    rows = read(spark, sf_dir, "documents").select("doc_id", E.hashed_embedding(F.substring_index("text", "\n", 1)).alias("v"))
    return rows.select("doc_id", F.posexplode("v").alias("place", "x")).filter("x <> 0").select("doc_id", "place", F.round(F.col("x").cast("double"), 4).alias("x"))


_FRAMED = " OR ".join(f"contains(k, '{p}')" for p in E.NO_KEYWORDS)


@query("x26_keywords", rf"""WITH {_ART}, t AS (SELECT doc_id, title || chr(10) || chr(10) || left(CASE WHEN b <> '' THEN b ELSE d END, 3000) AS t, array_to_string(regexp_extract_all(lower(title), '[\p{{L}}\p{{N}}]+'), ' ') AS head FROM c),
w AS (SELECT doc_id, head, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') AS w FROM t WHERE length(regexp_replace(t, '^\s+|\s+$', '', 'g')) >= 30),
p AS (SELECT doc_id, head, unnest(w) AS k, 1 AS n FROM w UNION ALL SELECT doc_id, head, unnest(list_transform(range(1, len(w)), lambda i: CASE WHEN length(w[i]) >= 3 AND length(w[i + 1]) >= 3 THEN w[i] || ' ' || w[i + 1] END)) AS k, 2 AS n FROM w),
s AS (SELECT doc_id, k, count(*) * n * CASE WHEN contains(' ' || head || ' ', ' ' || k || ' ') THEN 2 ELSE 1 END AS s FROM p WHERE length(k) >= 3 GROUP BY doc_id, k, n, head HAVING NOT ({_FRAMED})),
r AS (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, k COLLATE C) AS place FROM s) SELECT doc_id, CAST(place AS INTEGER) AS place, k AS keyword FROM r WHERE place <= 10""".replace(" COLLATE C", ""))  # fmt: skip
def x26_keywords(spark, sf_dir):
    return E.keywords(articles(spark, sf_dir), "doc_id", F.col("title"), F.col("body"), F.col("description"))


# ------------------------------------------------------------------ mentions and entities
_MENTIONS = r"""g AS (SELECT lower(n_name) AS low, 'GPE' AS type FROM nation UNION SELECT * FROM (VALUES ('the', 'EVENT'), ('that', 'GPE'), ('this', 'ORG'), ('with', 'GPE'), ('and', 'ORG'), ('der', 'GPE'), ('les', 'GPE'), ('que', 'ORG')) AS k(low, type)), r AS (SELECT doc_id, regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*') AS rs FROM documents),
m0 AS (SELECT doc_id, unnest(rs) AS t, generate_subscripts(rs, 1) AS position FROM r), m AS (SELECT doc_id AS article_id, position, t, coalesce(g.type, CASE WHEN regexp_matches(t, ' (Ltd|Inc|Corp|Party|Bank|Court)$') THEN 'ORG' WHEN contains(t, ' ') THEN 'PERSON' END) AS type FROM m0 LEFT JOIN g ON g.low = lower(t)),
o AS (SELECT article_id, lower(t) AS key, count(*) AS n, min_by(t, position) AS txt, min_by(type, position) AS type, min(position) AS position FROM m WHERE type IS NOT NULL AND length(t) >= 2 GROUP BY 1, 2),
s AS (SELECT o.*, least(round(CASE WHEN contains(lower(split_part(d.text, chr(10), 1)), key) THEN 0.5 ELSE 0 END + CASE WHEN contains(lower(left(d.text, 200)), key) THEN 0.3 ELSE 0 END + least(n * 0.1, 0.3), 2), 1.0) AS salience FROM o JOIN documents d ON d.doc_id = o.article_id),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY salience DESC, position) AS k FROM s WHERE salience >= 0.1) x WHERE k <= 30)"""


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    places = read(spark, sf_dir, "nation").select(F.col("n_name").alias("text"), F.lit("GPE").alias("type")).unionByName(spark.createDataFrame([("The", "EVENT"), ("That", "GPE"), ("This", "ORG"), ("With", "GPE"), ("And", "ORG"), ("Der", "GPE"), ("Les", "GPE"), ("Que", "ORG")], "text string, type string"))
    m = E.mentions(d, "doc_id", F.col("text"), places)
    return N.entities(m, d.select(F.col("doc_id").alias("article_id"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("body")))


@query("x27_entities", f"WITH {_MENTIONS} SELECT article_id, txt AS entity_text, type AS entity_type, salience FROM e")
def x27_entities(spark, sf_dir):
    """Mentions by form and gazetteer, scored by place and count, the best thirty of an article."""
    return found(spark, sf_dir).select("article_id", "entity_text", "entity_type", "salience")


_STOP = literal(list(N.STOP))


@query("f9_evidence", f"WITH {_MENTIONS}, v AS (SELECT article_id, key, salience, k FROM e WHERE salience >= 0.3 AND type IN ('PERSON', 'ORG', 'GPE', 'EVENT', 'LAW', 'PRODUCT') AND NOT list_contains({_STOP}, key)), p AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY salience DESC, k) AS r FROM v) SELECT article_id, array_to_string(list(key ORDER BY r), ',') AS keys FROM p WHERE r <= 15 GROUP BY 1")
def f9_evidence(spark, sf_dir):
    return N.evidence(found(spark, sf_dir), list(N.STOP)).select("article_id", F.array_join("keys", ",").alias("keys"))


@query("r9_top_entities", f"WITH {_MENTIONS} SELECT article_id, CAST(k AS INTEGER) AS place, txt AS text, type FROM e WHERE k <= 10")
def r9_top_entities(spark, sf_dir):
    """What a cluster gets of an article: its ten most salient entities, ties in order of appearance."""
    return found(spark, sf_dir).filter("k <= 10").select("article_id", F.col("k").alias("place"), F.col("entity_text").alias("text"), F.col("entity_type").alias("type"))


@query("r10_regions_and_orgs", f"WITH {_MENTIONS}, q AS (SELECT article_id, type, key, row_number() OVER (PARTITION BY article_id, type ORDER BY k) AS r FROM e WHERE type IN ('GPE', 'ORG')) SELECT article_id, array_to_string(coalesce(list(key ORDER BY r) FILTER (type = 'GPE'), []), ',') AS regions, array_to_string(coalesce(list(key ORDER BY r) FILTER (type = 'ORG'), []), ',') AS orgs FROM q WHERE r <= 5 GROUP BY 1")
def r10_regions_and_orgs(spark, sf_dir):
    """The first five places and organisations of an article, in lower case, by salience."""
    rows = found(spark, sf_dir).filter(F.col("entity_type").isin("GPE", "ORG"))
    of = lambda t: F.slice(F.transform(F.sort_array(F.collect_list(F.when(F.col("entity_type") == t, F.struct("k", F.lower("entity_text").alias("e"))))), lambda x: x["e"]), 1, 5)
    return rows.groupBy("article_id").agg(F.array_join(of("GPE"), ",").alias("regions"), F.array_join(of("ORG"), ",").alias("orgs"))


@query("w1_entity_ranks", f"WITH {_MENTIONS} SELECT article_id, txt AS entity_text, CAST(row_number() OVER (PARTITION BY article_id ORDER BY CASE WHEN position % 4 = 0 THEN NULL ELSE salience END DESC NULLS LAST, key) AS INTEGER) AS rn FROM e QUALIFY rn <= 10")
def w1_entity_ranks(spark, sf_dir):
    """Rank of entities in their article, those without salience last."""
    rows = found(spark, sf_dir).withColumn("salience", F.when((F.col("at") + 1) % 4 == 0, None).otherwise(F.col("salience")))
    rank = F.row_number().over(W.partitionBy("article_id").orderBy(F.desc_nulls_last("salience"), F.lower("entity_text")))
    return rows.withColumn("rn", rank).filter("rn <= 10").select("article_id", "entity_text", "rn")


# ------------------------------------------------------------------ scores and heads
@query("x28_sentiment_rule", """WITH p AS (SELECT event_id, value / 300.0 AS pos, event_id % 100 / 150.0 AS neg FROM events)
SELECT event_id, CASE WHEN pos >= 0.4 THEN 'positive' WHEN neg >= 0.4 THEN 'negative' ELSE 'neutral' END AS sentiment, round(pos - neg, 4) AS score, round(pos * 100, 2) AS positive, round((1 - pos) / 7 * 100, 2) AS neutral, round(neg * 100, 2) AS negative FROM p""")  # fmt: skip
def x28_sentiment_rule(spark, sf_dir):
    """Label, score and percentages from class probabilities, which a model gives elsewhere."""
    pos, neg = F.col("value") / 300.0, F.col("event_id") % 100 / 150.0
    return read(spark, sf_dir, "events").select("event_id", E.sentiment(pos, (1 - pos) / 7, neg).alias("s")).select("event_id", "s.*")


def scores() -> Column:
    """A map of label scores of an article."""
    part = lambda c, m: (c % m) / float(m)
    return F.create_map(F.lit("politics"), part(F.col("n_chars"), 10), F.lit("sports"), part(F.col("doc_id"), 10), F.lit("cricket"), part(F.col("doc_id"), 7), F.lit("health"), part(F.col("doc_id") + F.col("n_chars"), 9))


_SCORES = "s AS (SELECT doc_id, unnest(['politics', 'sports', 'cricket', 'health']) AS k, unnest([n_chars % 10 / 10.0, doc_id % 10 / 10.0, doc_id % 7 / 7.0, (doc_id + n_chars) % 9 / 9.0]) AS v, unnest([0, 1, 2, 3]) AS i FROM documents)"


@query("x29_pick_category", f"WITH {_SCORES}, b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY v DESC, i) AS r, max(v) FILTER (k = 'cricket') OVER (PARTITION BY doc_id) AS c FROM s) SELECT doc_id, CASE WHEN v < 0.3 THEN 'general' WHEN k = 'sports' AND c >= 0.5 THEN 'cricket' ELSE k END AS category FROM b WHERE r = 1")
def x29_pick_category(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", N.pick_category(scores()).alias("category"))


@query("x30_classify_tags", f"WITH {_SCORES}, r AS (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY v DESC, k) AS r FROM s WHERE v >= 0.35) SELECT doc_id, array_to_string(list(k ORDER BY r), ',') AS tags FROM r WHERE r <= 5 GROUP BY 1 UNION ALL SELECT doc_id, '' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r)")
def x30_classify_tags(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(N.pick_tags(scores()), ",").alias("tags"))


ENCODER = "test-64"


def label_head(vectors: DataFrame) -> E.Head:
    """A head made of label means: ten labels, so what reaches the driver is a fixed table."""
    sums = {r["label"]: [x * 8 / r["n"] for x in r["sum"]] for r in V.vector_sum(vectors, ["label"], "embedding").collect()}
    labels = sorted(sums)
    return E.Head([str(k) for k in labels], [sums[k] for k in labels], [k / 50 for k in labels], ENCODER, [0.5 + k / 100 for k in labels])


_HEAD = """p AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), w AS (SELECT label, i, sum(x) * 8 / (SELECT count(*) FROM embeddings e WHERE e.label = p.label) AS w FROM p GROUP BY label, i),
z AS (SELECT p.vec_id, w.label, sum(p.x * w.w) + w.label / 50.0 AS z FROM p JOIN w ON w.i = p.i GROUP BY 1, 2)"""


@query("x31_category_head", f"WITH {_HEAD}, q AS (SELECT vec_id, label, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z), t AS (SELECT vec_id, label, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM q) SELECT vec_id, CAST(arg_max(label, round(p, 12) * 1000000000 - label) AS VARCHAR) AS category, round(max(p), 6) AS confidence FROM t GROUP BY 1")
def x31_category_head(spark, sf_dir):
    """Softmax of W x + b over blocks of vectors; the largest class and its probability."""
    e = read(spark, sf_dir, "embeddings")
    return label_head(e).category(e, "vec_id", "embedding", ENCODER).select("vec_id", "category", F.round("confidence", 6).alias("confidence"))


@query("x32_tag_head", f"WITH {_HEAD}, s AS (SELECT vec_id, label, 1 / (1 + exp(-z)) AS p FROM z), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, label) AS place FROM s WHERE p >= 0.5 + label / 100.0) SELECT vec_id, CAST(place AS INTEGER) AS place, CAST(label AS VARCHAR) AS tag, round(p, 6) AS p FROM r WHERE place <= 3")
def x32_tag_head(spark, sf_dir):
    """Sigmoid of W x + b for each tag against its own threshold, best first, three at most."""
    e = read(spark, sf_dir, "embeddings")
    return label_head(e).tags(e, "vec_id", "embedding", ENCODER).select("vec_id", "place", "tag", F.round("p", 6).alias("p"))


@query("m1_train_heads", "SELECT 'tag' AS head, CAST(label AS VARCHAR) AS name FROM embeddings WHERE label < 3 GROUP BY 2 HAVING count(*) >= 3 UNION ALL SELECT 'category', 'all'")
def m1_train_heads(spark, sf_dir):
    """A tag head by one-vs-rest and a category head, folds by publisher; only what was trained is compared, figures are tested on made data."""
    e = read(spark, sf_dir, "embeddings")
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source")
    rows = e.join(d, "vec_id", "left").select(F.col("vec_id").alias("id"), F.coalesce("source", F.lit("?")).alias("group"), F.col("embedding").alias("vector"), F.array(F.col("label").cast("string")).alias("tags"), F.col("label").cast("string").alias("label"))
    rows = materialize(rows, "examples")
    _, tags = heads.train_tags(rows, ["0", "1", "2"], ENCODER)
    heads.train_category(rows, [str(k) for k in range(10)], ENCODER)
    discard(rows)
    return spark.createDataFrame([("tag", t) for t in tags] + [("category", "all")], "head string, name string")
