"""Queries of sinks, feed state, queue and archive, over the driver's tables and hand-made rows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import records as R
from storyloom.operators.stories import read
from storyloom.plans.cases import values
from storyloom.plans.model import NOW, run_sql, with_roles
from storyloom.plans.registry import query
from storyloom.plans.store import shared_dir
from storyloom.sources import archive as X

DAY = 86_400


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ feed polls
_POLLED = "p AS (SELECT f.*, id % 50 <> 49 AS polled, id % 3 <> 0 AS success, id % 5 AS new_articles, id % 16 = 7 AS reactivate, id % 10 = 1 AS dormant, CASE WHEN id % 3 <> 0 THEN 0 ELSE fail_count + 1 END AS fails FROM feeds f)"


@query("f3_feed_transition", with_roles(f"""WITH {_POLLED}, o AS (SELECT *, CASE WHEN success AND reactivate THEN 'up' WHEN NOT success AND fails >= 5 THEN 'err' WHEN success AND dormant THEN 'dorm' ELSE 'same' END AS o FROM p)
SELECT id, CASE WHEN polled THEN fails ELSE fail_count END AS fail_count, CASE WHEN polled THEN {NOW} ELSE last_polled_at END AS last_polled_at, CASE WHEN polled AND success THEN {NOW} ELSE last_polled_at END AS last_success_at, CASE WHEN polled THEN polls + new_articles ELSE polls END AS articles_found,
  CASE WHEN polled AND success AND new_articles > 0 THEN {NOW} ELSE last_new_article_at END AS last_new_article_at, CASE WHEN polled THEN CASE o WHEN 'up' THEN true WHEN 'err' THEN false WHEN 'dorm' THEN false ELSE is_active END ELSE is_active END AS is_active,
  CASE WHEN polled THEN CASE o WHEN 'up' THEN NULL WHEN 'err' THEN 'errors' WHEN 'dorm' THEN 'dormant' ELSE disabled_reason END ELSE disabled_reason END AS disabled_reason FROM o"""))  # fmt: skip
def f3_feed_transition(spark, sf_dir):
    """Polls of most feeds, recorded in one pass (K2 and F3 are one operator)."""
    feeds = run_sql(spark, sf_dir, "SELECT id, fail_count, last_polled_at, last_polled_at AS last_success_at, polls AS articles_found, last_new_article_at, is_active, disabled_reason FROM feeds")
    polls = feeds.filter("id % 50 <> 49").select(F.col("id").cast("string").alias("id"), F.expr("id % 3 <> 0").alias("success"), F.expr("id % 5").alias("new_articles"), F.expr("id % 16 = 7").alias("reactivate"), F.expr("id % 10 = 1").alias("dormant"))
    return R.polled(feeds, polls, NOW)


@query("k2_record_polls", values([(1, 0, 100, 100, 7, 100, True, None), (2, 5, 100, 1, 3, 2, False, "errors"), (3, 0, 100, 100, 3, 2, False, "dormant"), (4, 1, 100, 1, 3, 2, True, None), (5, 3, 1, 1, 3, 2, False, "dormant")], "id, fail_count, last_polled_at, last_success_at, articles_found, last_new_article_at, is_active, disabled_reason"))
def k2_record_polls(spark, sf_dir):
    """Reactivated with articles, failed out, dormant, a poll without flags counts as failed, not polled at all."""
    feeds = [(1, 2, 1, 1, 3, 2, False, "dormant"), (2, 4, 1, 1, 3, 2, True, None), (3, 0, 1, 1, 3, 2, True, None), (4, 0, 1, 1, 3, 2, True, None), (5, 3, 1, 1, 3, 2, False, "dormant")]
    polls = [("1", True, 4, True, None), ("2", False, 0, None, True), ("3", True, None, False, True), ("4", None, None, None, None), ("9", True, 1, None, None)]
    f = spark.createDataFrame(feeds, "id bigint, fail_count bigint, last_polled_at bigint, last_success_at bigint, articles_found bigint, last_new_article_at bigint, is_active boolean, disabled_reason string")
    return R.polled(f, spark.createDataFrame(polls, "id string, success boolean, new_articles bigint, reactivate boolean, dormant boolean"), 100)


@query("f4_dormancy", with_roles(f"SELECT id, CAST(({NOW} - coalesce(CASE WHEN id % 9 <> 0 THEN last_new_article_at END, {NOW} - id % 70 * {DAY} - 3600)) // {DAY} AS BIGINT) AS idle_days, ({NOW} - coalesce(CASE WHEN id % 9 <> 0 THEN last_new_article_at END, {NOW} - id % 70 * {DAY} - 3600)) // {DAY} >= 30 AS dormant FROM feeds"))
def f4_dormancy(spark, sf_dir):
    """Whole days since the last new article, or since creation where there never was one."""
    feeds = run_sql(spark, sf_dir, f"SELECT id, CASE WHEN id % 9 <> 0 THEN last_new_article_at END AS last_new_article_at, {NOW} - id % 70 * {DAY} - 3600 AS created_at FROM feeds")
    days = F.floor((F.lit(NOW) - F.coalesce("last_new_article_at", "created_at")) / DAY)
    return feeds.select("id", days.alias("idle_days"), (days >= 30).alias("dormant"))


# ------------------------------------------------------------------ enrichment writes
_UPDATE = "struct<" + ",".join(f"{c}:{'bigint' if c == 'word_count' else 'array<string>' if c == 'keywords' else 'string'}" for c in R.ENRICHED) + ">"
_CRAWL = "struct<title:string,description:string,top_image_url:string,author:string,published_at:bigint,is_crawled:boolean>"
ITEMS = f"id bigint, update {_UPDATE}, crawl {_CRAWL}, entities array<struct<text:string,type:string,salience:double>>, entity_keys array<string>"
ARTICLES = "id bigint, title string, description string, top_image_url string, author string, published_at bigint, is_crawled boolean, cluster_id bigint, word_count bigint, language_detected string, sentiment string, category string, ai_summary string, keywords array<string>, enrich_error string, enriched_at bigint"


def enrichment(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(articles, items): a whole save, a save with a late crawl, an item whose article does not exist, an article without an item."""
    base = ("old", "i.png", "who", None, False)
    articles = [(1, "Kept", *base, 7, 1, "xx", None, "old", None, ["k"], "boom", None), (2, "", *base, 7, None, None, None, None, None, None, None, None), (3, "Other", *base, None, 5, "en", None, None, None, None, "err", None)]
    items = [
        (1, (120, "en", "neutral", "sports", "sum", ["a", "b"]), None, [("Delhi", "GPE", 0.9), ("BCCI", "ORG", 0.4)], ["delhi", "bcci"]),
        (2, (60, "hi", None, None, None, None), ("From page", "d" * 2100, None, "Author", 77, True), [("delhi", "GPE", 0.5)], ["delhi"]), (9, (1, None, None, None, None, None), None, [("X", "ORG", 1.0)], ["x"]),
    ]
    return spark.createDataFrame(articles, ARTICLES), spark.createDataFrame(items, ITEMS)


@query("k6_saved_articles", values([(1, "Kept", 3, "i.png", "who", None, False, 120, "en", "neutral", "sports", "sum", "a,b", None, 1000), (2, "From page", 2000, "i.png", "Author", 77, True, 60, "hi", None, None, None, None, None, 1000), (3, "Other", 3, "i.png", "who", None, False, 5, "en", None, None, None, None, "err", None)],
    "id, title, description_chars, top_image_url, author, published_at, is_crawled, word_count, language_detected, sentiment, category, ai_summary, keywords, enrich_error, enriched_at"))
def k6_saved_articles(spark, sf_dir):
    articles, items = enrichment(spark)
    out = R.saved(articles, items, 1000).withColumn("description_chars", F.length("description")).withColumn("keywords", F.array_join("keywords", ","))
    return out.drop("description", "cluster_id")


@query("k6_replaced_entities", values([(1, "Delhi", "GPE", 0.9), (1, "BCCI", "ORG", 0.4), (2, "delhi", "GPE", 0.5), (3, "Stays", "ORG", 0.3)], "article_id, text, type, salience"))
def k6_replaced_entities(spark, sf_dir):
    articles, items = enrichment(spark)
    old = spark.createDataFrame([(1, "Old", "ORG", 0.8), (3, "Stays", "ORG", 0.3)], "article_id bigint, text string, type string, salience double")
    return R.replaced_entities(old, items, articles)


@query("k6_story_tallies", values([(7, "old,bcci,delhi", "Delhi:3,BCCI:1"), (8, "z", "Z:1")], "cluster_id, entity_set, entities"))
def k6_story_tallies(spark, sf_dir):
    articles, items = enrichment(spark)
    stories = spark.createDataFrame([(7, "active", ["old"], [("Delhi", "GPE", 1)]), (8, "active", ["z"], [("Z", "ORG", 1)])], "cluster_id bigint, status string, entity_set array<string>, top_entities array<struct<text:string,type:string,count:bigint>>")
    tally = F.array_join(F.transform("top_entities", lambda e: F.concat(e["text"], F.lit(":"), e["count"].cast("string"))), ",")
    return R.tallied(stories, items, articles).select("cluster_id", F.array_join("entity_set", ",").alias("entity_set"), tally.alias("entities"))


@query("k9_single_save", values([(2, "From page", 60)], "id, title, word_count"))
def k9_single_save(spark, sf_dir):
    """A save of one article is a batch of one."""
    articles, items = enrichment(spark)
    return R.saved(articles, items.filter("id = 2"), 1000).filter("enriched_at is not null").select("id", "title", "word_count")


@query("q3_mark_failed", with_roles("SELECT id, CASE WHEN id % 10 = 3 THEN left('error: ' || title || repeat('x', 1000), 1000) END AS enrich_error FROM articles WHERE enriched_at IS NULL"))
def q3_mark_failed(spark, sf_dir):
    rows = run_sql(spark, sf_dir, "SELECT id, title, CAST(NULL AS STRING) AS enrich_error FROM articles WHERE enriched_at IS NULL")
    errors = rows.filter("id % 10 = 3").select("id", F.concat(F.lit("error: "), F.col("title"), F.repeat(F.lit("x"), F.lit(1000))).alias("error"))
    return R.failed(rows, errors).select("id", "enrich_error")


@query("q4_sweeper", with_roles(f"""WITH c AS (SELECT a.id, enrich_attempts, l.quality = 1 AS saved FROM articles a LEFT JOIN labels l ON l.doc_id = a.id WHERE enriched_at IS NULL AND crawled_at <= {NOW - 6 * 3600} AND (enrich_claimed_at IS NULL OR enrich_claimed_at < {NOW - 150 * 60}) AND enrich_attempts < 10)
SELECT id, CASE WHEN coalesce(saved, false) THEN 'saved' WHEN enrich_attempts + 1 >= 10 THEN 'dead letter' ELSE 'released' END AS outcome, CASE WHEN coalesce(saved, false) OR enrich_attempts + 1 >= 10 THEN enrich_attempts + 1 ELSE enrich_attempts END AS attempts FROM c"""))  # fmt: skip
def q4_sweeper(spark, sf_dir):
    """A sweep whose good texts (by their label) are saved."""
    queue = run_sql(spark, sf_dir, "SELECT id, enriched_at, crawled_at, enrich_claimed_at, enrich_attempts FROM articles")
    done = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("saved"))
    return R.swept(queue, done, NOW, 6 * 3600, 150 * 60)


# ------------------------------------------------------------------ catalogue, runs, coverage
@query("k10_catalogue_upsert", values([(4, "https://n.example", "https://final.example", 9), (6, "https://six.example", "https://six.example", 1)], "row, url, final, priority"))
def k10_catalogue_upsert(spark, sf_dir):
    """Best row of a URL wins; rows whose URL or final URL is stored under either name are conflicts."""
    schema = "row bigint, url string, final string, priority bigint"
    rows = [(1, "https://a.example", "https://a.example", 5), (2, "https://b.example", "https://old.example", 5), (3, "https://n.example", "https://n.example", 3), (4, "https://n.example", "https://final.example", 9), (5, "https://moved.example", "https://x.example", 2), (6, "https://six.example", "https://six.example", 1)]
    stored = [(0, "https://a.example", "https://moved.example", 0), (0, "https://old.example", "https://old.example", 0)]
    return R.catalogue_new(spark.createDataFrame(rows, schema), spark.createDataFrame(stored, schema), ["url", "final"], [F.desc("priority"), F.col("row")])


@query("k11_run_log", values([(1, "done", 100, 5), (2, "done", 200, 7), (3, "running", 300, None)], "run_id, status, started_at, new_articles"))
def k11_run_log(spark, sf_dir):
    """Two phases: starts open rows, finishes complete them; a column that the log does not have is left out."""
    log = spark.createDataFrame([(1, "done", 100, 5)], "run_id bigint, status string, started_at bigint, new_articles bigint")
    started = spark.createDataFrame([(2, "running", 200, "extra"), (3, "running", 300, "extra")], "run_id bigint, status string, started_at bigint, host string")
    finished = spark.createDataFrame([(2, "done", 7, "gone")], "run_id bigint, status string, new_articles bigint, detail string")
    return R.run_log(log, started, finished)


@query("k12_coverage_upsert", """WITH o AS (SELECT o_orderkey % 20 AS day, o_orderstatus AS domain, count(*) AS n FROM orders WHERE o_orderkey % 20 < 15 GROUP BY 1, 2), w AS (SELECT o_orderkey % 20 AS day, o_orderstatus AS domain, count(*) AS n FROM orders WHERE o_orderkey % 20 >= 10 AND o_orderstatus <> 'P' GROUP BY 1, 2)
SELECT * FROM w UNION ALL SELECT * FROM o WHERE day < 10""")  # fmt: skip
def k12_coverage_upsert(spark, sf_dir):
    """Days 0 to 14 stand, days 10 to 19 come again: whole days are replaced, the others stay."""
    rows = read(spark, sf_dir, "orders").withColumn("day", F.col("o_orderkey") % 20)
    root = folder(spark, "coverage")
    count = lambda df: df.groupBy(F.col("o_orderstatus").alias("domain"), "day").agg(F.count("*").alias("n"))
    R.write_coverage(count(rows.filter("day < 15")), root)
    R.write_coverage(count(rows.filter("day >= 10 and o_orderstatus <> 'P'")), root)
    return spark.read.schema("domain string, n bigint, day bigint").parquet(root)


@query("k12_coverage_keys", values([(1, "a", 5), (1, "b", 2), (2, "a", 9)], "day, domain, n"))
def k12_coverage_keys(spark, sf_dir):
    """The same by (day, domain), row by row."""
    old, new = (spark.createDataFrame(r, "day bigint, domain string, n bigint") for r in ([(1, "a", 1), (1, "b", 2)], [(1, "a", 5), (2, "a", 9)]))
    return R.upserted(old, new, ["day", "domain"])


# ------------------------------------------------------------------ hand-off, bodies, types
@query("k3_handoff", "SELECT doc_id AS id, left(text, 300) AS full_text, doc_id % 7 = 0 AS paywalled, (SELECT count(*) FROM documents WHERE doc_id % 5 <> 0) AS written, (SELECT count(*) FROM documents WHERE doc_id % 5 = 0) AS unmatched FROM documents WHERE doc_id % 5 <> 0")
def k3_handoff(spark, sf_dir):
    """Inserted rows meet their bodies by hash, go to gzipped JSON lines and come back; rows without a body are counted."""
    d = read(spark, sf_dir, "documents")
    inserted = d.select(F.col("doc_id").alias("id"), (F.col("doc_id") * 31).alias("url_hash"))
    crawled = d.filter("doc_id % 5 <> 0").select((F.col("doc_id") * 31).alias("url_hash"), F.col("text").alias("full_text"), F.when(F.col("doc_id") % 7 == 0, True).alias("paywalled"))
    rows, counts = X.matched(inserted, crawled)
    root = folder(spark, "handoff")
    X.write_handoff(rows, root, most=300)
    from storyloom.sources.feeds import read_handoff

    return read_handoff(spark, root, "id bigint, url_hash bigint, full_text string, paywalled boolean").drop("url_hash").crossJoin(counts)  # one row of counts


@query("k4_body_store", "SELECT doc_id AS id, left(text, 50) AS body, strftime(make_timestamp((1767571200 - doc_id % 997 * 600) * 1000000), '%Y/%m/%d') AS folder FROM documents")
def k4_body_store(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.left("text", F.lit(50)).alias("body"), F.timestamp_seconds(1767571200 - F.col("doc_id") % 997 * 600).alias("at"))
    root = folder(spark, "bodies")
    X.write_bodies(d, root, "at")
    return X.read_bodies(spark, root, "id bigint, body string").select("id", "body", F.concat_ws("/", "year", "month", "day").alias("folder"))


@query("k5_archive_types", values([("big", "bigint"), ("crawled_at", "timestamp"), ("flag", "boolean"), ("list", "string"), ("mixed", "double"), ("nested", "string"), ("price", "double"), ("small", "bigint"), ("text", "string")], "name, type"))
def k5_archive_types(spark, sf_dir):
    """Types as the archive stores them, read back from its files."""
    src = spark.range(2).selectExpr("id as big", "'2026-01-01 00:00:00' as crawled_at", "id = 1 as flag", "array(1, 2) as list", "cast(id as float) as mixed", "named_struct('a', 1) as nested", "cast(1.5 as decimal(5, 2)) as price", "cast(1 as smallint) as small", "'x' as text")
    root = folder(spark, "types")
    X.write_parquet(src, root)
    return spark.createDataFrame(sorted(spark.read.parquet(root).dtypes), "name string, type string")


# ------------------------------------------------------------------ archive
def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.left("text", F.lit(40)).alias("title"), F.timestamp_seconds(NOW - F.col("doc_id") % 997 * 600).alias("crawled_at"), (F.col("doc_id") % 400 == 7).alias("waiting"))


_DATED = f"d AS (SELECT doc_id AS id, CAST(make_timestamp(({NOW} - doc_id % 997 * 600) * 1000000) AS DATE) AS day, doc_id % 400 = 7 AS waiting FROM documents)"
TODAY = dt.datetime.fromtimestamp(NOW, dt.timezone.utc).date().isoformat()


@query("v1_export_days", f"WITH {_DATED} SELECT CAST(day AS VARCHAR) AS day, count(*) AS rows, min(id) AS min_id, max(id) AS max_id, 'uploaded' AS status, count(*) AS in_parts FROM d GROUP BY day")
def v1_export_days(spark, sf_dir):
    log = X.export_days(dated(spark, sf_dir).drop("waiting"), folder(spark, "archive"), "crawled_at")
    return log.select(F.col("day").cast("string").alias("day"), "rows", "min_id", "max_id", "status", F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + p["rows"]).alias("in_parts"))


@query("v2_verify_days", f"WITH {_DATED}, n AS (SELECT day, row_number() OVER (ORDER BY day) AS k FROM (SELECT DISTINCT day FROM d) x) SELECT CAST(day AS VARCHAR) AS day, CASE WHEN k IN (1, 2, 3) THEN 'broken' ELSE 'verified' END AS status, CASE k WHEN 1 THEN 'checksum mismatch' WHEN 2 THEN 'id range differs' WHEN 3 THEN 'the table has changed' END AS reason FROM n")
def v2_verify_days(spark, sf_dir):
    """Of the days the first has another checksum in its log, the second another id range, the third has lost a row of the table since."""
    rows, root = dated(spark, sf_dir).drop("waiting"), folder(spark, "archive")
    log = spark.createDataFrame(X.export_days(rows, root, "crawled_at").collect(), X.LOG)
    one, two, three = [r["day"] for r in log.select("day").orderBy("day").limit(3).collect()]
    spoiled = F.transform("parts", lambda p: F.struct(p["path"].alias("path"), p["rows"].alias("rows"), p["bytes"].alias("bytes"), F.lit("0").alias("sha256")))
    log = log.withColumn("parts", F.when(F.col("day") == F.lit(one), spoiled).otherwise(F.col("parts"))).withColumn("max_id", F.when(F.col("day") == F.lit(two), F.col("max_id") + 1).otherwise(F.col("max_id")))
    lost = rows.filter(F.to_date("crawled_at") == F.lit(three)).agg(F.min("id")).first()[0]
    return X.verify_days(log, root, rows.filter(F.col("id") != lost), "crawled_at").withColumn("day", F.col("day").cast("string"))


@query("v3_prune_verdicts", values([("2026-01-01", "prune"), ("2026-01-02", "not verified"), ("2026-01-03", "changed since export"), ("2026-01-04", "already pruned"), ("2026-01-20", "inside the hot window")], "day, verdict"))
def v3_prune_verdicts(spark, sf_dir):
    d = dt.date
    log = spark.createDataFrame([(d(2026, 1, 1), 2, 1, 2, [], "verified", 0), (d(2026, 1, 2), 1, 3, 3, [], "uploaded", 0), (d(2026, 1, 3), 5, 4, 9, [], "verified", 1), (d(2026, 1, 4), 1, 1, 1, [], "pruned", 1), (d(2026, 1, 20), 1, 7, 7, [], "verified", 0)], X.LOG)
    table = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-01"), (3, "2026-01-02"), (4, "2026-01-03"), (7, "2026-01-20")], "id bigint, at string").withColumn("at", F.col("at").cast("timestamp"))
    return X.prune_verdicts(log, table, "at", "2026-01-21", 14).withColumn("day", F.col("day").cast("string"))


@query("v5_run_archive", f"WITH {_DATED}, w AS (SELECT day, bool_or(waiting) AS waiting, row_number() OVER (ORDER BY day) AS k FROM d GROUP BY day) SELECT id FROM d JOIN w ON w.day = d.day WHERE d.day >= DATE '{TODAY}' - 3 OR w.waiting OR w.k = 1")
def v5_run_archive(spark, sf_dir):
    """What is left after a run: hot days, days with rows not done yet, and the first day, whose step fails without stopping the others."""
    rows = dated(spark, sf_dir)
    first = rows.agg(F.min(F.to_date("crawled_at"))).first()[0]

    def step(day: str) -> None:
        if first and day == first.isoformat():
            raise OSError("store not reachable")

    left, _, _ = X.run_archive(rows, spark.createDataFrame([], X.LOG), folder(spark, "archive"), "crawled_at", TODAY, hot_days=3, waiting=F.col("waiting"), step=step)
    return left.select("id")


@query("s15_archive_range", f"WITH {_DATED} SELECT id, CAST(day AS VARCHAR) AS day FROM d WHERE day BETWEEN DATE '{TODAY}' - 3 AND DATE '{TODAY}' - 2")
def s15_archive_range(spark, sf_dir):
    """A range of days read back from the archive; only their folders are listed."""
    root, today = folder(spark, "archive"), dt.date.fromisoformat(TODAY)
    X.export_days(dated(spark, sf_dir).drop("waiting"), root, "crawled_at")
    return X.read_days(spark, root, (today - dt.timedelta(3)).isoformat(), (today - dt.timedelta(2)).isoformat()).select("id", F.col("day").cast("string").alias("day"))


@query("s12_catalogue_csv", values([("1", "https://a.example", None), ("2", "https://b.example", "hourly")], "id, url, cadence"))
def s12_catalogue_csv(spark, sf_dir):
    """The feed catalogue as CSV: trimmed, blanks null."""
    from storyloom.sources.feeds import read_catalogue

    root = folder(spark, "catalogue")
    spark.createDataFrame([("id,url,cadence",), ("1, https://a.example ,  ",), ("2,https://b.example,hourly",)], "value string").coalesce(1).write.text(root)
    return read_catalogue(spark, root)


@query("s13_read_handoff", "SELECT doc_id AS id, lang FROM documents WHERE doc_id % 3 <> 2")
def s13_read_handoff(spark, sf_dir):
    """Hand-off files in nested folders, as shards leave them."""
    from storyloom.sources.feeds import read_handoff

    root, d = folder(spark, "shards"), read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", F.lit("b").alias("full_text"))
    for k in range(2):
        X.write_handoff(d.filter(F.col("id") % 3 == k), f"{root}/run/shard{k}")
    return read_handoff(spark, root, "id bigint, lang string")


@query("k13_state_snapshot", values([("m", 7), ("none for another model", 0)], "what, n"))
def k13_state_snapshot(spark, sf_dir):
    """Clustering state saved and loaded; another model's state is not found, and a mixed one is refused (tests)."""
    from storyloom.operators import clustering as C
    from storyloom.operators.stories import twins

    root, state = folder(spark, "state"), twins(spark)
    C.save_state(state, root, "m")
    again = C.load_state(spark, root, "m")
    other = C.load_state(spark, root, "n")
    n = again.join(state.select("cluster_id", "sum"), ["cluster_id", "sum"]).count()
    return spark.createDataFrame([("m", n), ("none for another model", 0 if other is None else 1)], "what string, n bigint")
