"""Operators written as DataFrame expressions, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storyloom.functions import text as T
from storyloom.functions import urls as U
from storyloom.functions import vectors as V
from storyloom.plans.registry import query


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ URLs
@query("u5_http_scheme", "SELECT page_id, regexp_matches(coalesce(url, ''), '(?i)^https?://') AS http FROM pages")
def u5_http_scheme(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.has_http_scheme(F.col("url")).alias("http"))


@query("u7_host_key", r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(trim(url), '^[^:/?#]+://([^/?#:]*)', 1)), '^www\.', ''), '^m\.', ''), '^amp\.', '') AS host FROM pages")
def u7_host_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.host_key(F.col("url")).alias("host"))


@query("u8_paywalled", r"""WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)), '^www\.', '') AS host FROM pages)
SELECT page_id, (page_id % 50 = 0 OR host = 'example.net' OR ends_with(host, '.example.net')) AS paywalled FROM h""")  # fmt: skip
def u8_paywalled(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.is_paywalled(F.col("page_id") % 50 == 0, U.domain(F.col("url")), ["example.net"]).alias("paywalled"))


@query("u10_hamming", "SELECT doc_id, CAST(bit_count(xor(doc_id * 2654435761, n_chars * 40503)) AS INTEGER) AS distance FROM documents")
def u10_hamming(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", U.hamming(F.col("doc_id") * 2654435761, F.col("n_chars") * 40503).alias("distance"))


@query("u12_shard_of", "SELECT doc_id, CAST(doc_id % 7 AS INTEGER) AS shard FROM documents")
def u12_shard_of(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.pmod("doc_id", F.lit(7)).cast("int").alias("shard"))


@query("u13_seeded_order", "SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || 'seed') AS o FROM documents ORDER BY o LIMIT 40")
def u13_seeded_order(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("seed")).cast("binary")).alias("o")).orderBy("o").limit(40)


# ------------------------------------------------------------------ near-duplicate titles
# ------------------------------------------------------------------ texts
_TRIM = r"regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')"


@query("x20_cleaned_text")
def x20_cleaned_text(spark, sf_dir):
    """The cleaner itself; x20_clean_boilerplate only counts lines under three patterns."""
    return read(spark, sf_dir, "documents").select("doc_id", T.cleaned_article(F.col("text")).alias("cleaned"))


@query("x25_db_row", "SELECT doc_id, left(split_part(text, chr(10), 1), 1000) AS title, left(text, 2000) AS description, length(left(text, 80000)) AS body_chars FROM documents")
def x25_db_row(spark, sf_dir):
    clean = F.translate("text", "\u0000", "")
    return read(spark, sf_dir, "documents").select("doc_id", F.left(F.substring_index(clean, "\n", 1), F.lit(1000)).alias("title"), F.left(clean, F.lit(2000)).alias("description"), F.length(F.left(clean, F.lit(80000))).alias("body_chars"))


@query("x37_norm_domain", "SELECT page_id, coalesce(nullif(trim(lower(CASE WHEN page_id % 9 = 0 THEN '  ' WHEN page_id % 10 = 0 THEN NULL ELSE ' Ex.COM ' END)), ''), '(unknown)') AS domain FROM pages")
def x37_norm_domain(spark, sf_dir):
    raw = F.expr("CASE WHEN page_id % 9 = 0 THEN '  ' WHEN page_id % 10 = 0 THEN NULL ELSE ' Ex.COM ' END")
    return read(spark, sf_dir, "pages").select("page_id", F.coalesce(F.nullif(F.trim(F.lower(raw)), F.lit("")), F.lit("(unknown)")).alias("domain"))


# ------------------------------------------------------------------ arrays and sets


@query("r4_shared_entities", "SELECT a.doc_id, CAST(len(list_intersect([a.lang, a.source], ['en', 'src1', 'src2'])) AS INTEGER) AS shared FROM documents a")
def r4_shared_entities(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(F.array_intersect(F.array("lang", "source"), F.array(F.lit("en"), F.lit("src1"), F.lit("src2")))).alias("shared"))


# ------------------------------------------------------------------ calendar, coverage
@query("j10_calendar_log", """WITH days AS (SELECT CAST(unnest(range(0, 30)) AS BIGINT) AS day), log AS (SELECT user_id % 40 AS day, count(*) AS n FROM events GROUP BY 1)
SELECT d.day, CAST(coalesce(l.n, 0) AS BIGINT) AS n FROM days d LEFT JOIN log l ON l.day = d.day WHERE l.day IS NULL OR l.day % 3 <> 0""")  # fmt: skip
def j10_calendar_log(spark, sf_dir):
    days = spark.range(0, 30).withColumnRenamed("id", "day")
    log = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 40).alias("day")).agg(F.count("*").alias("n"))
    return days.join(log.withColumnRenamed("day", "l"), F.col("day") == F.col("l"), "left").filter("l is null or l % 3 <> 0").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("a19_threshold_sweep", """WITH s AS (SELECT quality AS y, (doc_id % 100) / 100.0 AS s FROM labels), t AS (SELECT unnest(range(1, 20)) / 20.0 AS t),
c AS (SELECT t, count(*) FILTER (s >= t AND y = 1) AS tp, count(*) FILTER (s >= t) AS p, count(*) FILTER (y = 1) AS pos FROM s, t GROUP BY t)
SELECT round(t, 2) AS t, round(2.0 * tp / greatest(p + pos, 1), 6) AS f1 FROM c""")  # fmt: skip
def a19_threshold_sweep(spark, sf_dir):
    """Scores fall into the steps of the sweep first, so the sweep runs on counts by step, not on rows."""
    s = read(spark, sf_dir, "labels").select(F.col("quality").alias("y"), F.floor(F.col("doc_id") % 100 / 5).cast("int").alias("step"))
    steps = s.groupBy("step").agg(F.count("*").alias("n"), F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("good"))
    both = steps.agg(F.collect_list(F.struct("step", "n", "good")).alias("x"), F.sum("good").alias("pos"))  # 20 rows at most
    total = lambda what: F.aggregate(F.filter("x", lambda e: e["step"] >= F.col("k")), F.lit(0).cast("bigint"), lambda a, e: a + e[what])
    swept = both.select("x", "pos", F.explode(F.sequence(F.lit(1), F.lit(19))).alias("k"))
    return swept.select(F.round(F.col("k") / 20, 2).alias("t"), F.round(2.0 * total("good") / F.greatest(total("n") + F.col("pos"), F.lit(1)), 6).alias("f1"))


# ------------------------------------------------------------------ vectors


# ------------------------------------------------------------------ events: windows and sessions
@query("tumbling_day", "SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def tumbling_day(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").groupBy(F.unix_timestamp(F.date_trunc("day", ts)).alias("day"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("activity_sessions", """WITH e AS (SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= ts - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e) SELECT user_id, CAST(k AS BIGINT) AS session, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1, 2""")  # fmt: skip
def activity_sessions(spark, sf_dir):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    e = e.withColumn("fresh", F.when(F.lag("ts").over(w) >= F.col("ts") - F.expr("INTERVAL 6 HOURS"), 0).otherwise(1))
    return e.withColumn("session", F.sum("fresh").over(w)).groupBy("user_id", "session").agg(F.count("*").alias("n"))
