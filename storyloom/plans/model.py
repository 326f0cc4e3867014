"""Roles of the reference's tables played by the driver's tables, written once for Spark SQL and DuckDB.

Time is epoch seconds and `now` is a constant, so every operator is a pure function of its input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import registry

NOW = 1_767_571_200
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Articles: a document each; title is its first line, domain its source.  Missing values are made by residues of the id.
ARTICLES = f"""articles AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS body, CASE WHEN doc_id % 11 = 0 THEN ' ' WHEN doc_id % 13 = 0 THEN NULL ELSE upper(source) END AS domain,
         lang AS language_code, {NOW} - doc_id % 997 * 600 AS crawled_at, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE {NOW} - doc_id % 500 * 1200 END AS published_at,
         doc_id % 3 <> 0 AS is_crawled, CASE WHEN doc_id % 4 = 0 THEN {NOW} - doc_id % 300 * 60 END AS enriched_at, doc_id % 12 AS enrich_attempts,
         CASE WHEN doc_id % 5 < 2 THEN {NOW} - doc_id % 90 * 3600 END AS enrich_claimed_at, doc_id % 10 = 9 AS is_duplicate, n_chars,
         CASE WHEN doc_id % 6 < 4 THEN doc_id % 37 END AS cluster_id
  FROM documents)"""
#: Clusters of those articles, with counts that have drifted for some.
CLUSTERS = f"""clusters AS (
  SELECT cluster_id AS id, CAST(count(*) AS BIGINT) + CASE WHEN cluster_id % 5 = 0 THEN 1 ELSE 0 END AS article_count, CAST(count(DISTINCT coalesce(domain, '')) AS BIGINT) AS outlet_count,
         min(crawled_at) AS first_seen, max(crawled_at) AS last_seen, CASE WHEN cluster_id % 9 = 8 THEN 'merged' ELSE 'active' END AS status
  FROM articles WHERE cluster_id IS NOT NULL GROUP BY cluster_id
  UNION ALL SELECT CAST(1000 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), {NOW} - 900000, {NOW} - 800000, 'active')"""
#: Feeds: a user of the events each; an error event is a failed poll.
FEEDS = f"""feeds AS (
  SELECT user_id AS id, CAST(count(*) AS BIGINT) AS polls, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS fail_count,
         CASE WHEN user_id % 17 = 0 THEN NULL ELSE {NOW} - user_id % 200 * 600 END AS last_polled_at, {NOW} - user_id % 60 * 86400 AS last_new_article_at,
         CASE user_id % 4 WHEN 0 THEN 'realtime' WHEN 1 THEN 'hourly' WHEN 2 THEN 'daily' ELSE NULL END AS cadence, CASE WHEN user_id % 6 = 0 THEN 45 ELSE 0 END AS poll_interval_mins,
         user_id % 8 <> 7 AS is_active, CASE WHEN user_id % 8 = 7 THEN CASE WHEN user_id % 3 = 0 THEN 'errors' ELSE 'dormant' END END AS disabled_reason
  FROM events GROUP BY user_id)"""
_CTES = {"articles": ARTICLES, "clusters": CLUSTERS, "feeds": FEEDS}


def with_roles(sql: str) -> str:
    """sql with the roles it names put in front, those they build on first."""
    used = [k for k in _CTES if re.search(rf"\b{k}\b", sql)]
    if "clusters" in used and "articles" not in used:
        used.insert(0, "articles")
    if not used:
        return sql
    front = ",\n".join(_CTES[k] for k in used)
    body = sql.strip()
    return f"WITH {front},\n{body[4:].lstrip()}" if body.upper().startswith("WITH") else f"WITH {front}\n{body}"


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL over the driver's tables; each table it names is read as a Parquet scan, so columns and filters are pushed."""
    whole = with_roles(sql)
    for t in TABLES:
        whole = re.sub(rf"\b(FROM|JOIN|IN \(SELECT doc_id FROM)\s+{t}\b", rf"\1 parquet.`{sf_dir}/{t}.parquet`", whole)
    return spark.sql(whole)


def relational(name: str, sql: str) -> None:
    """Register an operator that is plain ANSI SQL: Spark SQL runs the text, DuckDB checks the same text."""
    registry.query(name, with_roles(sql))(lambda spark, sf_dir: run_sql(spark, sf_dir, sql))
