"""Operators that are relational algebra: views, health reports, queues, archive days, coverage, evaluation."""

from __future__ import annotations

from storyloom.plans.model import NOW, relational

DAY = 86_400
_DOM = "coalesce(nullif(lower(domain), ''), '(unknown)')"

# ------------------------------------------------------------------ aggregations
relational("a1_domain_counts", f"SELECT {_DOM} AS domain, CAST(count(*) AS BIGINT) AS articles FROM articles WHERE crawled_at >= {NOW - DAY} AND crawled_at < {NOW} GROUP BY 1")
relational("a1_hourly_then_daily", f"""
WITH hours AS (SELECT {_DOM} AS domain, floor(crawled_at / 3600) AS hour, count(*) AS n FROM articles GROUP BY 1, 2)
SELECT domain, CAST(floor(hour / 24) AS BIGINT) AS day, CAST(sum(n) AS BIGINT) AS articles FROM hours GROUP BY 1, 2""")
relational("a2_coverage_summary", """
WITH rows AS (SELECT id % 5 AS day, language_code AS reference, n_chars % 50 AS ref_count, CASE WHEN id % 9 = 0 THEN n_chars % 7 ELSE 0 END AS missing FROM articles)
SELECT CAST(day AS BIGINT) AS day, reference, CAST(sum(ref_count) AS BIGINT) AS ref_count, CAST(sum(missing) AS BIGINT) AS missing,
       round(100.0 * CAST(sum(missing) AS DOUBLE) / nullif(CAST(sum(ref_count) AS DOUBLE), 0), 2) AS miss_pct FROM rows GROUP BY 1, 2""")
relational("a4_enrichment_queue_health", f"""
SELECT CAST(count(*) FILTER (WHERE enriched_at IS NULL) AS BIGINT) AS pending,
       CAST(count(*) FILTER (WHERE enriched_at IS NULL AND enrich_claimed_at IS NULL) AS BIGINT) AS unclaimed,
       CAST(count(*) FILTER (WHERE enriched_at IS NULL AND enrich_claimed_at >= {NOW - 150 * 60}) AS BIGINT) AS leased,
       CAST(count(*) FILTER (WHERE enriched_at IS NULL AND enrich_claimed_at < {NOW - 150 * 60}) AS BIGINT) AS expired,
       CAST(count(*) FILTER (WHERE enriched_at IS NULL AND enrich_attempts >= 3 AND enrich_attempts < 10) AS BIGINT) AS retrying,
       CAST(count(*) FILTER (WHERE enriched_at IS NULL AND enrich_attempts >= 10) AS BIGINT) AS dead,
       CAST(count(*) FILTER (WHERE enriched_at > {NOW - DAY}) AS BIGINT) AS enriched_24h,
       CAST(floor(({NOW} - min(crawled_at) FILTER (WHERE enriched_at IS NULL)) / 60) AS BIGINT) AS head_age_mins FROM articles""")
relational("a6_article_stats", f"""
SELECT {_DOM} AS domain, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE is_crawled) AS BIGINT) AS crawled, round(100.0 * count(*) FILTER (WHERE is_crawled) / count(*), 1) AS crawl_pct,
       max(crawled_at) AS newest FROM articles GROUP BY 1""")
relational("a7_feed_health", f"""
SELECT f.id, f.fail_count, CAST(count(e.event_id) AS BIGINT) AS found, CAST(floor(({NOW} - f.last_new_article_at) / {DAY}) AS BIGINT) AS days_since
FROM feeds f LEFT JOIN (SELECT event_id, user_id FROM events WHERE event_type = 'view') e ON e.user_id = f.id GROUP BY f.id, f.fail_count, f.last_new_article_at""")
relational("a12_queue_depth", f"SELECT CAST(count(*) AS BIGINT) AS depth FROM articles WHERE enriched_at IS NULL AND title IS NOT NULL AND enrich_attempts < 3 AND crawled_at > {NOW - 2 * DAY}")
relational("a13_archive_day_stats", f"""
SELECT CAST(floor(crawled_at / {DAY}) AS BIGINT) AS day, CAST(count(*) AS BIGINT) AS articles, min(id) AS min_id, max(id) AS max_id,
       CAST(count(*) FILTER (WHERE enriched_at IS NULL AND enrich_attempts < 10) AS BIGINT) AS waiting FROM articles GROUP BY 1""")
relational("a14_lincoln_petersen", """
WITH a AS (SELECT count(DISTINCT md5(text)) AS n1 FROM documents WHERE doc_id % 2 = 0), b AS (SELECT count(DISTINCT md5(text)) AS n2 FROM documents WHERE doc_id % 2 = 1),
m AS (SELECT count(DISTINCT md5(x.text)) AS m FROM documents x WHERE x.doc_id % 2 = 0 AND md5(x.text) IN (SELECT md5(y.text) FROM documents y WHERE y.doc_id % 2 = 1))
SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, CAST(m AS BIGINT) AS m, CASE WHEN n1 = 0 OR n2 = 0 THEN NULL ELSE round(CAST((n1 + 1) * (n2 + 1) AS DOUBLE) / (m + 1) - 1, 4) END AS universe FROM a CROSS JOIN b CROSS JOIN m""")
relational("a22_run_summary", "SELECT event_type AS outcome, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
relational("a23_modal_category", """
WITH n AS (SELECT cluster_id, language_code, count(*) AS n FROM articles WHERE cluster_id IS NOT NULL GROUP BY 1, 2)
SELECT cluster_id, language_code AS category FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, language_code) AS k FROM n) x WHERE k = 1""")

# ------------------------------------------------------------------ filters and state transitions
_CADENCE = "CASE WHEN poll_interval_mins > 0 THEN poll_interval_mins ELSE CASE cadence WHEN 'realtime' THEN 15 WHEN 'hourly' THEN 60 WHEN 'daily' THEN 1440 ELSE 720 END END"
relational("f1_due_feeds", f"""
SELECT id, CASE WHEN is_active THEN 'due' ELSE 'recheck' END AS why FROM feeds
WHERE (is_active AND (last_polled_at IS NULL OR {NOW} - last_polled_at >= 60 * 0.9 * {_CADENCE})) OR (NOT is_active AND disabled_reason = 'dormant' AND (last_polled_at IS NULL OR {NOW} - last_polled_at >= {7 * DAY}))""")
relational("f2_skip_feed", "SELECT id, NOT is_active AND coalesce(disabled_reason, '') <> 'dormant' AS skip FROM feeds")

# ------------------------------------------------------------------ joins
relational("j7_feeds_left_join", f"SELECT f.id, CAST(count(e.event_id) AS BIGINT) AS recent FROM feeds f LEFT JOIN events e ON e.user_id = f.id AND e.value > 50 GROUP BY f.id")
relational("j8_orphan_clusters", f"SELECT c.id FROM clusters c WHERE c.last_seen < {NOW - 3600} AND NOT EXISTS (SELECT 1 FROM articles a WHERE a.cluster_id = c.id)")
relational("j9_archive_clusters", f"SELECT c.id, c.article_count FROM clusters c WHERE c.id IN (SELECT DISTINCT cluster_id FROM articles WHERE floor(crawled_at / {DAY}) = {NOW // DAY - 1})")
relational("j11_day_entities", f"""
WITH entities AS (SELECT doc_id AS article_id, lang AS entity_type, n_chars % 100 / 100.0 AS salience FROM documents)
SELECT e.article_id, e.entity_type, round(e.salience, 2) AS salience FROM entities e JOIN articles a ON a.id = e.article_id WHERE floor(a.crawled_at / {DAY}) = {NOW // DAY - 2}""")
relational("j13_update_from", "SELECT a.id, CASE WHEN c.status = 'merged' THEN NULL ELSE a.cluster_id END AS cluster_id FROM articles a LEFT JOIN clusters c ON c.id = a.cluster_id")
relational("j14_reference_overlap", """
WITH ref AS (SELECT DISTINCT md5(lower(text)) AS h FROM documents WHERE doc_id % 3 <> 1), ours AS (SELECT DISTINCT md5(lower(text)) AS h FROM documents WHERE doc_id % 3 <> 2)
SELECT CAST(count(*) AS BIGINT) AS ref_count, CAST(count(ours.h) AS BIGINT) AS stored, CAST(count(*) - count(ours.h) AS BIGINT) AS missing FROM ref LEFT JOIN ours ON ours.h = ref.h""")
relational("j15_latest_previous", f"""
WITH d AS (SELECT {_DOM} AS domain, CAST(floor(crawled_at / {DAY}) AS BIGINT) AS day, count(*) AS n FROM articles GROUP BY 1, 2)
SELECT domain, day, CAST(n AS BIGINT) AS last_yield FROM (SELECT d.*, row_number() OVER (PARTITION BY domain ORDER BY day DESC) AS k FROM d WHERE day < {NOW // DAY - 1}) x WHERE k = 1""")

# ------------------------------------------------------------------ windows, sorts, limits
relational("w1_top_mentions", """
SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS k FROM events) x WHERE k <= 10""")
relational("w4_keyset_page", f"SELECT id, crawled_at FROM articles WHERE crawled_at > {NOW - 5 * DAY} OR (crawled_at = {NOW - 5 * DAY} AND id > 100) ORDER BY crawled_at, id LIMIT 200")
relational("w5_unclustered", f"""
SELECT id, coalesce(published_at, crawled_at) AS t, CASE WHEN length(title) < 40 THEN left(body, 1500) END AS lead FROM articles
WHERE cluster_id IS NULL AND (published_at IS NULL OR published_at <= {NOW + 3600}) ORDER BY t, id LIMIT 500""")
relational("w6_top_stories_24h", f"SELECT id, outlet_count, article_count, last_seen FROM clusters WHERE status = 'active' AND last_seen > {NOW - DAY} ORDER BY outlet_count DESC, article_count DESC, last_seen DESC, id LIMIT 50")
relational("w7_dormancy_watch", f"SELECT id, CAST(floor(({NOW} - last_new_article_at) / {DAY}) AS BIGINT) AS days FROM feeds WHERE {NOW} - last_new_article_at > {20 * DAY} AND is_active ORDER BY last_new_article_at, id LIMIT 100")
relational("w9_best_row", """
SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars % 4 DESC, CASE WHEN n_chars % 30 = 0 THEN 9999 ELSE n_chars % 30 END, n_chars DESC, doc_id) AS k FROM documents) x WHERE k = 1""")
relational("w10_stratified_sample", """
WITH a AS (SELECT doc_id, lang, source, md5(concat(CAST(doc_id AS VARCHAR(20)), 'seed')) AS o FROM documents), b AS (SELECT a.*, row_number() OVER (PARTITION BY lang, source ORDER BY o) AS k FROM a),
c AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY o) AS n FROM b WHERE k <= 6) SELECT doc_id, lang FROM c WHERE n <= 25""")
relational("w12_largest_reference", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) x WHERE k = 1")

# ------------------------------------------------------------------ queue, archive
_CLAIMABLE = f"""enriched_at IS NULL AND title IS NOT NULL AND crawled_at <= {NOW} AND (enrich_claimed_at IS NULL OR enrich_claimed_at < {NOW - 150 * 60})
  AND (enrich_attempts < 3 OR (enrich_attempts < 10 AND enrich_claimed_at < {NOW - DAY}))"""
relational("q1_claim_batch", f"SELECT id, {NOW} AS enrich_claimed_at, enrich_attempts + 1 AS enrich_attempts FROM articles WHERE {_CLAIMABLE} ORDER BY crawled_at, id LIMIT 50")
relational("q2_release_claims", f"SELECT id, CASE WHEN enriched_at IS NULL AND enrich_claimed_at IS NOT NULL AND id % 2 = 0 THEN greatest(enrich_attempts - 1, 0) ELSE enrich_attempts END AS enrich_attempts FROM articles")
relational("r8_cluster_keys_except", "SELECT DISTINCT source FROM documents WHERE n_chars > 3000 EXCEPT SELECT DISTINCT source FROM documents WHERE n_chars > 12000")
relational("streak_breaker", """
WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS grp FROM events),
s AS (SELECT user_id, grp, sum(bad) AS streak FROM e GROUP BY 1, 2) SELECT user_id, CAST(max(streak) AS BIGINT) AS longest FROM s GROUP BY user_id HAVING max(streak) >= 3""")
