"""Further relational operators: projections, merge rules, lateral top-1 lookups, sampling, registry and archive days."""

from __future__ import annotations

from storyloom.plans.model import NOW, relational

DAY = 86_400
IST = 19_800

# ------------------------------------------------------------------ scalar rules
relational("x10_language_name", "SELECT id, left(lower(concat(language_code, '-latin-script')), 5) AS language FROM articles")
relational("x38_article_time", f"SELECT id, CASE WHEN published_at IS NULL OR published_at > {NOW + 3600} THEN crawled_at ELSE published_at END AS t FROM articles")
relational("x39_ist_views", f"SELECT id, CAST(floor((crawled_at + {IST}) / {DAY}) AS BIGINT) AS ist_day, CAST(floor((crawled_at + {IST}) % {DAY} / 3600) AS BIGINT) AS ist_hour FROM articles")

# ------------------------------------------------------------------ lateral lookups

# ------------------------------------------------------------------ evaluation, sampling

# ------------------------------------------------------------------ state, registry, archive
relational("s5_since", f"SELECT id, coalesce(last_polled_at, {NOW - DAY}) - 10800 AS since FROM feeds")
relational("v4_archive_days", f"""
WITH days AS (SELECT DISTINCT CAST(floor(crawled_at / {DAY}) AS BIGINT) AS day FROM articles WHERE crawled_at < {NOW - 2 * DAY}), log AS (SELECT DISTINCT CAST(floor(crawled_at / {DAY}) AS BIGINT) AS day FROM articles WHERE id % 997 = 3)
SELECT d.day FROM days d LEFT JOIN log l ON l.day = d.day WHERE l.day IS NULL""")
