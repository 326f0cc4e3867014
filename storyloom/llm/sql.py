"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"

#: op10: keys of at least 40 code points found in at least 5 documents stay only in the largest doc_id.
_OP10 = r"""
WITH lines AS (
  SELECT doc_id, i, x, lower_az AS key FROM (
    SELECT doc_id, i, x, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents))),
often AS (SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT l.*, (o.key IS NOT NULL AND l.doc_id <> o.last) AS gone FROM lines l LEFT JOIN often o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: op5: the same digests from the rows themselves.  A turn takes 10 code points of marks, and an escape one more.
_OP5 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(10 + length(role || text) + length(regexp_replace(role || text, '[^\\<\[\]]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

#: op8: all pairs that share a shingle, exact similarity, smallest doc_id reachable.
_OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
l AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS gs FROM w),
n AS (SELECT doc_id, CAST(len(gs) AS BIGINT) AS n FROM l),
s AS (SELECT doc_id, unnest(gs) AS g FROM l),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n i ON i.doc_id = p.a JOIN n j ON j.doc_id = p.b WHERE 100 * x >= 80 * (i.n + j.n - x)),
d AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS v, b AS u FROM d UNION SELECT r.v, d.b FROM reach r JOIN d ON d.a = r.u),
c AS (SELECT v, least(v, min(u)) AS low FROM reach GROUP BY v)
SELECT n.doc_id, n.n AS n_shingles, coalesce(c.low, n.doc_id) AS component_id, n.doc_id = coalesce(c.low, n.doc_id) AS kept FROM n LEFT JOIN c ON c.v = n.doc_id
"""

SQL = {"op5_chat": _OP5, "op8_near_duplicates": _OP8, "op10_line_dedup": _OP10}
