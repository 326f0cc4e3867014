"""Queries of URL rules, hashes and the two duplicate checks, over all pages and hand-made URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storyloom.functions import hashes as H
from storyloom.functions import text as T
from storyloom.functions import urls as U
from storyloom.operators.stories import read
from storyloom.plans.cases import literal, values
from storyloom.plans.registry import query

URLS = [
    "HTTP://WWW.Ex.com:80/a//b/?b=2&a=1#top", "//cdn.ex.com/x/", "ex.com", "https://ex.com/p?q=a%20b&z=%7E&utm_x=1", "https://ex.com/p?q=a+b&z=~", "https://ex.com/p;v=1?sid=3&UTM_Source=x&blank=&c", "http://www.ex.com:443/", "https://ex.com/?%75tm_id=1&k=%C3%A9",
    "ftp://ex.com/f", "mailto:a@ex.com", " https://m.ex.com/a/ ", "https://amp.ex.com/?hsa_new=1&share=2&origin=3", "https://www.m.ex.com:8080/x", "", None,
]


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url: all pages, and URLS under negative ids."""
    more = spark.createDataFrame([(-k - 1, u) for k, u in enumerate(URLS)], "page_id bigint, url string")
    return read(spark, sf_dir, "pages").select("page_id", "url").unionByName(more)


_RAW = "raw AS (SELECT page_id, url FROM pages UNION ALL " + values([(-k - 1, u) for k, u in enumerate(URLS)], "page_id, url") + ")"


def _canonical(name: str, scheme: str, gone: tuple[str, ...], prefixes: tuple[str, ...], collapse: bool) -> str:
    """SQL of one rule set as tables named after it; the last is <name>(page_id, canonical, host)."""
    keep = f"NOT list_contains({literal(list(gone))}, lower(p.k))" + "".join(f" AND NOT starts_with(lower(p.k), '{x}')" for x in prefixes)
    decode = "url_decode(replace({}, '+', ' '))"
    encode = "replace(url_encode({}), '%20', '+')"
    port = "regexp_replace({}, ':(80|443)$', '')" if collapse else "{}"
    host = port.format(r"regexp_replace(lower(regexp_extract(u, '^[^:/?#]+://([^/?#]*)', 1)), '^www\.', '')")
    return rf"""{name}0 AS (SELECT page_id, trim(coalesce(url, '')) AS t FROM raw), {name}1 AS (SELECT page_id, CASE WHEN t = '' THEN '' {scheme} END AS u FROM {name}0),
{name}2 AS (SELECT page_id, u, {host} AS host, regexp_replace(regexp_replace(regexp_extract(u, '^[^:/?#]+:(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '/{{2,}}', '/', 'g') AS path, string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&') AS q FROM {name}1),
{name}3 AS (SELECT page_id, u, host, CASE WHEN length(path) > 1 THEN regexp_replace(path, '/+$', '') ELSE path END AS path,
  list_sort(list_filter(list_transform(list_filter(q, lambda x: regexp_matches(x, '^[^=]*=.')), lambda x: struct_pack(k := {decode.format("split_part(x, '=', 1)")}, v := {decode.format("substr(x, strpos(x, '=') + 1)")})), lambda p: {keep})) AS q FROM {name}2),
{name} AS (SELECT page_id, host, CASE WHEN u = '' THEN '' ELSE {"CASE WHEN lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) = 'http' THEN 'https' ELSE lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) END" if collapse else "lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"}
  || '://' || host || path || CASE WHEN len(q) = 0 THEN '' ELSE '?' || array_to_string(list_transform(q, lambda p: {encode.format('p.k')} || '=' || {encode.format('p.v')}), '&') END END AS canonical FROM {name}3)"""


_NEW_SCHEME = r"WHEN starts_with(t, '//') THEN 'https:' || t WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') OR regexp_matches(t, '(?i)^https?:') THEN t ELSE 'https://' || t"
_NEW = _canonical("c", _NEW_SCHEME, U.STRIP_PARAMS, U.STRIP_PREFIXES, True)
_OLD = _canonical("l", "WHEN regexp_matches(t, '^https?://') THEN t ELSE 'https://' || t", U.STRIP_PARAMS + U.LEGACY_ONLY_PARAMS, (), False)


def _signed(text: str) -> str:
    h = f"CAST('0x' || left(sha256({text}), 16) AS UBIGINT)"
    return f"CASE WHEN {h} >= 9223372036854775808 THEN CAST(CAST({h} AS HUGEINT) - 18446744073709551616 AS BIGINT) ELSE CAST({h} AS BIGINT) END"


@query("u1_normalise_url", f"WITH {_RAW}, {_NEW} SELECT page_id, canonical FROM c")
def u1_normalise_url(spark, sf_dir):
    return addresses(spark, sf_dir).select("page_id", U.normalise_url(F.col("url")).alias("canonical"))


@query("u2_legacy_normalise", f"WITH {_RAW}, {_OLD} SELECT page_id, canonical AS legacy FROM l")
def u2_legacy_normalise(spark, sf_dir):
    return addresses(spark, sf_dir).select("page_id", U.normalise_url(F.col("url"), legacy=True).alias("legacy"))


@query("u3_url_hash", f"WITH {_RAW}, {_NEW} SELECT page_id, {_signed('canonical')} AS url_hash FROM c")
def u3_url_hash(spark, sf_dir):
    return addresses(spark, sf_dir).select("page_id", U.url_hash(F.col("url")).alias("url_hash"))


@query("u3_murmur_cases", values([("foo", -840311307571801102)], "x, h"))
def u3_murmur_cases(spark, sf_dir):
    """The published value of 'foo' under seed 42; tests hold longer strings against plain integer arithmetic."""
    return spark.createDataFrame([("foo",)], "x string").select("x", H.murmur64("x").alias("h"))


@query("u3_murmur_hash", f"WITH {_RAW}, {_NEW} SELECT count(DISTINCT canonical) AS hashes FROM c")
def u3_murmur_hash(spark, sf_dir):
    """Murmur hashes of all canonical URLs: as many as there are different URLs."""
    return addresses(spark, sf_dir).select(H.murmur64(U.normalise_url(F.col("url"))).alias("h")).agg(F.count_distinct("h").alias("hashes"))


@query("u4_catalogue_key", f"WITH {_RAW}, {_NEW} SELECT canonical, CAST(count(*) AS BIGINT) AS feeds FROM c GROUP BY 1")
def u4_catalogue_key(spark, sf_dir):
    """The catalogue loader keys feeds by the same canonical form."""
    return addresses(spark, sf_dir).groupBy(U.normalise_url(F.col("url")).alias("canonical")).agg(F.count("*").alias("feeds"))


@query("u6_hash_candidates", f"WITH {_RAW}, {_NEW}, {_OLD}, h AS (SELECT c.page_id, {_signed('c.canonical')} AS a, {_signed('l.canonical')} AS b FROM c JOIN l ON l.page_id = c.page_id) SELECT page_id, a AS first, CASE WHEN a <> b THEN b END AS second FROM h WHERE page_id NOT IN (-14, -15) UNION ALL SELECT k, (SELECT a FROM h WHERE page_id = -3), NULL FROM (VALUES (-14), (-15)) AS t(k)")
def u6_hash_candidates(spark, sf_dir):
    """New and legacy hashes of the link, or of the id (here that of the third hand-made URL) where an entry has no link."""
    rows = addresses(spark, sf_dir).select("page_id", U.hash_candidates(F.col("url"), F.lit(URLS[2])).alias("c"))
    return rows.select("page_id", F.get("c", F.lit(0)).alias("first"), F.get("c", F.lit(1)).alias("second"))


@query("u1_top_hosts", f"WITH {_RAW}, {_NEW}, d AS (SELECT canonical, min(host) AS host FROM c WHERE page_id >= 0 GROUP BY 1) SELECT host, CAST(count(*) AS BIGINT) AS pages FROM d GROUP BY host ORDER BY pages DESC, host LIMIT 50")
def u1_top_hosts(spark, sf_dir):
    """The minimum slice: canonical URL, hash, exact dedup, hosts by count."""
    own = read(spark, sf_dir, "pages").select(U.normalise_url(F.col("url")).alias("canonical"))
    once = own.groupBy(U.signed_sha64(F.col("canonical")).alias("url_hash")).agg(F.min("canonical").alias("canonical"))
    return once.groupBy(U.domain(F.col("canonical")).alias("host")).agg(F.count("*").alias("pages")).orderBy(F.desc("pages"), "host").limit(50)


# ------------------------------------------------------------------ exact duplicates
def duplicates(entries: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """entries (key, candidates) -> key, url_hash, outcome: 'exact dup' if any candidate is stored or an earlier entry has its new hash, else 'new'.

    Only the new hash, the first candidate, is stored.
    """
    flat = entries.select(key, F.explode("candidates").alias("url_hash"))
    seen = flat.join(stored.select("url_hash").distinct(), "url_hash", "left_semi").select(key).distinct().withColumn("seen", F.lit(True))
    rows = entries.select(key, F.get("candidates", F.lit(0)).alias("url_hash")).join(seen, key, "left")
    first = F.row_number().over(W.partitionBy("url_hash", F.coalesce("seen", F.lit(False))).orderBy(key)) == 1
    return rows.select(key, "url_hash", F.when(F.col("seen") | ~first, "exact dup").otherwise("new").alias("outcome"))


_STORED = f"WITH {_RAW}, {_NEW}, {_OLD}, e AS (SELECT c.page_id, c.page_id % 3 AS r, {_signed('c.canonical')} AS a, {_signed('l.canonical')} AS b FROM c JOIN l ON l.page_id = c.page_id), stored AS (SELECT CASE WHEN page_id % 2 = 0 THEN a ELSE b END AS h FROM e WHERE r = 0)"


def _batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A batch of entries, and a store whose odd rows were hashed under the legacy rule."""
    rows = addresses(spark, sf_dir).select("page_id", F.array_distinct(F.array(U.url_hash(F.col("url")), U.legacy_url_hash(F.col("url")))).alias("candidates"))
    both = F.when(F.col("page_id") % 2 == 0, F.get("candidates", F.lit(0))).otherwise(F.get("candidates", F.size("candidates") - 1))
    return rows.filter("page_id % 3 <> 0"), rows.filter("page_id % 3 = 0").select(both.alias("url_hash"))


@query("j1_exact_dedup", f"{_STORED}, m AS (SELECT page_id, a, a IN (SELECT h FROM stored) OR b IN (SELECT h FROM stored) AS seen FROM e WHERE r <> 0) SELECT page_id, a AS url_hash, CASE WHEN seen OR row_number() OVER (PARTITION BY a, seen ORDER BY page_id) > 1 THEN 'exact dup' ELSE 'new' END AS outcome FROM m")
def j1_exact_dedup(spark, sf_dir):
    return duplicates(*_batch(spark, sf_dir), key="page_id")


@query("k1_upsert_returning", f"{_STORED}, m AS (SELECT page_id, a FROM e WHERE r <> 0 AND a NOT IN (SELECT h FROM stored)), i AS (SELECT min(page_id) AS page_id, a FROM m GROUP BY a) SELECT page_id, a AS url_hash, (SELECT count(*) FROM e WHERE r <> 0) - (SELECT count(*) FROM i) AS duplicates FROM i")
def k1_upsert_returning(spark, sf_dir):
    """Insert-or-ignore on the hash: the rows inserted, with the number of those that were not."""
    batch, stored = _batch(spark, sf_dir)
    rows = batch.select("page_id", F.get("candidates", F.lit(0)).alias("url_hash"))
    inserted = rows.groupBy("url_hash").agg(F.min("page_id").alias("page_id")).join(stored, "url_hash", "left_anti")
    counts = rows.agg(F.count("*").alias("n")).crossJoin(inserted.agg(F.count("*").alias("i")))  # one row each
    return inserted.crossJoin(counts).select("page_id", "url_hash", (F.col("n") - F.col("i")).alias("duplicates"))


# ------------------------------------------------------------------ near-duplicate titles
def simhash_pairs(hashes: DataFrame, most: int = 3) -> DataFrame:
    """(a, b, distance) within `most` bits, 0 ignored: a shared one of most + 1 bit bands makes a pair meet; equal hashes meet once.

    Ids of one hash are represented by the smallest.  Each band is joined together with a second one, so that pairs
    meet under 32 bits where they agree in two bands, and under 16 bits plus a count of ones where only one agrees.
    All sides grow with the input, so they meet in shuffles: none is brought to the driver for a broadcast.
    """
    ones = hashes.filter("h <> 0").groupBy("h").agg(F.min("id").alias("id"))
    bits = lambda k: F.shiftrightunsigned("h", 16 * k).bitwiseAND(F.lit(65535))
    # hashes within 3 bits differ by 3 ones at most, so the count of ones splits a hot band
    band = F.posexplode(F.array(*[bits(k) for k in range(4)])).alias("band", "bits")
    flat = ones.select("id", "h", F.bit_count("h").alias("ones"), band)
    a = flat.select(F.col("id").alias("a"), F.col("h").alias("ha"), "band", "bits", F.col("ones").alias("near"))
    b = flat.select(F.col("id").alias("b"), F.col("h").alias("hb"), "band", "bits", F.explode(F.sequence(F.col("ones") - most, F.col("ones") + most)).alias("near"))
    pairs = a.join(b.hint("merge"), ["band", "bits", "near"]).filter("a < b").withColumn("distance", U.hamming(F.col("ha"), F.col("hb"))).filter(F.col("distance") <= most)
    # a pair is given out by the first band that it shares
    x = F.col("ha").bitwiseXOR(F.col("hb"))
    lead = F.coalesce(*[F.when(F.shiftrightunsigned(x, 16 * k).bitwiseAND(F.lit(65535)) == 0, k) for k in range(4)])
    return pairs.filter(F.col("band") == lead).select("a", "b", "distance")


_WORDS = r"regexp_extract_all(lower(regexp_replace(strip_accents({}), '[^\x00-\x7F]', '', 'g')), '[a-z0-9]+')"
_BITS = "s AS (SELECT id, bit, sum(CASE WHEN (h >> bit) & 1 = 1 THEN n ELSE -n END) AS v FROM (SELECT id, CAST('0x' || left(sha256(w), 16) AS UBIGINT) AS h, count(*) AS n FROM w GROUP BY 1, 2) x, (SELECT unnest(range(0, 64)) AS bit) b GROUP BY 1, 2), u AS (SELECT id, sum(CASE WHEN v > 0 THEN CAST(1 AS HUGEINT) << CAST(bit AS INTEGER) ELSE 0 END) AS u FROM s GROUP BY 1)"
_SIM = "CASE WHEN u.u >= 9223372036854775808 THEN CAST(u.u - 18446744073709551616 AS BIGINT) ELSE CAST(coalesce(u.u, 0) AS BIGINT) END"


@query("u9_simhash", f"WITH w AS (SELECT doc_id AS id, unnest({_WORDS.format('text')}) AS w FROM documents), {_BITS} SELECT doc_id, {_SIM} AS simhash FROM documents LEFT JOIN u ON u.id = doc_id")
def u9_simhash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.simhash("text").alias("simhash"))


_TITLES = f"w AS (SELECT doc_id AS id, unnest({_WORDS.format('split_part(text, chr(10), 1)')}) AS w FROM documents), {_BITS}, t AS (SELECT doc_id AS id, {_SIM} AS h FROM documents LEFT JOIN u ON u.id = doc_id)"


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), T.simhash(F.substring_index("text", "\n", 1)).alias("h"))


@query("j2_near_titles", f"WITH {_TITLES}, o AS (SELECT h, min(id) AS id FROM t WHERE h <> 0 GROUP BY h) SELECT least(a.id, b.id) AS a, greatest(a.id, b.id) AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM o a JOIN o b ON a.id < b.id AND bit_count(xor(a.h, b.h)) <= 3")
def j2_near_titles(spark, sf_dir):
    return simhash_pairs(titles(spark, sf_dir))


def flagged(run: DataFrame, stored: DataFrame, horizon: int = 10_000) -> DataFrame:
    """run (id, h) -> id, near: whether a title of the newest `horizon` stored ones (id, h, at), or an earlier one of the run, is within three bits."""
    newest = stored.filter("h <> 0").orderBy(F.desc("at"), F.desc("id")).limit(horizon).select("h").distinct()
    # stored hashes come before every id of the run
    known = newest.select(F.lit(-(1 << 62)).cast("bigint").alias("id"), "h").unionByName(run.select("id", "h").filter("h <> 0"))
    first = known.groupBy("h").agg(F.min("id").alias("first"))
    pairs = simhash_pairs(first.select(F.col("h").alias("id"), "h"))
    other = pairs.select(F.col("a").alias("h"), F.col("b").alias("o")).unionByName(pairs.select(F.col("b").alias("h"), F.col("a").alias("o")))
    earliest = other.join(first.withColumnRenamed("h", "o").hint("merge"), "o").groupBy("h").agg(F.min("first").alias("near_first"))
    rows = run.join(first.hint("merge"), "h", "left").join(earliest.hint("merge"), "h", "left")
    return rows.select("id", F.coalesce((F.col("first") < F.col("id")) | (F.col("near_first") < F.col("id")), F.lit(False)).alias("near"))


@query("j2_near_flags", f"WITH {_TITLES}, st AS (SELECT h FROM (SELECT h, id, id * 7 % 1000 AS ts FROM t WHERE id % 3 <> 0 AND h <> 0 ORDER BY ts DESC, id DESC LIMIT 300) x), r AS (SELECT id, h FROM t WHERE id % 3 = 0) SELECT id, h <> 0 AND (EXISTS (SELECT 1 FROM st WHERE bit_count(xor(st.h, r.h)) <= 3) OR EXISTS (SELECT 1 FROM r q WHERE q.id < r.id AND q.h <> 0 AND bit_count(xor(q.h, r.h)) <= 3)) AS near FROM r")
def j2_near_flags(spark, sf_dir):
    """A run of a third of the titles against the newest 300 of the others and its own earlier ones."""
    t = titles(spark, sf_dir)
    return flagged(t.filter("id % 3 = 0"), t.filter("id % 3 <> 0").withColumn("at", F.col("id") * 7 % 1000), 300)
