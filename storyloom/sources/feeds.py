"""Readers that turn raw documents into entries: feeds, sitemaps, official listings, coverage lines, hand-off files.

All work on a DataFrame with a text column, so any Spark source (files, tables, streams) can feed them.
"""

from __future__ import annotations

import gzip
import html
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from storyloom.functions import language as L
from storyloom.functions import urls as U

#: One schema for every reader.
ENTRY = "link string, id string, title string, summary string, published timestamp, language string, tags array<string>, image string"
_COLUMNS = ("link", "id", "title", "summary", "published", "language", "tags", "image")
LOOKBACK_HOURS, OVERLAP_HOURS, CHILDREN = 48, 3, 40
MAX_BYTES, MAX_SITEMAP_BYTES = 10 * 1024 * 1024, 30 * 1024 * 1024
#: Codes of one official site's lists.  Fixed values.
LIST_LANGUAGE = {"1": "en", "2": "hi", "3": "ur", "4": "bn", "6": "pa", "8": "kn", "9": "mr", "10": "as", "11": "ta", "13": "gu", "14": "mni", "15": "ml", "16": "te", "18": "or"}
#: Fund value notices.  Fixed pattern.
FUND_NOTICE = r"(?i)\b(?:i?SIF\s+)?NAV\b\s*(?:as\b|upload|on\b|for\b|of\b|dated|-|:|\d)|declaration of nav"


@F.pandas_udf(StringType())
def decoded_once(x: pd.Series) -> pd.Series:
    return x.map(lambda t: html.unescape(t) if isinstance(t, str) and "&" in t else t)


@F.pandas_udf(StringType())
def decoded_twice(x: pd.Series) -> pd.Series:
    return x.map(lambda t: html.unescape(html.unescape(t)) if isinstance(t, str) and "&" in t else t)


def element(block: Column, name: str) -> Column:
    """Raw text of an XML element of any prefix, CDATA opened; '' if absent."""
    return F.regexp_extract(block, rf"(?is)<(?:\w+:)?{name}\b[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:\w+:)?{name}>", 1)


def spaced(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def field(block: Column, name: str) -> Column:
    """Text of an element, entities decoded twice, space collapsed."""
    return spaced(decoded_twice(element(block, name)))


def parse_time(text: Column, zone: str = "Asia/Kolkata") -> Column:
    """ISO, RFC 822 and exchange times; a time without zone is local to `zone`."""
    t = F.trim(text)
    zoned = t.rlike(r"(?i)(\dz|gmt|utc|[+-]\d\d:?\d\d)$") & ~t.rlike(r"^\d{4}-\d\d-\d\d$")
    shaped = F.regexp_replace(F.regexp_replace(t, r"(?i)\s*(gmt|utc|z)$", " +0000"), r"^\w{3}, ", "")
    iso = F.regexp_replace(F.regexp_replace(shaped, r"^(\d{4}-\d\d-\d\d)[T ](\d\d:\d\d:\d\d)(?:\.\d+)? ?([+-]\d\d):?(\d\d)$", "$1T$2$3:$4"), "^(?!\\d{4}-).*", "")
    rfc = F.coalesce(F.try_to_timestamp(shaped, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(F.nullif(iso, F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
    plain = F.regexp_replace(shaped, r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)\.\d+$", "$1")
    naive = F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "d MMM yyyy HH:mm:ss", "dd-MMM-yyyy HH:mm:ss", "MMM dd, yyyy")])
    return F.when(zoned, rfc).otherwise(F.to_utc_timestamp(naive, zone))


def blocks(text: Column, name: str) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?is)<{name}\b[^>]*>(.*?)</{name}>"), 1)


def _entry(rows: DataFrame, *keep: str, **have: Column) -> DataFrame:
    """rows as ENTRY: what is not given is null; id is the link where it is not given."""
    types = dict(f.split(" ", 1) for f in ENTRY.split(", "))
    have.setdefault("id", have["link"])
    return rows.select(*keep, *[have.get(c, F.lit(None)).cast(types[c]).alias(c) for c in _COLUMNS])


# ------------------------------------------------------------------ raw documents
_RAW = StructType([StructField("text", StringType()), StructField("error", StringType())])


def _opened(data: bytes | None, most: int) -> tuple[str | None, str | None]:
    if data is None:
        return None, "no content"
    if len(data) > most:
        return None, "too large"
    if data[:2] == b"\x1f\x8b":
        try:
            inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
            out = inflate.decompress(data, most + 1)
        except zlib.error:
            return None, "broken gzip"
        if len(out) > most:
            return None, "too large when unpacked"
        if not inflate.eof:
            return None, "broken gzip"
        data = out
    return data.decode("utf-8", "replace"), None


def opened(documents: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    """documents (path, content binary) -> path, text, error: caps hold for the bytes and for what a gzip unpacks to."""

    @F.pandas_udf(_RAW)
    def run(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_opened(None if x is None else bytes(x), most) for x in content], columns=["text", "error"])

    return documents.select("path", run("content").alias("r")).select("path", "r.text", "r.error")


def read_documents(spark: SparkSession, path: str, most: int = MAX_BYTES) -> DataFrame:
    """Downloaded documents of a folder; files beyond the cap are reported without being read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = opened(files.filter(F.col("length") <= most).select("path", "content"), most)
    large = files.filter(F.col("length") > most).select("path", F.lit(None).cast("string").alias("text"), F.lit("too large").alias("error"))
    return small.unionByName(large)


# ------------------------------------------------------------------ RSS and Atom
def feed_entries(files: DataFrame, text: str = "text") -> DataFrame:
    """path, ENTRY: items of RSS and entries of Atom, also of malformed feeds; without link or id an item is dropped."""
    rows = files.select("path", F.posexplode(F.concat(F.transform(blocks(F.col(text), "item"), lambda b: b), F.transform(blocks(F.col(text), "entry"), lambda b: b))).alias("place", "b"))
    b = F.col("b")
    atom_link = F.coalesce(F.nullif(F.regexp_extract(b, r"(?is)<link\b(?=[^>]*rel=[\"']alternate[\"'])[^>]*href=[\"']([^\"']+)[\"']", 1), F.lit("")), F.nullif(F.regexp_extract(b, r"(?is)<link\b[^>]*href=[\"']([^\"']+)[\"']", 1), F.lit("")))
    some = lambda *names: F.coalesce(*[F.nullif(element(b, n), F.lit("")) for n in names])
    guid = some("guid", "id")
    link = F.coalesce(F.nullif(element(b, "link"), F.lit("")), atom_link, guid)
    image = F.nullif(F.regexp_extract(b, r"(?is)<(?:media:content|media:thumbnail|enclosure)\b[^>]*(?:url|href)=[\"']([^\"']+)[\"']", 1), F.lit(""))
    tags = F.transform(F.concat(F.regexp_extract_all(b, F.lit(r"(?is)<category\b[^>]*>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</category>"), 1), F.regexp_extract_all(b, F.lit(r"(?is)<category\b[^>]*term=[\"']([^\"']+)[\"']"), 1)), lambda t: F.trim(t))
    published = parse_time(some("pubDate", "published", "updated", "date"), "UTC")
    rows = rows.filter(link.isNotNull())
    return _entry(rows, "path", link=decoded_once(link), id=F.coalesce(guid, link), title=spaced(decoded_twice(element(b, "title"))), summary=spaced(decoded_once(some("description", "summary", "content"))), published=published, tags=tags, image=image)


def feed_errors(files: DataFrame, text: str = "text") -> DataFrame:
    """path, error: a feed that is not well-formed counts only if nothing could be read from it."""
    found = F.coalesce(F.size(blocks(F.col(text), "item")) + F.size(blocks(F.col(text), "entry")), F.lit(0))
    shape = F.coalesce(F.col(text), F.lit("")).rlike(r"(?is)<(rss|feed|rdf:RDF)\b.*</(rss|feed|rdf:RDF)>\s*$")
    return files.select("path", F.when((found == 0) & ~shape, "malformed feed without entries").alias("error"))


# ------------------------------------------------------------------ sitemaps
_MEDIA = r"(?is)<(image:image|video:video)\b[^>]*>.*?</\1>"


def is_index(text: Column) -> Column:
    return F.lower(F.left(text, F.lit(4000))).contains("<sitemapindex")


def sitemap_items(files: DataFrame, text: str = "text") -> DataFrame:
    """path, loc, published, title, language, keywords, image, news of urlset files.

    News fields are read inside <news:news> only, or outside of images and videos where there is no such block.
    """
    url = F.col("block")
    inner_news = F.regexp_extract(url, r"(?is)<news:news\b[^>]*>(.*?)</news:news>", 1)
    inner = F.when(inner_news != "", inner_news).otherwise(F.regexp_replace(url, _MEDIA, ""))
    rows = files.filter(~is_index(F.col(text))).select("path", F.posexplode(blocks(F.col(text), "url")).alias("place", "block"))
    rows = rows.withColumn("inner", inner).withColumn("news", F.lower(url).contains("publication_date")).filter(F.regexp_extract(url, r"(?is)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>", 1) != "")
    own = lambda name: F.when(F.col("news"), field(F.col("inner"), name)).otherwise("")
    loc = spaced(decoded_twice(F.regexp_extract(url, r"(?is)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>", 1)))
    dated = F.coalesce(F.nullif(element(F.col("inner"), "publication_date"), F.lit("")), F.nullif(F.regexp_extract(url, r"(?is)<lastmod>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</lastmod>", 1), F.lit("")))
    image = spaced(decoded_twice(F.regexp_extract(url, r"(?is)<image:loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</image:loc>", 1)))
    return rows.select("path", "place", loc.alias("loc"), parse_time(dated).alias("published"), own("title").alias("title"), F.lower(own("language")).alias("language"), own("keywords").alias("keywords"), image.alias("image"), "news")


def sitemap_children(files: DataFrame, text: str = "text") -> DataFrame:
    """path, loc, lastmod of the children of index files."""
    rows = files.filter(is_index(F.col(text))).select("path", F.posexplode(blocks(F.col(text), "sitemap")).alias("place", "b"))
    return rows.select("path", "place", field(F.col("b"), "loc").alias("loc"), parse_time(F.nullif(element(F.col("b"), "lastmod"), F.lit(""))).alias("lastmod")).filter("loc <> ''")


def fetch_news_sitemap(files: DataFrame, since: Column | None, now: Column, most: int = CHILDREN) -> DataFrame:
    """Entries of each sitemap, indexes followed one level: path (the root's), ENTRY.

    files: path (the URL), text.  Of an index whose children are dated, those modified a day before `since` or later are
    read, newest first, `most` at most.  Entries are kept once per URL, from since (48 hours at most) to an hour ahead;
    undated ones only where fewer than half of all items are dated.
    """
    floor = now - F.expr(f"INTERVAL {LOOKBACK_HOURS} HOURS")
    since = floor if since is None else F.greatest(since, floor)
    kids = sitemap_children(files).withColumn("dated", F.max(F.col("lastmod").isNotNull()).over(W.partitionBy("path")))
    kids = kids.filter(~F.col("dated") | (F.col("lastmod") >= since - F.expr("INTERVAL 24 HOURS")))
    kids = kids.withColumn("k", F.row_number().over(W.partitionBy("path").orderBy(F.desc_nulls_last("lastmod"), "place"))).filter(F.col("k") <= most)
    items = sitemap_items(files)
    roots = kids.select(F.col("path").alias("root"), F.col("loc").alias("path"), "k")
    known = kids.select(F.col("loc").alias("path")).distinct()
    own = items.join(known, "path", "left_anti").withColumn("root", F.col("path")).withColumn("k", F.lit(0))
    rows = own.unionByName(items.join(roots, "path").select(*own.columns))
    of_root = W.partitionBy("root")
    trust = F.count("published").over(of_root) >= F.greatest(F.lit(1), F.floor(F.count("*").over(of_root) / 2))
    rows = rows.withColumn("trust", trust).withColumn("first", F.row_number().over(W.partitionBy("root", "loc").orderBy("k", "place"))).filter("first = 1")
    fresh = (F.col("published") >= since) & (F.col("published") <= now + F.expr("INTERVAL 1 HOUR"))
    rows = rows.filter(F.when(F.col("published").isNull(), ~F.col("trust")).otherwise(fresh)).withColumn("path", F.col("root"))
    tags = F.filter(F.transform(F.split("keywords", ","), lambda t: F.trim(t)), lambda t: t != "")
    return _entry(rows, "path", link=F.col("loc"), title=F.col("title"), published=F.col("published"), language=F.nullif(L.normal_code(F.col("language")), F.lit("")), tags=tags, image=F.nullif("image", F.lit("")))


# ------------------------------------------------------------------ official listings
def release_listing(files: DataFrame, text: str = "text") -> DataFrame:
    """Press releases by ministry, each number once; the language follows the list number in the URL (path)."""
    parts = F.split(F.regexp_replace(F.col(text), r"(?s)<h3 class=['\"]font104['\"]>", "\u0001"), "\u0001")
    rows = files.select("path", F.posexplode(F.slice(parts, 2, 1_000_000)).alias("at", "part"))
    body = F.substring_index(F.expr("substring(part, locate('</h3>', part) + 5)"), "</div>", 1)
    pattern = r"(?s)<a[^>]+title=['\"](.*?)['\"][^>]+href=['\"][^'\"]*PRID=(\d+)[^'\"]*['\"][^>]*>(.*?)</a>"
    take = lambda g: F.regexp_extract_all(F.col("body"), F.lit(pattern), g)
    rows = rows.select("path", "at", F.trim(F.regexp_replace(decoded_once(F.substring_index("part", "</h3>", 1)), "<[^>]+>", "")).alias("ministry"), body.alias("body"))
    rows = rows.select("path", "at", "ministry", F.posexplode(F.arrays_zip(take(1).alias("t"), take(2).alias("n"), take(3).alias("x"))).alias("place", "m"))
    rows = rows.withColumn("first", F.row_number().over(W.partitionBy("path", "m.n").orderBy("at", "place"))).filter("first = 1")
    code = F.coalesce(F.nullif(F.regexp_extract("path", r"[?&]lang=(\d+)", 1), F.lit("")), F.lit("1"))
    language = F.try_element_at(F.create_map(*[F.lit(x) for kv in LIST_LANGUAGE.items() for x in kv]), code)
    title = F.coalesce(F.nullif(F.trim(F.regexp_replace("m.x", "<[^>]+>", "")), F.lit("")), F.col("m.t"))
    return _entry(rows, "path", link=F.concat(F.lit("https://www.pib.gov.in/PressReleasePage.aspx?PRID="), F.col("m.n")), title=spaced(decoded_once(title)), tags=F.array("ministry", F.lit("PIB")), language=language)


def daily_releases(today: DataFrame, yesterday: DataFrame, hour: int) -> DataFrame:
    """Today's listing, and before three in the morning what only yesterday's has."""
    out = release_listing(today)
    return out if hour >= 3 else out.unionByName(release_listing(yesterday).join(out.select("link"), "link", "left_anti").select(*out.columns))


def _filings(files: DataFrame, text: str) -> DataFrame:
    part = lambda name: F.trim(decoded_once(F.regexp_extract("b", rf"(?s)<{name}>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{name}>", 1))).alias(name)
    rows = files.select("path", F.explode(F.regexp_extract_all(F.col(text), F.lit("(?s)<item>(.*?)</item>"), 1)).alias("b"))
    return rows.select("path", part("link"), part("title"), part("description"), part("pubDate"), part("scripcode")).filter((F.col("link") != "") & ~F.col("description").rlike(FUND_NOTICE))


def first_exchange(files: DataFrame, text: str = "text") -> DataFrame:
    """Filings whose subject stands behind '|SUBJECT:' and whose symbol opens the link's file name."""
    rows, d = _filings(files, text), F.col("description")
    subject = F.when(d.contains("|SUBJECT:"), F.trim(F.expr("substring(description, locate('|SUBJECT:', description) + 9)"))).otherwise(d)
    symbol = F.substring_index(F.substring_index("link", "/", -1), "_", 1)
    title = F.when(subject != "", F.concat(F.col("title"), F.lit(": "), subject)).otherwise(F.col("title"))
    return _entry(rows, "path", link=F.col("link"), title=spaced(title), summary=spaced(F.replace(d, F.lit("|SUBJECT:"), F.lit(" — "))), published=parse_time(F.col("pubDate")), language=F.lit("en"), tags=F.filter(F.array(F.lit("NSE"), F.lit("corporate filing"), symbol), lambda t: t != ""))


def second_exchange(files: DataFrame, text: str = "text") -> DataFrame:
    """Filings with a scrip code; codes of funds (from 9,000,000) and bare 'nav' rows go."""
    rows, d = _filings(files, text), F.col("description")
    rows = rows.filter(~(F.col("scripcode").rlike(r"^\d+$") & (F.coalesce(F.expr("try_cast(scripcode as bigint)"), F.lit(9_000_000)) >= 9_000_000)) & (F.lower(F.trim(d)) != "nav"))
    company = F.regexp_replace("title", r"\s*\(\d+\)\s*$", "")
    title = F.when((d != "") & ~F.lower(d).isin("as attached", "-"), F.concat(company, F.lit(": "), d)).otherwise(company)
    return _entry(rows, "path", link=F.col("link"), title=spaced(F.left(title, F.lit(500))), summary=F.nullif(spaced(d), F.lit("")), published=parse_time(F.col("pubDate")), language=F.lit("en"), tags=F.filter(F.array(F.lit("BSE"), F.lit("corporate filing"), F.col("scripcode")), lambda t: t != ""))


def regulator_listing(files: DataFrame, text: str = "text") -> DataFrame:
    """Rows of the regulator's table: day, category, link, title (a title may hold a nested link)."""
    pattern = r"(?s)<tr[^>]*>\s*<td>([^<]+)</td>\s*<td>([^<]*)</td>\s*<td>\s*<a href='([^']+)'[^>]*title=\"(.*?)\""
    take = lambda g: F.regexp_extract_all(F.col(text), F.lit(pattern), g)
    rows = files.select("path", F.explode(F.arrays_zip(take(1).alias("d"), take(2).alias("c"), take(3).alias("l"), take(4).alias("t"))).alias("m"))
    title = spaced(F.regexp_replace(decoded_once(F.col("m.t")), "(?s)<.*", ""))
    return _entry(rows, "path", link=F.trim("m.l"), title=title, published=parse_time(F.trim("m.d")), language=F.lit("en"), tags=F.filter(F.array(F.lit("SEBI"), F.trim("m.c")), lambda t: t != ""))


READERS = {"pib_daily": release_listing, "nse_announcements": first_exchange, "bse_announcements": second_exchange, "sebi_listing": regulator_listing}


def entries_of(feeds: DataFrame, since: Column | None, now: Column) -> DataFrame:
    """feeds (path, feed_type, text) -> path, ENTRY: the feed type picks the reader, RSS and Atom where it is unknown."""
    kind = F.lower(F.trim(F.coalesce("feed_type", F.lit(""))))
    named = feeds.withColumn("kind", F.when(kind.isin("news_sitemap", *READERS), kind).otherwise("feed"))
    out = feed_entries(named.filter("kind = 'feed'")).unionByName(fetch_news_sitemap(named.filter("kind = 'news_sitemap'"), since, now))
    for name, reader in READERS.items():
        out = out.unionByName(reader(named.filter(F.col("kind") == name)))
    return out


# ------------------------------------------------------------------ coverage lines, hand-off, catalogue
def gkg_urls(lines: DataFrame, hosts: DataFrame, text: str = "value") -> DataFrame:
    """url, host of the fifth TSV field where the host is known or ends in .in; each URL once."""
    url = F.trim(F.get(F.split(F.col(text), "\t"), F.lit(4)))
    rows = lines.select(url.alias("url")).filter(F.col("url").startswith("http")).withColumn("host", U.host_key(F.col("url")))
    known = hosts.select("host").distinct().withColumn("known", F.lit(True))
    return rows.join(known, "host", "left").filter(F.col("known") | F.col("host").endswith(".in")).select("url", "host").distinct()


def read_handoff(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All gzipped JSON lines under a root."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").json(root)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The feed catalogue, text columns trimmed and blanks made null."""
    rows = spark.read.csv(path, header=True)
    return rows.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) for c in rows.columns])


# ------------------------------------------------------------------ sitemap discovery
def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """robots (host, text) -> host, url, place: Sitemap lines, each once, in order."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?im)^\s*sitemap\s*:\s*(\S+)"), 1))
    return robots.select("host", F.posexplode(found).alias("place", "url"))


def discovered(entries: DataFrame, least: int = 5, news_share: float = 0.5, query_share: float = 0.3, covered: float = 0.7) -> DataFrame:
    """entries (host, sitemap, link, title; fresh ones) -> host, sitemap, fresh, verdict.

    A sitemap needs `least` fresh links, titles on half of them, and few links with a query.  Of those left, ordered
    by having titles and by size, one is dropped if a kept one has most of its links.  Overlaps are counted by a join
    on links; the ordered choice sees counts only, one row for each pair of sitemaps of a host.
    """
    links = entries.groupBy("host", "sitemap").agg(F.count("*").alias("fresh"), F.count_if(F.coalesce("title", F.lit("")) != "").alias("news"), F.count_distinct("link").alias("links"), F.count_distinct(F.when(F.col("link").contains("?"), F.col("link"))).alias("asks"))
    verdict = F.when(F.col("fresh") < least, "too few").when(F.col("news") < news_share * F.col("fresh"), "not news-sitemap protocol").when(F.col("asks") > query_share * F.col("links"), "query-string URLs")
    judged = links.withColumn("verdict", verdict)
    good = judged.filter("verdict is null")
    own = entries.select("host", "sitemap", "link").distinct().join(good.select("host", "sitemap"), ["host", "sitemap"])
    both = own.alias("a").join(own.alias("b"), F.expr("a.host = b.host and a.link = b.link and a.sitemap <> b.sitemap")).groupBy(F.col("a.host").alias("host"), F.col("a.sitemap").alias("sitemap"), F.col("b.sitemap").alias("other")).agg(F.count("*").alias("shared"))
    pairs = good.join(both, ["host", "sitemap"], "left").select("host", "sitemap", "fresh", "news", "links", "other", "shared")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        shared = {(r.sitemap, r.other): r.shared for r in pdf.itertuples() if isinstance(r.other, str)}
        once = pdf.drop_duplicates("sitemap").sort_values("sitemap")
        once = once.assign(titled=once["news"] > 0).sort_values(["titled", "fresh"], ascending=False, kind="stable")
        kept: list[str] = []
        said = []
        for r in once.itertuples():
            if any(shared.get((r.sitemap, k), 0) >= covered * r.links for k in kept):
                said.append("covered by a kept sitemap")
            else:
                kept.append(r.sitemap)
                said.append("kept")
        return pd.DataFrame({"host": once["host"], "sitemap": once["sitemap"], "fresh": once["fresh"], "verdict": said})

    chosen = pairs.groupBy("host").applyInPandas(choose, "host string, sitemap string, fresh bigint, verdict string")
    return judged.filter("verdict is not null").select("host", "sitemap", "fresh", "verdict").unionByName(chosen)


def packed(text: str) -> bytes:
    """gzip with no time in it, for fixtures and sinks."""
    return gzip.compress(text.encode(), mtime=0)
