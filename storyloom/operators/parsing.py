"""Queries of page and entry parsing: over all pages together with hand-made ones, whose expected rows are written out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions import pages as P
from storyloom.functions import text as T
from storyloom.operators.stories import read
from storyloom.plans.cases import values
from storyloom.plans.registry import query

LONG = "Rain fell on the hills and the river rose past the old bridge before noon. " * 8
#: page_id, url, html.
PAGES = [
    (-1, "https://n.example/a/1", """<html><head><title>  Plain
 title </title><meta property="og:title" content="First"><meta property='og:title' content=' Second '><meta content="turned" property="og:site_name"><meta content="late" property="og:title">
<meta property="og:image" content="https://i.example/og.jpg"><meta property="fb:app" content="1"><meta property="article:published_time" content="2026-01-02T10:00:00"><meta property="og:video" content="https://v.example/o.mp4">
<link rel="canonical" href=" https://n.example/a "><script type="application/ld+json">{"@type": "NewsArticle", "author": {"name": " Ann "}, "image": {"url": "https://i.example/ld.jpg"}, "datePublished": "2026-01-01T05:30:00+05:30"}</script></head>
<body><iframe src="https://www.youtube.com/embed/abcdefghijk"></iframe><iframe src="https://player.vimeo.com/video/77"></iframe><video src="/m.mp4?x=1"></video><source src="https://v.example/o.mp4"></body></html>"""),
    (-2, "https://n.example/b/2", """<script type='application/ld+json'>{broken</script><script type="application/ld+json">["x", {"@type": "Thing"}, {"@type": ["Article"], "author": ["Bo", "Cy"], "image": ["", {"contentUrl": "https://i.example/list.png"}], "dateCreated": "2026-02-03"}]</script>
<title>Only title</title><meta name="twitter:image" content="https://i.example/tw.png"><img src="/logo.png"><img src="data:image/png;base64,x"><img src="/p/photo.JPG?w=3"><iframe src="../web/?file=/docs/order.PDF"></iframe>"""),
    (-3, "https://n.example/c/3", """<script type="application/ld+json">{"@graph": [{"@type": "BlogPosting", "author": [{"name": "Di"}], "image": "https://i.example/graph.webp"}]}</script><img src="icon.png"><img src='pix/a.webp'>
<a href="x.html">x</a><a href="files/r%20.pdf#page=2">r</a><nav><p>menu menu</p></nav><p>"""
     + LONG[:230] + "<div>no paragraph</div><p>Second <b>bold</b>part &amp; end.</p><footer><p>foot</p></footer>"),
    (-4, "https://www.pib.gov.in/x", "<div>Posted On: 06 OCT 2026 10:05AM by</div><p>short</p>"),
    (-5, None, None),
    (-6, "https://n.example/e", "<img src='a.svg'><embed src='doc.pdf'>Posted On: 06 OCT 2026 10:05AM"),
]


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", "url", "html").unionByName(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"))


def flat(tags: Column) -> Column:
    """A map as sorted text, so that both engines compare it."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


_TAGS = values(
    [
        (-1, "article:published_time=2026-01-02T10:00:00|canonical=https://n.example/a|og:image=https://i.example/og.jpg|og:site_name=turned|og:title=Second|og:video=https://v.example/o.mp4"),
        (-2, "og:image=https://i.example/tw.png|og:title=Only title"), (-3, ""), (-4, ""), (-5, ""), (-6, ""),
    ], "page_id, tags",
)


@query("x11_og_tags", rf"SELECT page_id, 'og:title=' || trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>([^<]+)</title>', 1), '\s+', ' ', 'g')) AS tags FROM pages UNION ALL {_TAGS}")
def x11_og_tags(spark, sf_dir):
    return all_pages(spark, sf_dir).select("page_id", flat(P.og_tags(F.col("html"))).alias("tags"))


@query("x12_jsonld", "SELECT page_id, false AS found, NULL AS author, NULL AS image, NULL AS published, NULL AS created FROM pages UNION ALL " + values(
    [(-1, True, "Ann", "https://i.example/ld.jpg", "2026-01-01T05:30:00+05:30", None), (-2, True, "Bo", "https://i.example/list.png", None, "2026-02-03"), (-3, True, "Di", "https://i.example/graph.webp", None, None), *[(k, False, None, None, None, None) for k in (-4, -5, -6)]],
    "page_id, found, author, image, published, created"))
def x12_jsonld(spark, sf_dir):
    return all_pages(spark, sf_dir).select("page_id", P.linked_data("html").alias("l")).select("page_id", "l.*")


@query("x13_videos", values(
    [(-1, 0, "og_video", "https://v.example/o.mp4"), (-1, 1, "youtube", "https://www.youtube.com/watch?v=abcdefghijk"), (-1, 2, "vimeo", "https://vimeo.com/77"), (-1, 3, "direct_video", "/m.mp4?x=1")], "page_id, place, type, url"))
def x13_videos(spark, sf_dir):
    """A video that two sources name stands once; the pages of the test data have none."""
    rows = all_pages(spark, sf_dir).withColumn("tags", P.og_tags(F.col("html")))
    return rows.select("page_id", F.posexplode(P.videos(F.col("tags"), F.col("html"))).alias("place", "v")).select("page_id", "place", "v.type", "v.url")


@query("x14_pick_image", "SELECT page_id, '' AS image FROM pages UNION ALL " + values(
    [(-1, "https://i.example/og.jpg"), (-2, "https://i.example/tw.png"), (-3, "https://i.example/graph.webp"), (-4, ""), (-5, ""), (-6, "")], "page_id, image"))
def x14_pick_image(spark, sf_dir):
    """og, then JSON-LD, then the first photo of the page."""
    rows = all_pages(spark, sf_dir).select("page_id", "url", "html", P.og_tags(F.col("html")).alias("tags"), P.linked_data("html").alias("l"))
    rows = rows.withColumn("photo", P.absolute("url", P.first_photo(F.col("html"))))
    return rows.select("page_id", P.pick(F.try_element_at("tags", F.lit("og:image")), F.col("l.image"), F.col("photo")).alias("image"))


@query("x14_first_photo", "SELECT page_id, NULL AS image FROM pages UNION ALL " + values([(-1, None), (-2, "https://n.example/p/photo.JPG?w=3"), (-3, "https://n.example/c/pix/a.webp"), (-4, None), (-5, None), (-6, None)], "page_id, image"))
def x14_first_photo(spark, sf_dir):
    return all_pages(spark, sf_dir).select("page_id", P.absolute("url", P.first_photo(F.col("html"))).alias("image"))


_HIDE = "html"
for _tag in ("script", "style", "nav", "header", "footer", "aside", "form", "figure", "figcaption"):
    _HIDE = rf"regexp_replace({_HIDE}, '(?is)<{_tag}\b.*?</{_tag}>', '', 'g')"
_THIRD = (LONG[:230] + " Second bold part & end.").replace("  ", " ")


@query("x22_paragraphs", rf"""WITH v AS (SELECT page_id, {_HIDE} AS h FROM pages), s AS (SELECT page_id, list_transform((string_split(regexp_replace(h, '(?i)<p(\s[^>]*)?>', chr(1), 'g'), chr(1)))[2:], lambda x: regexp_replace(x, '(?is)</p>.*$', '')) AS ps FROM v),
t AS (SELECT page_id, trim(regexp_replace(replace(replace(regexp_replace(array_to_string(ps, ' '), '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS t FROM s)
SELECT page_id, CASE WHEN length(t) >= 200 THEN t ELSE '' END AS body FROM t UNION ALL """ + values([(-1, ""), (-2, ""), (-3, _THIRD), (-4, ""), (-5, ""), (-6, "")], "page_id, body"))  # fmt: skip
def x22_paragraphs(spark, sf_dir):
    return all_pages(spark, sf_dir).select("page_id", P.paragraphs("html").alias("body"))


@query("x24_linked_pdf", "SELECT page_id, NULL AS pdf FROM pages UNION ALL " + values(
    [(-1, None), (-2, "https://n.example/docs/order.PDF"), (-3, "https://n.example/c/files/r%20.pdf"), (-4, None), (-5, None), (-6, "https://n.example/doc.pdf")], "page_id, pdf"))
def x24_linked_pdf(spark, sf_dir):
    """Discovery only: decoding a PDF needs a library that is not here."""
    return all_pages(spark, sf_dir).select("page_id", P.linked_pdf("html", "url").alias("pdf"))


# ------------------------------------------------------------------ entries
_UTC = dt.timezone.utc
_AT = dt.datetime(2026, 1, 5, 12, 0, tzinfo=_UTC)
_BODY = "<p>Body &amp; soul</p> " + LONG
#: ENTRY rows; page -k of PAGES belongs to entry k.
ENTRIES = [
    (1, ["https://m.example/v.mp4", "https://m.example/a.PNG?x"], [("image/jpeg", "https://e.example/e.jpg")], ["https://t.example/t.jpg"], "<b>Short</b>", "<i>A description of</i>  more than twenty", ["<p>c</p>"], ("text/html", _BODY), None, "Tue, 06 Jan 2026 10:30:00", None, " Feed Author "),
    (2, ["https://m.example/v.mp4"], [("audio/mp3", "x.mp3"), ("image/png", ""), ("image/png", "https://e.example/2.png")], ["https://t.example/t.jpg"], None, None, ["", "<p>The content &amp; all</p>"], ("text/plain", _BODY), _AT, "Mon, 05 Jan 2026 12:00:00 GMT", None, "B"),
    (3, [], [], ["https://t.example/3.jpg"], "A summary long enough to be kept", "never", [_BODY], None, None, "rubbish", "Wed, 07 Jan 2026 08:00:00 +0000", ""),
    (4, [], [], [], "", "", [], None, None, None, None, None),
    (5, None, None, None, None, None, None, None, None, None, None, None),
]


def entries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENTRIES, P.ENTRY)


_CLEAN = ("Body & soul " + LONG).strip()


@query("x15_entry_fields", values(
    [(1, "https://m.example/a.PNG?x", "A description of more than twenty", len(_CLEAN)), (2, "https://e.example/2.png", "The content &amp; all", 0), (3, "https://t.example/3.jpg", "A summary long enough to be kept", len(_CLEAN)), (4, "", "", 0), (5, "", "", 0)],
    "id, image, description, fulltext_chars"))
def x15_entry_fields(spark, sf_dir):
    """Image, description and full text of feed entries."""
    rows = entries(spark).withColumn("clean", P.stripped_all("content")).withColumn("clean_detail", F.get(P.stripped_all(F.array("detail.value")), F.lit(0)))
    return rows.select("id", P.entry_image().alias("image"), P.entry_description().alias("description"), F.length(P.entry_fulltext(F.col("clean"), F.col("clean_detail"))).alias("fulltext_chars"))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each entry with its page's metadata."""
    p = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").select((-F.col("page_id")).alias("id"), "url", "html", P.og_tags(F.col("html")).alias("tags"), P.linked_data("html").alias("l"))
    return entries(spark).join(p, "id")


_D = "make_timestamp({})"


@query("x16_publish_date", "SELECT id, CAST(epoch(t) AS BIGINT) AS t FROM (VALUES (1, TIMESTAMP '2026-01-01 00:00:00'), (2, TIMESTAMP '2026-01-05 12:00:00'), (3, TIMESTAMP '2026-01-07 08:00:00'), (4, NULL), (5, NULL)) AS v(id, t)")
def x16_publish_date(spark, sf_dir):
    """Feed time, JSON-LD with its zone, og, feed text; null where nothing parses."""
    at = P.publish_date(F.col("parsed"), F.col("l.published"), F.col("l.created"), F.try_element_at("tags", F.lit("article:published_time")), F.col("published"), F.col("updated"))
    return joined(spark, sf_dir).select("id", F.unix_timestamp(at).alias("t"))


@query("x17_local_time", """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE least(1767571200 - doc_id % 500 * 1200 - CASE WHEN doc_id % 3 = 0 AND (doc_id % 4 = 0 OR lang IN ('hi', 'ta')) THEN 19800 ELSE 0 END, 1767571200 - doc_id % 997 * 600) END AS t FROM documents""")
def x17_local_time(spark, sf_dir):
    """Dates whose text has no zone, of feeds that are Indian by country, shift; none passes the crawl time."""
    at = F.when(F.col("doc_id") % 7 != 0, F.timestamp_seconds(1767571200 - F.col("doc_id") % 500 * 1200))
    said = F.when(F.col("doc_id") % 3 == 0, "Mon, 05 Jan 2026 12:00:00").otherwise(F.get(F.array(F.lit("x 12:00:00 GMT"), F.lit("2026-01-05T12:00:00+05:30"), F.lit("2026-01-05T12:00:00Z")), (F.col("doc_id") % 3).cast("int")))
    country = F.when(F.col("doc_id") % 4 == 0, "in").otherwise("GB")
    crawled = F.timestamp_seconds(1767571200 - F.col("doc_id") % 997 * 600)
    return read(spark, sf_dir, "documents").select("doc_id", F.unix_timestamp(P.local_time(at, said, country, F.col("lang"), crawled)).alias("t"))


@query("x18_posted_on", "SELECT page_id, CASE WHEN page_id = -4 THEN CAST(epoch(TIMESTAMP '2026-10-06 04:35:00') AS BIGINT) END AS t FROM (SELECT page_id FROM pages UNION ALL SELECT unnest([-1, -2, -3, -4, -5, -6])) x")
def x18_posted_on(spark, sf_dir):
    return all_pages(spark, sf_dir).select("page_id", F.unix_timestamp(P.posted_on(F.col("html"), F.col("url"))).alias("t"))


@query("x19_author", values([(1, "Ann"), (2, "Bo"), (3, "Di"), (4, ""), (5, "")], "id, author"))
def x19_author(spark, sf_dir):
    """JSON-LD, then og, then the feed."""
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    author = P.pick(F.col("l.author"), F.trim(tag("article:author")), F.trim(tag("og:author")), F.trim("author"))
    return joined(spark, sf_dir).select("id", author.alias("author"))


@query("x19_feed_author", values([(1, "Feed Author"), (2, "B"), (3, ""), (4, ""), (5, "")], "id, author"))
def x19_feed_author(spark, sf_dir):
    return entries(spark).select("id", P.pick(F.trim("author")).alias("author"))


@query("x41_crawl_merge", values(
    [
        (1, "kept", "page says", "https://i.example/og.jpg", "Ann", 1000, "html"), (2, "Second", "old", "old.png", "old", 2000, "html"), (3, "kept", "page says", "", "Di", None, "pdf"), (4, "", "old", "old.png", "old", 4000, "failed"),
    ], "id, title, description, image, author, published, strategy"))
def x41_crawl_merge(spark, sf_dir):
    """A feed title stays; what the page has replaces description, image and author; its date fills only a missing one; a thin page takes its PDF's text."""
    feed = [(1, "kept", "old", "old.png", "old", 1000), (2, "", "old", "old.png", "old", None), (3, "kept", "old", "old.png", "old", None), (4, "", "old", "old.png", "old", 4000)]
    page = [(1, "First", "page says", "https://i.example/og.jpg", "Ann", 9000, 900, None), (2, "Second", None, None, None, 2000, 900, None), (3, "Third", "page says", "", "Di", None, 10, "x.pdf"), (4, None, None, None, None, None, None, None)]
    f = spark.createDataFrame(feed, "id bigint, title string, description string, image string, author string, published bigint")
    p = spark.createDataFrame(page, "id bigint, ptitle string, pdescription string, pimage string, pauthor string, ppublished bigint, body_chars bigint, pdf string")
    won = lambda c: F.coalesce(f"p{c}", c).alias(c)
    title = F.when(F.coalesce("title", F.lit("")) == "", F.left(F.coalesce("ptitle", F.lit("")), F.lit(P.TITLE))).otherwise(F.col("title")).alias("title")
    strategy = F.when(F.col("body_chars").isNull(), "failed").when((F.col("body_chars") < 200) & F.col("pdf").isNotNull(), "pdf").otherwise("html")
    return f.join(p, "id").select("id", title, won("description"), won("image"), won("author"), F.coalesce("published", "ppublished").alias("published"), strategy.alias("strategy"))


# ------------------------------------------------------------------ text choice
_FRAMES = "[" + ", ".join(f"'{w}'" for w in P.FRAME_WORDS) + "]"


@query("x21_best_fulltext", rf"""WITH c AS (SELECT doc_id, unnest([coalesce(text, ''), split_part(text, chr(10), 1) || repeat(' Subscribe tap', CAST(doc_id % 5 AS INTEGER)), left(text, 300)]) AS t, unnest([1, 2, 3]) AS place FROM documents),
w AS (SELECT doc_id, place, list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '') AS w FROM c WHERE t <> ''),
s AS (SELECT doc_id, place, CASE WHEN len(w) = 0 THEN 0 ELSE len(w) * (1 - least(4.0 * len(list_filter(w, lambda x: list_contains({_FRAMES}, lower(x)))) / len(w), 0.9)) END AS s FROM w)
SELECT doc_id, CAST(round(max(s), 4) AS DOUBLE) AS score FROM s GROUP BY 1 UNION ALL SELECT doc_id, 0.0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM s)""")  # fmt: skip
def x21_best_fulltext(spark, sf_dir):
    """The best of three candidates: the whole text, its headline with frame words, its first 300 characters."""
    framed = F.concat(F.substring_index("text", "\n", 1), F.repeat(F.lit(" Subscribe tap"), (F.col("doc_id") % 5).cast("int")))
    best = P.best_scored(F.array("text", framed, F.left("text", F.lit(300))))
    return read(spark, sf_dir, "documents").select("doc_id", F.round(F.coalesce(best["s"], F.lit(0.0)), 4).alias("score"))


@query("x20_clean_cases", values(
    [(1, "Keep this\n\nand this"), (2, "One two"), (3, ""), (4, ""), (5, "a\n\nb")], "id, cleaned"))
def x20_clean_cases(spark, sf_dir):
    """Boilerplate lines, bare links, lone handles and the artefact token go; blank lines collapse."""
    rows = [(1, "Keep this\nAlso read: other\n\n\n\nand this\nhttps://x.example/y\n@handle"), (2, "One  text_fields two"), (3, None), (4, "All rights reserved"), (5, "a\n \n\n \nb\nClick here to win")]
    return spark.createDataFrame(rows, "id bigint, text string").select("id", T.cleaned_article(F.col("text")).alias("cleaned"))
