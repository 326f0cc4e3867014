"""Queries of the sources, over hand-made documents with their expected rows and over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators.stories import read
from storyloom.plans.cases import values
from storyloom.plans.registry import query
from storyloom.sources import feeds as S

NOW = dt.datetime(2026, 1, 5, 12, 0, tzinfo=dt.timezone.utc)
RSS = """<?xml version="1.0"?><rss><channel><title>Feed</title><item><title><![CDATA[Rain &amp;amp; wind]]></title><link>https://f.example/1?a=1&amp;b=2</link><description>&lt;b&gt;Heavy&lt;/b&gt; rain</description><pubDate>Mon, 05 Jan 2026 10:00:00 +0530</pubDate><category>Weather</category><enclosure url="https://f.example/1.jpg" type="image/jpeg"/></item>
<item><title>By guid</title><guid>https://f.example/2</guid><pubDate>rubbish</pubDate></item><item><title>nothing to link</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>tag:1</id><title>Atom one</title><link rel="self" href="https://a.example/self"/><link rel="alternate" href="https://a.example/1"/><summary>short</summary><updated>2026-01-05T09:00:00Z</updated><category term="Sport"/></entry></feed>"""
BROKEN = "<rss><item><title>Kept</title><link>https://b.example/1</link></item><oops"
_NEWS = '<news:news><news:publication_date>{}</news:publication_date><news:title>{}</news:title><news:language>tn</news:language><news:keywords>rain, , wind</news:keywords></news:news>'
URLSET = "<urlset>" + "".join([
    "<url><loc>https://s.example/1</loc><image:image><image:loc>https://s.example/1.jpg</image:loc><image:title>file.jpg</image:title></image:image>" + _NEWS.format("2026-01-05T11:00:00+05:30", "One &amp;amp; only") + "</url>",
    "<url><loc><![CDATA[https://s.example/2]]></loc>" + _NEWS.format("2026-01-05T17:00:00", "Local time") + "</url>",
    "<url><loc>https://s.example/3</loc><lastmod>2026-01-01T00:00:00Z</lastmod></url>", "<url><loc>https://s.example/4</loc></url>", "<url><lastmod>2026-01-05</lastmod></url>",
    "<url><loc>https://s.example/1</loc><lastmod>2026-01-05T10:00:00Z</lastmod></url>", "<url><loc>https://s.example/5</loc><lastmod>2026-01-05T14:00:00Z</lastmod></url>",
]) + "</urlset>"
INDEX = "<sitemapindex><sitemap><loc>https://s.example/old.xml</loc><lastmod>2026-01-01</lastmod></sitemap><sitemap><loc>https://s.example/new.xml</loc><lastmod>2026-01-05T08:00:00Z</lastmod></sitemap><sitemap><loc>https://s.example/none.xml</loc></sitemap></sitemapindex>"
UNDATED = "<urlset><url><loc>https://u.example/1</loc></url><url><loc>https://u.example/2</loc></url><url><loc>https://u.example/3</loc></url><url><loc>https://u.example/4</loc><lastmod>2026-01-05T10:00:00Z</lastmod></url></urlset>"
RELEASES = """<h3 class="font104">Ministry &amp; Co</h3><ul><li><a title='Attr one' href='/x.aspx?PRID=11&reg=3'>Title <b>one</b></a></li><li><a title='Attr two' href='/x.aspx?PRID=12'></a></li></ul><h3 class='font104'>Second</h3><a title='again' href='/y?PRID=11'>dup</a><a title='c' href='/y?PRID=13'>Three</a></div><a title='out' href='/y?PRID=99'>outside</a>"""
YESTERDAY = """<h3 class="font104">Second</h3><a title='c' href='/y?PRID=13'>Three</a><a title='d' href='/y?PRID=14'>Late</a></div>"""
FIRST = """<item><title>Acme</title><link>https://n.example/f/ACME_1.pdf</link><description>Board|SUBJECT: Results &amp; dividend</description><pubDate>05-Jan-2026 12:39:10</pubDate></item><item><title>Fund</title><link>https://n.example/f/F_1.pdf</link><description>NAV as on today</description></item><item><title>No link</title><link></link><description>x</description></item>
<item><title>Plain</title><link>https://n.example/f/PL_2.pdf</link><description></description><pubDate>bad</pubDate></item>"""
SECOND = """<item><title>Beta Ltd (500001)</title><link>https://b.example/1</link><description>Outcome</description><scripcode>500001</scripcode><pubDate>05-Jan-2026 01:00:00</pubDate></item><item><title>Gamma</title><link>https://b.example/2</link><description>As Attached</description><scripcode>500002</scripcode></item>
<item><title>Fund</title><link>https://b.example/3</link><description>x</description><scripcode>9000000</scripcode></item><item><title>Nav</title><link>https://b.example/4</link><description>NAV</description><scripcode>1</scripcode></item>"""
LISTING = """<tr role='row'><td>Jan 05, 2026</td><td>Orders</td><td><a href='https://g.example/o1.html' target='_blank' title="Order in X &lt;a href=x">t</a></td></tr><tr><td>someday</td><td></td><td> <a href='https://g.example/o2.html' title="Second">t</a></td></tr>"""


def files(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), "path string, text string")


def shown(df: DataFrame) -> DataFrame:
    """Entries with times as seconds and tags as one text."""
    return df.select("path", "link", "title", "summary", F.unix_timestamp("published").alias("published"), "language", F.array_join("tags", ",").alias("tags"), "image")


def at(text: str) -> int:
    return int(dt.datetime.fromisoformat(text).timestamp())


_E = "path, link, title, summary, published, language, tags, image"


@query("s1_bounded_documents", values([("a", "plain", None), ("b", "packed text", None), ("c", None, "too large"), ("d", None, "too large when unpacked"), ("e", None, "broken gzip"), ("f", None, "no content"), ("g", "", None)], "path, text, error"))
def s1_bounded_documents(spark, sf_dir):
    """Size caps on the bytes and on what a gzip unpacks to."""
    rows = [("a", b"plain"), ("b", S.packed("packed text")), ("c", b"x" * 200), ("d", S.packed("x" * 5000)), ("e", S.packed("cut")[:-6]), ("f", None), ("g", b"")]
    return S.opened(spark.createDataFrame(rows, "path string, content binary"), 100)


_FEEDS = [
    ("rss", "https://f.example/1?a=1&b=2", "Rain & wind", "<b>Heavy</b> rain", at("2026-01-05T04:30:00+00:00"), None, "Weather", "https://f.example/1.jpg"), ("rss", "https://f.example/2", "By guid", None, None, None, "", None),
    ("atom", "https://a.example/1", "Atom one", "short", at("2026-01-05T09:00:00+00:00"), None, "Sport", None), ("broken", "https://b.example/1", "Kept", None, None, None, "", None),
]


@query("s2_feed_entries", values(_FEEDS, _E))
def s2_feed_entries(spark, sf_dir):
    return shown(S.feed_entries(files(spark, ("rss", RSS), ("atom", ATOM), ("broken", BROKEN), ("empty", "<html>no feed"), ("null", None))))


@query("s2_feed_errors", values([("rss", None), ("atom", None), ("broken", None), ("empty", "malformed feed without entries"), ("quiet", None), ("null", "malformed feed without entries")], "path, error"))
def s2_feed_errors(spark, sf_dir):
    return S.feed_errors(files(spark, ("rss", RSS), ("atom", ATOM), ("broken", BROKEN), ("empty", "<html>no feed"), ("quiet", "<rss></rss>"), ("null", None)))


@query("s3_parse_sitemap", values([
    (0, "https://s.example/1", at("2026-01-05T05:30:00+00:00"), "One & only", "tn", "rain, , wind", "https://s.example/1.jpg", True), (1, "https://s.example/2", at("2026-01-05T11:30:00+00:00"), "Local time", "tn", "rain, , wind", "", True),
    (2, "https://s.example/3", at("2026-01-01T00:00:00+00:00"), "", "", "", "", False), (3, "https://s.example/4", None, "", "", "", "", False), (5, "https://s.example/1", at("2026-01-05T10:00:00+00:00"), "", "", "", "", False), (6, "https://s.example/5", at("2026-01-05T14:00:00+00:00"), "", "", "", "", False),
], "place, loc, published, title, language, keywords, image, news"))
def s3_parse_sitemap(spark, sf_dir):
    return S.sitemap_items(files(spark, ("m", URLSET), ("i", INDEX))).withColumn("published", F.unix_timestamp("published")).drop("path")


_S = [("https://s.example/1", at("2026-01-05T05:30:00+00:00"), "One & only", "ta", "rain,wind", "https://s.example/1.jpg"), ("https://s.example/2", at("2026-01-05T11:30:00+00:00"), "Local time", "ta", "rain,wind", None)]


@query("s4_news_sitemap", values([(p, u, t, None, d, g, k, i) for p in ("https://s.example/index.xml",) for u, d, t, g, k, i in _S] + [(f"https://u.example/{p}", f"https://u.example/{k}", "", None, at("2026-01-05T10:00:00+00:00") if k == 4 else None, None, "", None) for p in ("all.xml",) for k in (1, 2, 3, 4)], _E))
def s4_news_sitemap(spark, sf_dir):
    """An index with one fresh child (its undated and stale links go, as most are dated), and a sitemap that dates hardly any."""
    docs = files(spark, ("https://s.example/index.xml", INDEX), ("https://s.example/new.xml", URLSET), ("https://u.example/all.xml", UNDATED))
    return shown(S.fetch_news_sitemap(docs, None, F.lit(NOW)))


_PIB = "https://www.pib.gov.in/PressReleasePage.aspx?PRID="
_REL = [(_PIB + "11", "Title one", "Ministry & Co,PIB"), (_PIB + "12", "Attr two", "Ministry & Co,PIB"), (_PIB + "13", "Three", "Second,PIB")]


@query("s6_press_releases", values([("x?reg=3&lang=2", u, t, None, None, "hi", g, None) for u, t, g in _REL], _E))
def s6_press_releases(spark, sf_dir):
    return shown(S.release_listing(files(spark, ("x?reg=3&lang=2", RELEASES))))


@query("s7_first_exchange", values([("n", "https://n.example/f/ACME_1.pdf", "Acme: Results & dividend", "Board — Results & dividend", at("2026-01-05T07:09:10+00:00"), "en", "NSE,corporate filing,ACME", None), ("n", "https://n.example/f/PL_2.pdf", "Plain", "", None, "en", "NSE,corporate filing,PL", None)], _E))
def s7_first_exchange(spark, sf_dir):
    return shown(S.first_exchange(files(spark, ("n", FIRST))))


@query("s8_second_exchange", values([("b", "https://b.example/1", "Beta Ltd: Outcome", "Outcome", at("2026-01-04T19:30:00+00:00"), "en", "BSE,corporate filing,500001", None), ("b", "https://b.example/2", "Gamma", "As Attached", None, "en", "BSE,corporate filing,500002", None)], _E))
def s8_second_exchange(spark, sf_dir):
    return shown(S.second_exchange(files(spark, ("b", SECOND))))


@query("s9_regulator_listing", values([("g", "https://g.example/o1.html", "Order in X", None, at("2026-01-04T18:30:00+00:00"), "en", "SEBI,Orders", None), ("g", "https://g.example/o2.html", "Second", None, None, "en", "SEBI", None)], _E))
def s9_regulator_listing(spark, sf_dir):
    return shown(S.regulator_listing(files(spark, ("g", LISTING))))


@query("s10_daily_releases", values([("t", u, g) for u, _, g in _REL] + [("y", _PIB + "14", "Second,PIB")], "path, link, tags"))
def s10_daily_releases(spark, sf_dir):
    """Before three in the morning yesterday's late releases are added, those known already are not."""
    return shown(S.daily_releases(files(spark, ("t", RELEASES)), files(spark, ("y", YESTERDAY)), 2)).select("path", "link", "tags")


@query("s11_dispatch", values([("rss", "https://f.example/1?a=1&b=2"), ("rss", "https://f.example/2"), ("p", _PIB + "11"), ("p", _PIB + "12"), ("p", _PIB + "13"), ("n", "https://n.example/f/ACME_1.pdf"), ("n", "https://n.example/f/PL_2.pdf"), ("b", "https://b.example/1"), ("b", "https://b.example/2"), ("g", "https://g.example/o1.html"), ("g", "https://g.example/o2.html"), *[("u", f"https://u.example/{k}") for k in (1, 2, 3, 4)]], "path, link"))
def s11_dispatch(spark, sf_dir):
    """The feed type picks the reader; what it does not know is read as RSS or Atom."""
    rows = [("rss", None, RSS), ("p", "PIB_daily ", RELEASES), ("n", "nse_announcements", FIRST), ("b", "bse_announcements", SECOND), ("g", "sebi_listing", LISTING), ("u", "news_sitemap", UNDATED)]
    return S.entries_of(spark.createDataFrame(rows, "path string, feed_type string, text string"), None, F.lit(NOW)).select("path", "link")


@query("s16_coverage_urls", r"""WITH h AS (SELECT DISTINCT regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(trim(url), '^[^:/?#]+://([^/?#:]*)', 1)), '^www\.', ''), '^m\.', ''), '^amp\.', '') AS host, trim(url) AS url, page_id FROM pages WHERE url LIKE 'http%')
SELECT DISTINCT url, host FROM h WHERE host IN (SELECT host FROM h WHERE page_id % 3 = 0) UNION SELECT 'https://www.x.co.in/1', 'x.co.in'""")  # fmt: skip
def s16_coverage_urls(spark, sf_dir):
    """Lines of a tab-separated log; hosts are known from every third page."""
    p = read(spark, sf_dir, "pages")
    lines = p.select(F.concat_ws("\t", F.lit("d"), F.lit("s"), F.lit("1"), F.lit("src"), "url", F.lit("rest")).alias("value"))
    more = spark.createDataFrame([("a\tb\tc\td\thttps://www.x.co.in/1\te",), ("too\tshort",), ("a\tb\tc\td\tftp://y.in/1\te",), (None,)], "value string")
    hosts = p.filter("page_id % 3 = 0 and url like 'http%'").select(S.U.host_key(F.col("url")).alias("host"))
    return S.gkg_urls(lines.unionByName(more), hosts)


@query("s17_discover_sitemaps", values([("h", "big", 20, "kept"), ("h", "part", 10, "covered by a kept sitemap"), ("h", "own", 8, "kept"), ("h", "few", 4, "too few"), ("h", "bare", 9, "not news-sitemap protocol"), ("h", "asks", 10, "query-string URLs"), ("g", "part", 6, "kept")], "host, sitemap, fresh, verdict"))
def s17_discover_sitemaps(spark, sf_dir):
    rows = [("h", "big", f"u{i}", "t") for i in range(20)] + [("h", "part", f"u{i + 12}", "t") for i in range(10)] + [("h", "own", f"o{i}", "t" if i < 4 else None) for i in range(8)] + [("h", "few", f"f{i}", "t") for i in range(4)]
    rows += [("h", "bare", f"b{i}", "t" if i < 4 else "") for i in range(9)] + [("h", "asks", f"q{i}" + ("?x" if i < 4 else ""), "t") for i in range(10)] + [("g", "part", f"u{i}", "t") for i in range(6)]
    return S.discovered(spark.createDataFrame(rows, "host string, sitemap string, link string, title string"))


@query("s17_robots", values([("h", 0, "https://h/a.xml"), ("h", 1, "https://h/b.xml")], "host, place, url"))
def s17_robots(spark, sf_dir):
    return S.robots_sitemaps(spark.createDataFrame([("h", "User-agent: *\n Sitemap: https://h/a.xml\nSITEMAP:https://h/b.xml\nsitemap: https://h/a.xml\n# no"), ("g", None)], "host string, text string"))
