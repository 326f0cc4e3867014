"""Page and entry parsing: metadata, linked data, media, dates, authors, text of paragraphs.

Regular shapes are native expressions; JSON-LD, paragraphs and relative links go through Arrow batches.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Callable
from html.parser import HTMLParser
from urllib.parse import parse_qs, urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from storyloom.sources.feeds import parse_time

TITLE, DESCRIPTION, IMAGE, AUTHOR, BODY = 1000, 2000, 500, 300, 80_000
_Q, _V = "[\"']([^\"']+)[\"']", "[\"']([^\"']*)[\"']"
_PHOTO = r"\.(?:jpe?g|png|webp|gif)(?:\?|$)"
# Names in an image's path that mean it is no photo; elements that hold no article text.
NO_PHOTO = "logo|icon|sprite|pixel|spacer|avatar|blank|1x1"
NO_TEXT = frozenset(("script", "style", "nav", "header", "footer", "aside", "form", "figure", "figcaption"))
_ENDS_PARAGRAPH = frozenset(("p", "div", "ul", "ol", "table", "section", "article", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "main", "pre", "hr"))
LINKED = StructType([StructField("found", BooleanType()), *[StructField(c, StringType()) for c in ("author", "image", "published", "created")]])


def collapsed(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


@F.pandas_udf(StringType())
def unescaped(x: pd.Series) -> pd.Series:
    """All named and numeric entities decoded."""
    return x.map(lambda t: entities.unescape(t) if isinstance(t, str) and "&" in t else t)


def _pairs(html: Column, pattern: str, key: int, value: int) -> Column:
    """Matches as array<struct(k, v)>, kept where the key is a metadata property."""
    take = lambda g: F.regexp_extract_all(html, F.lit(pattern), g)
    found = F.transform(F.arrays_zip(take(key).alias("k"), take(value).alias("v")), lambda p: F.struct(F.trim(p["k"]).alias("k"), F.trim(p["v"]).alias("v")))
    return F.filter(found, lambda p: p["k"].rlike("^(og:|article:|twitter:)"))


def og_tags(html: Column) -> Column:
    """map of og:, article: and twitter: properties, with canonical link, twitter image and title where og has none.

    Of one property written name first the last counts; content-first ones only fill in, the first of them.
    """
    html = F.coalesce(html, F.lit(""))
    named = _pairs(html, rf"(?is)<meta[^>]+property={_Q}[^>]+content={_V}", 1, 2)
    turned = _pairs(html, rf"(?is)<meta[^>]+content={_V}[^>]+property={_Q}", 2, 1)
    # in reverse, so that everywhere the first of a key is the one that counts
    both = F.concat(F.reverse(named), turned)
    first = F.filter(F.transform(both, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i"))), lambda p: F.array_position(F.transform(both, lambda q: q["k"]), p["k"]) == p["i"] + 1)
    tags = F.map_from_entries(F.transform(first, lambda p: F.struct(p["k"], p["v"])))
    extra = lambda name, pattern: F.when(html.rlike(pattern), F.create_map(F.lit(name), F.trim(F.regexp_extract(html, pattern, 1)))).otherwise(F.create_map().cast("map<string,string>"))
    lacking = lambda name, made: F.when(F.map_contains_key(tags, F.lit(name)), F.create_map().cast("map<string,string>")).otherwise(made)
    title = F.when(html.rlike(r"(?is)<title[^>]*>[^<]+</title>"), F.create_map(F.lit("og:title"), collapsed(F.regexp_extract(html, r"(?is)<title[^>]*>([^<]+)</title>", 1)))).otherwise(F.create_map().cast("map<string,string>"))
    tags_canonical = F.map_filter(tags, lambda k, v: k != "canonical")
    return F.map_concat(
        tags_canonical, extra("canonical", rf"(?is)<link[^>]+rel=[\"']canonical[\"'][^>]+href={_V}"), lacking("og:image", extra("og:image", rf"(?is)<meta[^>]+name=[\"']twitter:image[\"'][^>]+content={_V}")), lacking("og:title", title),
    )


_SCRIPT = re.compile(r"<script[^>]+type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>", re.S | re.I)


def _articles(html: str):
    """Objects that call themselves an article, in page order."""
    for block in _SCRIPT.findall(html):
        try:
            data = json.loads(block.strip())
        except ValueError:
            continue
        level = data if isinstance(data, list) else [data]
        graphs = [x for o in level if isinstance(o, dict) and isinstance(o.get("@graph"), list) for x in o["@graph"]]
        yield from (o for o in [*level, *graphs] if isinstance(o, dict) and re.search("Article|BlogPosting", str(o.get("@type", ""))))


def _first(value, *keys: str) -> str | None:
    """A text out of a string, an object with one of the keys, or the first such item of a list."""
    for v in value if isinstance(value, list) else [value]:
        found = v if isinstance(v, str) else next((v[k] for k in keys if isinstance(v, dict) and isinstance(v.get(k), str) and v[k].strip()), None)
        if found and found.strip():
            return found.strip()
    return None


def _linked(html: str | None) -> dict:
    o = next(_articles(html or ""), None)
    if o is None:
        return {"found": False, "author": None, "image": None, "published": None, "created": None}
    author = o.get("author")
    author = _first(author[:1] if isinstance(author, list) else author if isinstance(author, dict) else None, "name")
    date = lambda k: o[k] if isinstance(o.get(k), str) else None
    return {"found": True, "author": author, "image": _first(o.get("image"), "url", "contentUrl"), "published": date("datePublished"), "created": date("dateCreated")}


@F.pandas_udf(LINKED)
def linked_data(html: pd.Series) -> pd.DataFrame:
    """The first article of a page's JSON-LD, reduced to what the engine uses; broken blocks are passed over."""
    return pd.DataFrame([_linked(x) for x in html], columns=["found", "author", "image", "published", "created"])


def videos(tags: Column, html: Column) -> Column:
    """array<struct(type, url)>, each URL once: metadata, players, embeds, direct files."""
    html = F.coalesce(html, F.lit(""))
    tag = lambda k: F.try_element_at(tags, F.lit(k))
    one = lambda kind, url: F.array(F.struct(F.lit(kind).alias("type"), url.alias("url")))
    many = lambda kind, pattern, front: F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), lambda x: F.struct(F.lit(kind).alias("type"), F.concat(F.lit(front), x).alias("url")))
    every = F.concat(
        one("og_video", F.coalesce(F.nullif(tag("og:video:url"), F.lit("")), tag("og:video"))), one("twitter_player", tag("twitter:player")), many("youtube", r"(?i)(?:youtube\.com/embed/|youtu\.be/)([A-Za-z0-9_-]{11})", "https://www.youtube.com/watch?v="),
        many("vimeo", r"(?i)player\.vimeo\.com/video/(\d+)", "https://vimeo.com/"), many("direct_video", r"(?i)<(?:video|source)[^>]+src=[\"']([^\"']+\.(?:mp4|webm|ogg|m3u8)(?:\?[^\"']*)?)[\"']", ""),
    )
    some = F.filter(every, lambda v: F.coalesce(v["url"], F.lit("")) != "")
    urls = F.transform(some, lambda v: v["url"])
    return F.filter(some, lambda v, i: F.array_position(urls, v["url"]) == i + 1)


@F.pandas_udf(StringType())
def absolute(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link as seen from its page."""
    return pd.Series([urljoin(b or "", x) if isinstance(x, str) and x else x for b, x in zip(base, link, strict=True)], dtype=object)


def first_photo(html: Column) -> Column:
    """The src of the first <img> that looks like a photo, as written; null if none does."""
    found = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(f"(?i)<img[^>]+src={_Q}"), 1), lambda t: F.trim(t))
    return F.get(F.filter(found, lambda s: (s != "") & ~s.startswith("data:") & ~s.rlike(f"(?i){NO_PHOTO}") & s.rlike(f"(?i){_PHOTO}")), F.lit(0))


def pick(*choices: Column) -> Column:
    """The first that is not empty; ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices], F.lit(""))


# ------------------------------------------------------------------ entries of feeds
#: An entry as feeds give it.
ENTRY = (
    "id bigint, media array<string>, enclosures array<struct<type:string,href:string>>, thumbnails array<string>, summary string, description string, content array<string>, "
    "detail struct<type:string,value:string>, parsed timestamp, published string, updated string, author string"
)


def entry_image(e: Column | None = None) -> Column:
    col = F.col if e is None else lambda c: e[c]
    photo = F.get(F.filter(col("media"), lambda u: u.rlike(f"(?i){_PHOTO}")), F.lit(0))
    enclosed = F.get(F.filter(col("enclosures"), lambda x: F.contains(x["type"], F.lit("image")) & (F.coalesce(x["href"], F.lit("")) != "")), F.lit(0))["href"]
    return pick(photo, enclosed, F.get(col("thumbnails"), F.lit(0)))


def plain(html: Column) -> Column:
    return collapsed(F.regexp_replace(html, "<[^>]+>", " "))


def entry_description() -> Column:
    """Summary or description of more than 20 characters without markup, else the first content; 2,000 at most."""
    long = lambda c: F.when(F.length(plain(F.col(c))) > 20, plain(F.col(c)))
    some = F.get(F.filter("content", lambda x: x != ""), F.lit(0))
    return F.left(F.coalesce(long("summary"), long("description"), plain(some), F.lit("")), F.lit(DESCRIPTION))


def entry_fulltext(clean: Column, clean_detail: Column) -> Column:
    """The first content of 500 characters or more, else a long HTML detail.  Both come without markup and entities."""
    long = F.get(F.filter(clean, lambda x: F.length(x) >= 500), F.lit(0))
    return F.left(F.coalesce(long, F.when((F.col("detail.type") == "text/html") & (F.length(clean_detail) >= 500), clean_detail), F.lit("")), F.lit(BODY))


@F.pandas_udf(ArrayType(StringType()))
def stripped_all(xs: pd.Series) -> pd.Series:
    """Markup out, entities decoded, space collapsed, item by item."""
    return xs.map(lambda x: None if x is None else [None if t is None else re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]+>", " ", t))).strip() for t in x])


def publish_date(parsed: Column, published: Column, created: Column, og: Column, said: Column, updated: Column) -> Column:
    """The feed's parsed time, then JSON-LD, then og, then the feed's text; a time without zone is UTC."""
    return F.coalesce(parsed, *[parse_time(x, "UTC") for x in (published, created, og, said, updated)])


# Languages whose feeds are Indian.
INDIC = ("hi", "mr", "bn", "ta", "te", "kn", "ml", "gu", "pa", "ur", "or", "as", "sa", "ne", "kok", "mai", "mni")


def local_time(at: Column, said: Column, country: Column, language: Column, crawled: Column) -> Column:
    """A zone-less date of an Indian feed is five and a half hours earlier; no date is later than the crawl."""
    zone = said.rlike(r"([+-]\d{2}:?\d{2}|(?<=\d)Z|\bGMT|\bUTC|\b[A-Z]{2,5}T)\s*$")
    naive = (F.coalesce(said, F.lit("")) != "") & ~zone
    indian = F.upper(F.coalesce(country, F.lit(""))).isin("IN", "IND") | F.lower(F.substring_index(F.coalesce(language, F.lit("")), "-", 1)).isin(*INDIC)
    return F.when(at.isNotNull(), F.least(F.when(naive & indian, at - F.expr("INTERVAL '05:30' HOUR TO MINUTE")).otherwise(at), crawled))


def posted_on(html: Column, url: Column) -> Column:
    """The 'Posted On' time that one official site prints in local time; null elsewhere."""
    raw = F.regexp_replace(F.regexp_extract(html, r"(?i)Posted On:\s*(\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2}\s*[AP]M)", 1), r"(?U)\s*([AaPp][Mm])$", " $1")
    shaped = F.initcap(F.regexp_replace(raw, r"\s+", " "))
    at = F.try_to_timestamp(F.concat(F.substring_index(shaped, " ", 4), F.lit(" "), F.upper(F.substring_index(shaped, " ", -1))), F.lit("d MMM yyyy h:mm a"))
    return F.when(url.contains("pib.gov.in"), F.to_utc_timestamp(at, "Asia/Kolkata"))


# ------------------------------------------------------------------ text of pages
class _Paragraphs(HTMLParser):
    """Text of <p> elements outside of NO_TEXT; a block element or the next <p> ends a paragraph."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.inside, self.parts = 0, False, []

    def handle_starttag(self, tag, attrs):
        if tag in NO_TEXT:
            self.hidden += 1
        elif tag in _ENDS_PARAGRAPH and not self.hidden:
            self.inside = tag == "p"

    def handle_endtag(self, tag):
        if tag in NO_TEXT:
            self.hidden = max(0, self.hidden - 1)
        elif tag in _ENDS_PARAGRAPH and not self.hidden:
            self.inside = False

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.parts.append(data)


@F.pandas_udf(StringType())
def paragraphs(html: pd.Series) -> pd.Series:
    """The text of a page's paragraphs, '' under 200 characters."""

    def one(x: str | None) -> str:
        p = _Paragraphs()
        p.feed(x or "")
        p.close()
        text = re.sub(r"\s+", " ", " ".join(p.parts)).strip()
        return text if len(text) >= 200 else ""

    return html.map(one)


@F.pandas_udf(StringType())
def linked_pdf(html: pd.Series, base: pd.Series) -> pd.Series:
    """The document that a thin page wraps: an iframe (also a viewer's `file`) first, then the first linked .pdf."""

    def one(page: str | None, url: str | None) -> str | None:
        frames = re.findall(r"<iframe[^>]+src=['\"]([^'\"]+)['\"]", page or "", re.I)
        links = re.findall(r"(?:href|src)=['\"]([^'\"]+?\.pdf)(?:[?#][^'\"]*)?['\"]", page or "", re.I)
        for raw in map(entities.unescape, frames + links):
            at = parse_qs(urlparse(raw).query).get("file", [raw])[0]
            if urlparse(at).path.lower().endswith(".pdf"):
                return urljoin(url or "", at)
        return None

    return pd.Series([one(h, b) for h, b in zip(html, base, strict=True)], dtype=object)


# ------------------------------------------------------------------ best text
# Words that betray a page's frame.
FRAME_WORDS = ("subscribe", "newsletter", "follow", "advertisement", "click", "tap", "share", "tweet", "copyright", "disclaimer")


def _with(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x) with x computed once."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def text_score(text: Column) -> Column:
    """Words, less four times the share of frame words, by nine tenths at most.  The text is split once."""
    words = F.split(F.coalesce(text, F.lit("")), r"(?U)\s+")
    counted = _with(words, lambda ws: F.struct(F.size(F.filter(ws, lambda w: w != "")).alias("n"), F.size(F.filter(ws, lambda w: F.lower(w).isin(*FRAME_WORDS))).alias("framed")))
    return _with(counted, lambda c: F.when(c["n"] == 0, 0.0).otherwise(c["n"] * (1.0 - F.least(c["framed"] * 4.0 / c["n"], F.lit(0.9)))))


def best_scored(candidates: Column) -> Column:
    """struct(s, i, t): the text of an array that scores best, the first of equals, with its score; null if there is none."""
    return F.array_max(F.transform(F.filter(candidates, lambda t: F.coalesce(t, F.lit("")) != ""), lambda t, i: F.struct(text_score(t).alias("s"), (-i).alias("i"), t.alias("t"))))


def best_text(candidates: Column) -> Column:
    """Of an array of texts the one that scores best, the first of equals; '' if there is none."""
    return F.coalesce(best_scored(candidates)["t"], F.lit(""))
