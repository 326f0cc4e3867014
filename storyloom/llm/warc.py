"""WARC derivatives: response records -> linked metadata and plain-text conversion records.

Responses are rows of WARC fields and an HTTP message.  Each gives one metadata record (title, language, links)
and one conversion record (plain text); both keep target URI and date, refer to the response by its id, and carry
the response's HTTP headers whole and its digests beside digests of their own.  Text and
entities are read by page in Arrow batches, in linear time even where pages are broken.
"""

from __future__ import annotations

import gzip
import html as entities
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import small_batches

DATE = "2026-01-01T00:00:00Z"
#: Opens what holds no text; ends of it by name.
_OPENS = re.compile(r"<!--|<(script|style|head|nav|noscript|template)\b", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "head", "nav", "noscript", "template")}
#: Elements that end a line.
_BLOCK = re.compile(r"<(?:/?(?:p|div|h[1-6]|li|ul|ol|tr|table|article|section|blockquote|header|footer|main|body|html)|br|hr)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[^<>]*>")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


def record_id(kind: Column, *of: Column) -> Column:
    """A name-like id that the same input always gets, in the form of a UUID."""
    h = F.md5(F.concat_ws("\u001f", kind, *[F.coalesce(x.cast("string"), F.lit("")) for x in of]).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(x: Column) -> Column:
    return F.concat(F.lit("sha1:"), F.sha1(x.cast("binary")))


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """All named and numeric entities decoded as HTML5 has it; a no-break space is a space."""
    return texts.map(lambda t: entities.unescape(t).replace("\xa0", " ") if isinstance(t, str) and "&" in t else t)


def visible(html: str) -> str:
    """The page without comments and elements that hold no text; one that is never closed stays.

    An end that was not found once is not sought again, so broken pages take linear time too.
    """
    out, at, pos, open_ended = [], 0, 0, set()
    while m := _OPENS.search(html, pos):
        name, end = (m[1] or "").lower(), None
        if name not in open_ended:
            if not name:
                end = html.find("-->", m.end()) + 3
            elif (k := html.find(">", m.end())) >= 0 and (close := _ENDS[name].search(html, k + 1)):
                end = close.end()
            if not end or end < m.end():
                open_ended.add(name)
                end = None
        if end is None:
            pos = m.end()
            continue
        out += [html[at : m.start()], " "]
        at = pos = end
    return "".join(out) + html[at:]


def page_text(html: str) -> str:
    """Plain text of a page: lines at block elements, tags out, entities decoded, space collapsed."""
    x = _TAG.sub("", _BLOCK.sub("\n", _SPACE.sub(" ", visible(html))))
    x = re.sub(r"[ \t\r\f\v]+", " ", entities.unescape(x).replace("\xa0", " "))
    return re.sub(r" ?\n[ \n]*", "\n", x).strip(" \n")


@F.pandas_udf(StringType())
def plain_text(html: pd.Series) -> pd.Series:
    return html.map(lambda x: None if x is None else page_text(x))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of crawled pages: warc_type, record_id, target_uri, warc_date, http_headers, payload, digests.

    Null url and html count as empty.  Pages that repeat a page_id, url and html get the same record id.
    """
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    rows = pages.select(F.col("page_id"), url.alias("target_uri"), html.alias("payload"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    rows = rows.withColumn("http_headers", head).withColumn("payload_digest", digest(F.col("payload")))
    return rows.select(
        "page_id", F.lit("response").alias("warc_type"), record_id(F.lit("response"), F.col("page_id"), F.col("target_uri"), F.col("payload_digest")).alias("record_id"),
        "target_uri", F.lit(date).alias("warc_date"), "http_headers", "payload", "payload_digest", digest(F.concat("http_headers", "payload")).alias("block_digest"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each response: its metadata and its conversion record.

    page_id, warc_type, record_id, refers_to, concurrent_to (the sibling derivative), target_uri, warc_date,
    content_type, content_length, block_digest, source_content_type, source_http_headers (status line and all headers
    as they came), source_payload_digest, source_block_digest, block.  Records of other types give nothing.  Null
    payloads give an empty block; repeated records give repeated rows.
    """
    small_batches(records.sparkSession)
    rows = records.filter("warc_type = 'response'").withColumn("payload", F.coalesce("payload", F.lit("")))
    source_type = F.regexp_extract("http_headers", r"(?i)(?:^|\r\n)Content-Type: ([^\r\n]*)", 1)
    title = F.regexp_extract("payload", r"(?i)<title[^<>]*>([^<]*)", 1)
    title = F.trim(F.regexp_replace(unescape(title), r"\s+", " "))
    lang = F.regexp_extract("payload", r"(?i)<html[^<>]*\slang=[\"']([^\"']*)", 1)
    links = F.regexp_extract_all("payload", F.lit(r"(?i)<a\s(?:[^<>]*\s)?href=[\"']([^\"']*)"), 1)
    rows = rows.withColumns({"title_text": title, "plain_text": plain_text("payload")})
    meta = F.concat(
        F.lit("title: "), F.col("title_text"), F.lit("\r\nlanguage: "), lang, F.lit("\r\nfetched-payload-digest: "), F.coalesce("payload_digest", F.lit("")),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("\r\noutlink: "), x)), ""), F.lit("\r\n"),
    )
    ids = {k: record_id(F.lit(k), F.col("record_id")) for k in ("metadata", "conversion")}
    made = lambda kind, other, content, block: F.struct(F.lit(kind).alias("warc_type"), ids[kind].alias("id"), ids[other].alias("concurrent_to"), F.lit(content).alias("content_type"), block.alias("block"))
    both = F.array(made("metadata", "conversion", "application/warc-fields", meta), made("conversion", "metadata", "text/plain; charset=utf-8", F.col("plain_text")))
    rows = rows.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "warc_date", source_type.alias("source_content_type"), F.col("http_headers").alias("source_http_headers"), F.col("payload_digest").alias("source_payload_digest"), F.col("block_digest").alias("source_block_digest"), F.explode(both).alias("d"))
    return rows.select(
        "page_id", "d.warc_type", F.col("d.id").alias("record_id"), "refers_to", "d.concurrent_to", "target_uri", "warc_date", "d.content_type",
        F.octet_length("d.block").cast("bigint").alias("content_length"), digest(F.col("d.block")).alias("block_digest"), "source_content_type", "source_http_headers", "source_payload_digest", "source_block_digest", F.col("d.block").alias("block"),
    )


def serialize(row: dict) -> bytes:
    """One derivative as a gzip member of a WARC 1.1 file; source headers go percent-encoded into one field."""
    block = row["block"].encode()
    row = row | {"source_http_headers": quote(row.get("source_http_headers") or "", safe=" /:;,=()<>@[]?{}\"'+*&#!$|^`")}
    named = (
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Content-Type", "source_content_type"), ("WARC-Source-HTTP-Headers", "source_http_headers"), ("WARC-Source-Payload-Digest", "source_payload_digest"),
        ("WARC-Source-Block-Digest", "source_block_digest"), ("Content-Type", "content_type"),
    )
    head = "".join(f"{name}: {row[k]}\r\n" for name, k in named if row.get(k))
    return gzip.compress(f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n", mtime=0)


def parse(data: bytes) -> Iterator[dict]:
    """The records of a WARC file as header dicts with the block under 'block'."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        yield fields | {"block": rest[:n]}
        data = rest[n + 4 :]
