"""Text rules as native column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from storyloom.functions.hashes import murmur3_low, sha_heads



# A line that holds one of these is no article text.
ARTICLE_BOILERPLATE = (
    r"also\s+read|read\s+also|read\s+more|more\s+on\s+this", r"related\s+(news|stories|articles|coverage)", r"you\s+may\s+(also\s+)?like|don.t\s+miss",
    r"subscribe\s+(to|now|for|here)|sign\s+up\s+(for|to|here)", r"join\s+our\s+(newsletter|channel|group|community|telegram|whatsapp)", r"follow\s+us\s+on|download\s+(the\s+)?(app|our\s+app)",
    r"get\s+(the\s+)?(latest|breaking|live)\s+news", r"stay\s+updated|for\s+latest\s+updates", r"share\s+(this\s+)?(article|story|post|on)|tweet\s+this|share\s+via",
    r"copyright\s+©|©\s+\d{4}|all\s+rights\s+reserved", r"terms\s+of\s+(use|service)|privacy\s+policy", r"advertisement|sponsored\s+content|partner\s+content|paid\s+post",
    r"click\s+here\s+to|tap\s+here\s+to|watch\s+live\s+on", r"disclaimer\s*:|editor.?s\s+note\s*:|correction\s*:", r"independent\.co\.uk|please\s+allow\s+a\s+moment",
)
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def cleaned_article(text: Column) -> Column:
    """The text without boilerplate lines, bare URLs, lone handles and the artefact token; null texts are empty."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]")
    strip = lambda x: F.regexp_replace(x, _EDGES, "")
    bad = "(?iU)" + "|".join(ARTICLE_BOILERPLATE)
    kept = F.filter(lines, lambda x: ~(strip(x).rlike(bad) | strip(x).rlike(r"(?U)^https?://\S+\z") | strip(x).rlike(r"(?U)^@\w{1,30}\z")))
    kept = F.transform(kept, lambda x: F.when(strip(x) == "", "").otherwise(x))
    out = strip(F.regexp_replace(F.array_join(kept, "\n"), "\n{3,}", "\n\n"))
    return strip(F.regexp_replace(F.regexp_replace(out, r"(?U)\btext_fields\b", ""), "  +", " "))


def _folded_words(text: str | None) -> list[str]:
    return re.findall("[a-z0-9]+", unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode().lower())


#: Characters of texts whose words are held at once.
CHUNK_CHARS = 1_000_000


def chunks(texts: list[str | None], most: int) -> Iterator[list[str | None]]:
    """The texts in order, in runs of about `most` characters."""
    lo = size = 0
    for hi, t in enumerate(texts, 1):
        size += len(t or "") + 1
        if size >= most or hi == len(texts):
            yield texts[lo:hi]
            lo, size = hi, 0


def simhashes(texts: list[str | None], hashed: Callable[[list[bytes]], np.ndarray], most: int = CHUNK_CHARS) -> np.ndarray:
    """64-bit SimHashes; words are held for a run of texts at a time, whatever the batch.  No words give 0."""
    return np.concatenate([np.zeros(0, np.int64), *[_simhashes(c, hashed) for c in chunks(texts, most)]])


def _simhashes(texts: list[str | None], hashed: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """One hash table and sums of bit rows for a run of texts."""
    words = [_folded_words(t) for t in texts]
    out = np.zeros(len(texts), np.int64)
    known = sorted({w for ws in words for w in ws})
    if not known:
        return out
    bits = np.unpackbits(hashed([w.encode() for w in known]).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    place = {w: k for k, w in enumerate(known)}
    for r, ws in enumerate(words):
        if ws:
            at, n = np.unique([place[w] for w in ws], return_counts=True)
            out[r] = np.packbits(n @ bits[at] > 0).view(">i8")[0]
    return out


@F.pandas_udf(LongType())
def simhash(text: pd.Series) -> pd.Series:
    """SimHash over ASCII-folded words, each occurrence a vote, words hashed by the head of their SHA-256."""
    return pd.Series(simhashes(text.tolist(), sha_heads))


@F.pandas_udf(LongType())
def murmur_simhash(text: pd.Series) -> pd.Series:
    """The same with words hashed by Murmur3."""
    return pd.Series(simhashes(text.tolist(), lambda ws: murmur3_low(ws).view(np.uint64)))
