"""The training-data operators against plain Python, brute force and the tokenizers library."""

from __future__ import annotations

import hashlib
import html as html_entities
import re
import time
import zlib
from collections import Counter, defaultdict
from urllib.parse import unquote

import numpy as np
import pytest
from pyspark.sql import functions as F

from storyloom.llm import bpe, chat, fingerprints, line_dedup, mixing, near_dedup, quality_classifier, queries, sharding, textstats, warc, weak_supervision
from storyloom.llm.components import connected_components

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, sketch string, key string, drops int, value int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = ["", None, " \n\t ", "one", "one", "two words", "Two Words", long, long + " end", "a b c d e f g h i j\nsame line that is long enough to count as one, forty chars\n" * 3]
    texts += [f"doc {i} own\n  Same LINE that is long enough to count as one, forty chars " for i in range(6)]
    texts += ["Σίσυφος ΟΔΟΣ <|endoftext|> é  x y 'S don't 12", "日本語テキスト🙂🙂", "</s>[INST] \\ ok"]
    rows = [(i, t, "en", "s0", 1, "x", "y", 1, 2) for i, t in enumerate(texts)]
    rows += [(3, "one", None, None, None, None, None, None, None), (None, "no id", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC).repartition(5)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# ---------------------------------------------------------------- near duplicates


def brute_components(pairs, width):
    sets = defaultdict(list)
    for i, t in pairs:
        w = words_of(lower(t))
        s = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
        sets[i].append(s)
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}, {i: {len(s) for s in sets[i]} for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_brute_force(docs, odd, width):
    for df in (docs, odd):
        want, sizes = brute_components([(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None], width)
        got = near_dedup.near_duplicates(df, width).collect()
        assert len(got) == df.count()
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id) and r.n_shingles in sizes[r.doc_id]


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 16, "SHORT": 8}, {"BLOCK": 40, "SHORT": 8, "WIDE": 30, "HOT": 10**6}, {"BLOCK": 16, "WIDE": 20, "HOT": 500}])
def test_near_duplicates_dense_group(spark, monkeypatch, limits):
    """A large group of near copies around one text, many just below the threshold; long lists and blocks are used."""
    for name, value in limits.items():
        monkeypatch.setattr(near_dedup, name, value)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        t = list(base)
        for at in rng.choice(120, rng.integers(0, 14), replace=False):
            t[at] = f"x{rng.integers(40)}"
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want, _ = brute_components(list(enumerate(texts)), 2)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, 2).collect()}
    assert got == want and 1 < len(set(want.values())) < 140


def test_near_duplicates_empty(none):
    assert near_dedup.near_duplicates(none).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


# ---------------------------------------------------------------- fingerprints


def test_fingerprints(docs, none):
    got = {r.doc_id: r for r in fingerprints.edits(docs).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order, errors = sorted(texts), []
    assert len(got) == len(order)
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        t, u = texts[a], texts[b]
        q = len(t) // 4
        edited = t[: len(t) - q] + u[:q]
        assert got[a].n_chars == len(t) and got[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        x, y = Counter(words_of(t)), Counter(words_of(edited))
        errors.append(got[a].near_edited - (sum((x & y).values()) / sum((x | y).values()) if x or y else 1))
        same = sum(got[a].fingerprint[k : k + 4] == got[b].fingerprint[k : k + 4] for k in range(0, 4 * fingerprints.SAMPLES, 4))
        assert got[a].near_next == pytest.approx(same / fingerprints.SAMPLES)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.12
    by_text = defaultdict(set)
    for i, t in texts.items():
        by_text[t].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert fingerprints.edits(none).collect() == []


def test_fingerprints_odd(odd):
    got = fingerprints.edits(odd).collect()
    assert len(got) == odd.count()
    blank = [r for r in got if r.doc_id in (0, 1, 2)]
    assert all(r.fingerprint == "" for r in blank) and [r.near_next for r in got if r.doc_id is None] == [None]
    assert len(fingerprints.fingerprints(odd).collect()) == odd.count()
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(odd).collect()}
    assert all(prints[r.doc_id] == r.fingerprint for r in got)


# ---------------------------------------------------------------- sharding


@pytest.mark.parametrize("buckets, bins", [(sharding.BUCKETS, sharding.BINS), (1, 16), (4, 256)])
def test_shards(docs, odd, none, buckets, bins):
    for df, n in ((docs, 16), (odd, 3)):
        got = sharding.shards(df, n, buckets, max(bins, n)).collect()
        texts = df.collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in texts)
        slots, loads, homes = defaultdict(list), Counter(), defaultdict(set)
        for r in got:
            slots[r.shard].append(r.slot)
            loads[r.shard] += r.size
            homes[r.text_crc32, r.size].add(r.shard)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())
        if df is docs:
            assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 16 + max(r.size for r in got)
    assert sharding.shards(none).collect() == []


@pytest.mark.parametrize("share", [0.1, 0.33])
def test_shards_hot_group(spark, share):
    """A hot group of equal texts: all other shards are as near equal as plain scheduling makes them."""
    rng = np.random.default_rng(7)
    sizes = np.clip(rng.lognormal(5, 0.8, 2250), 10, 3000).astype(int)
    texts = [f"{k} ".ljust(n, "x") for k, n in enumerate(sizes)]
    hot = "h" * 999
    texts += [hot] * int(share / (1 - share) * sizes.sum() / 1000)
    got = sharding.shards(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 16).collect()
    loads, own = Counter(), {r.shard for r in got if r.text_crc32 == zlib.crc32(hot.encode())}
    for r in got:
        loads[r.shard] += r.size
    cold = [n for s, n in loads.items() if s not in own]
    assert len(got) == len(texts) and len(own) == 1 and len(cold) == 15 and max(cold) <= 1.01 * min(cold)


def test_shards_are_plain_scheduling(docs):
    """Where every group has a bin of its own the shards are those of plain LPT over the groups, up to ties of size."""
    loads = Counter()
    for r in docs.collect():
        loads[(r.text or "").encode()] += len((r.text or "").encode()) + 1
    want = Counter()
    sizes = sorted(loads.values(), reverse=True)
    for size, shard in zip(sizes, sharding.lpt(sizes, 16), strict=True):
        want[shard] += size
    got = Counter()
    for r in sharding.shards(docs, 16, 1, 4096).collect():
        got[r.shard] += r.size
    assert sorted(got.values()) == sorted(want.values())


def test_lpt():
    assert sharding.lpt([7, 5, 4, 3, 1], 2) == [0, 1, 1, 0, 1]


# ---------------------------------------------------------------- BPE


def test_bpe_library(docs, odd, none):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(queries.vocabulary_path())
    for df in (docs, odd):
        got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encoded(df, queries.vocabulary_path()).collect())
        want = Counter()
        for r in df.collect():
            ids = lib.encode(r.text or "", add_special_tokens=False).ids
            want[r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)] += 1
        assert got == want
    assert bpe.encoded(none, queries.vocabulary_path()).collect() == []


def test_bpe_cuts_and_random_text():
    from tokenizers import Tokenizer

    lib, own = Tokenizer.from_file(queries.vocabulary_path()), bpe.WordBpe(bpe.load_spec(queries.vocabulary_path()))
    assert any(len(own.fragments(w.encode())) > 1 for w in ("zqxjkvwq", "éèêç", "日本"))
    rng = np.random.default_rng(3)
    chars = list("abcdefgqxz ÄÖßİſΣ'012 \n\t!?<|>éñ🙂漢ـéͅ\x1c\x85")
    for _ in range(300):
        t = "".join(rng.choice(chars, rng.integers(0, 60)))
        assert own.encode(t) == lib.encode(t, add_special_tokens=False).ids, repr(t)
    long = "zqx" * 20_000
    assert own.encode(long) == lib.encode(long, add_special_tokens=False).ids


# ---------------------------------------------------------------- WARC


def test_warc(spark):
    html = '<html lang="fr"><head><title>A &amp;  b</title><script>var t="</p>";</script></head><body><p>One<br>two</p><!-- x --><div>3 &lt; 4 <a href="/x">l</a></div></body></html>'
    pages = spark.createDataFrame([(1, "http://a/", html, 1), (1, "http://a/", html, 1), (2, None, None, None), (None, "http://b/", "", 3)], "page_id bigint, url string, html string, block int")
    responses = {r.record_id: r for r in warc.responses(pages).collect()}
    got = warc.derivatives(warc.responses(pages)).collect()
    assert len(got) == 8
    text = next(r for r in got if r.page_id == 1 and r.warc_type == "conversion")
    assert text.block == "One\ntwo\n3 < 4 l"
    meta = next(r for r in got if r.page_id == 1 and r.warc_type == "metadata")
    assert "title: A & b\r\nlanguage: fr" in meta.block and "outlink: /x" in meta.block
    for r in got:
        source = responses[r.refers_to]
        assert (r.target_uri, r.warc_date, r.source_payload_digest) == (source.target_uri, source.warc_date, source.payload_digest)
        assert r.block_digest == "sha1:" + hashlib.sha1(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode())
        (back,) = warc.parse(warc.serialize(r.asDict()))
        assert back["block"] == r.block.encode() and back["WARC-Refers-To"] == r.refers_to
    ids = {r.record_id: r for r in got}
    assert all(ids[r.concurrent_to].refers_to == r.refers_to for r in got)
    assert warc.derivatives(warc.responses(pages.limit(0))).collect() == []


def brute_text(html):
    """The same rules as one expression each."""
    x = re.sub(r"(?is)<!--.*?-->|<(script|style|head|nav|noscript|template)\b[^>]*>.*?</\1\s*>", " ", html)
    x = re.sub(r"[ \t\n\r\f\v]+", " ", x)
    x = re.sub(r"(?i)<(?:/?(?:p|div|h[1-6]|li|ul|ol|tr|table|article|section|blockquote|header|footer|main|body|html)|br|hr)\b[^<>]*>", "\n", x)
    x = html_entities.unescape(re.sub(r"<[^<>]*>", "", x)).replace("\xa0", " ")
    return re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\r\f\v]+", " ", x)).strip(" \n")


def test_page_text(spark):
    """Every page of the test data against the plain expressions, and broken pages in linear time."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    odd = ["", "<script>", "<!-- a <p>b", "a<!-- x -->b<script>c</script >d<STYLE>e</style>", "<nav>x<p>y", "<p><p<p>z", "<head>h</head><script>s", "x<template><template>y</template>z"]
    assert all(warc.page_text(x) == brute_text(x) for x in pages + odd)
    began = time.time()
    for x in ("<script>" * 200_000, "<!--" * 400_000, "<p" * 500_000, "<nav" * 300_000, "<title>" * 200_000, "&amp" * 300_000):
        warc.page_text(x)
    assert time.time() - began < 20


def test_warc_query_returns_blocks(spark):
    got = queries.op4_warc_derivatives(spark, SF).collect()
    assert len(got) == 2 * spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.block_digest == "sha1:" + hashlib.sha1(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode()) for r in got)


def test_warc_source_headers_and_entities(spark):
    """Every source header and digest is on both derivatives and in the file; all entities are decoded once."""
    head = "HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\nContent-Language: fr\r\nLast-Modified: Mon, 1 Jan 2024 00:00:00 GMT\r\nX: 50%\r\nX: é\r\n\r\n"
    html = "<title>&copy; &Eacute;t&eacute;</title><p>&copy; 2026 &middot; a&nbsp;b &#8217; &#x2019; &hellip; &amp;copy; &lt;p&gt; AT&T &nosuch;</p>"
    pages = spark.createDataFrame([(1, "http://a/", html)], "page_id bigint, url string, html string")
    source = warc.responses(pages).withColumn("http_headers", F.lit(head))
    (of,) = source.collect()
    got = warc.derivatives(source).collect()
    assert {r.warc_type for r in got} == {"metadata", "conversion"} and len(got) == 2
    for r in got:
        assert (r.source_http_headers, r.source_block_digest, r.source_content_type) == (head, of.block_digest, "text/html")
        (back,) = warc.parse(warc.serialize(r.asDict()))
        assert unquote(back["WARC-Source-HTTP-Headers"]) == head and back["WARC-Source-Block-Digest"] == of.block_digest
        if r.warc_type == "conversion":
            assert r.block.endswith("© 2026 · a b ’ ’ … &copy; <p> AT&T &nosuch;")
        else:
            assert "title: © Été\r\n" in r.block


# ---------------------------------------------------------------- chat


def test_chat(spark):
    said = "</s>[INST] ok [/INST]"
    turns = [(-1, 0, "user", said), (-1, 1, "assistant", said), (1, 0, "user", "q"), (1, 1, "assistant", "a\\l\n"), (1, 2, "user", None), (2, 0, "assistant", "x"), (2, 1, "assistant", "y<s>[user]\n"), (3, 0, "system", ""), (None, None, None, "n"), (None, 1, "assistant", "m"), (4, 1, "ro]\nle", "z"), (4, 1, "ro]\nle", "z")]
    turns += [(9, i, "assistant" if i % 2 else "user", f"turn {i} [") for i in range(600)]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id bigint, turn bigint, role string, text string, segment string").repartition(4)
    examples = defaultdict(list)
    for r in chat.expand(df).collect():
        examples[r.conv_id].append(r)
    assert len([r for r in examples[9] if r.loss_start is not None]) == 300
    first, second = sorted(examples[2], key=lambda r: r.example)
    whole = chat.full_text([first.segment, second.segment], 1)
    start = second.prefix_chars + second.loss_start
    assert chat.unescape(whole[start : start + second.loss_chars]) == "y<s>[user]\n" and whole.startswith(first.segment)
    want = {}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        want[conv] = (len(own), hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.expand(df)).collect()}
    assert got == want
    assert chat.expand(df.limit(0)).collect() == []


def test_chat_whole_examples(spark):
    """Every example holds all turns before its reply; the span counts from the start of the whole text."""
    turns = [(c, i, "assistant" if i % 3 == 2 else "user", f"turn {i} [<s> of {c}") for c in (1, 2, None) for i in range(40)] + [(3, 0, "user", "q")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    got = {(r.conv_id, r.example): r for r in chat.whole_examples(chat.expand(df)).collect()}
    assert len(got) == 3 * 13
    for (conv, k), r in got.items():
        own = [t for t in turns if t[0] == conv][: 3 * k + 3]
        assert r.text == "".join(f"<s>[{t[2]}]\n{chat.escape(t[3])}</s>" for t in own)
        assert chat.unescape(r.text[r.loss_start : r.loss_start + r.loss_chars]) == own[-1][3]
    assert chat.whole_examples(chat.expand(df.limit(0))).collect() == []


def test_chat_reads_whole_examples(spark):
    """Digests come from examples that hold their whole context: a context or a loss that is wrong shows."""
    turns = [(c, i, "assistant" if i % 3 == 2 else "user", f"turn {i} [<s> of {c}") for c in (1, None) for i in range(10)] + [(3, 0, "user", "q")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    examples = chat.whole_examples(chat.expand(df), rest=True)
    got = {(r.conv_id, r.example): (r.text.count("</s>"), r.loss_start is None) for r in examples.collect()}
    assert got == {(c, k): (min(3 * k + 3, 10), k == 3) for c in (1, None) for k in range(4)} | {(3, 0): (1, True)}
    read = rows(chat.read_examples(examples))
    assert read == rows(chat.read_back(chat.expand(df))) and {(r[0], r[1]) for r in read} == {(1, 10), (None, 10), (3, 1)}
    later = (F.col("conv_id") == 1) & (F.col("example") == 2)
    for wrong, why in (
        (examples.withColumn("text", F.when(later, F.replace("text", F.lit("turn 0"), F.lit("turn 8"))).otherwise(F.col("text"))), "lacks the context"),
        (examples.withColumn("text", F.when(later, F.expr("substr(text, 10)")).otherwise(F.col("text"))), "lacks the context"),
        (examples.withColumn("loss_start", F.when(later, F.col("loss_start") - 1).otherwise(F.col("loss_start"))), "is not its last turn"),
    ):
        with pytest.raises(Exception, match=why):
            chat.read_examples(wrong).collect()
    # the registered query expands, makes the examples whole and reads them
    assert queries.op5_chat(spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3


# ---------------------------------------------------------------- quality


def plain_counts(t):
    t = t or ""
    w = words_of(t)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)


def test_counts_and_supervision(docs, odd, none):
    for df in (docs, odd):
        got = weak_supervision.judged(df).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((r.doc_id, *plain_counts(r.text)) for r in df.collect())
        assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert weak_supervision.judged(none).collect() == []


def test_supervision_brute_force(docs):
    """The posterior of every document by an EM written out over documents instead of patterns."""
    votes = weak_supervision.rules()
    rows = textstats.text_counts(docs).select("doc_id", *[v.alias(k) for k, v in votes.items()]).collect()
    x = np.array([[r[k] for k in votes] for r in rows])
    q = np.where((x != 0).any(axis=1), 1 / (1 + 4.0 ** -x.sum(axis=1)), 0.5)
    for _ in range(100):
        prior = np.clip((q.sum() + 1) / (len(q) + 2), 0.01, 0.99)
        log = np.full(len(q), np.log(prior / (1 - prior)))
        for k in range(x.shape[1]):
            good = {v: 0.5 + q[x[:, k] == v].sum() for v in (-1, 0, 1)}
            bad = {v: 0.5 + (1 - q[x[:, k] == v]).sum() for v in (-1, 0, 1)}
            for v, right, wrong in ((1, good, bad), (-1, bad, good)):
                whole = right[v] + wrong[v]
                right[v] = max(right[v], 0.5 * whole)
                wrong[v] = whole - right[v]
            for v in (-1, 0, 1):
                log[x[:, k] == v] += np.log(good[v] / sum(good.values())) - np.log(bad[v] / sum(bad.values()))
        new = 1 / (1 + np.exp(-log))
        done, q = np.abs(new - q).max() < 1e-9, new
        if done:
            break
    want = {r.doc_id: p for r, p in zip(rows, q, strict=True)}
    for r in weak_supervision.judged(docs).collect():
        assert abs(r.quality - want[r.doc_id]) < 1e-6 and r.kept == (not r.base_failed and r.quality >= 0.5)


def test_supervision_labels(spark):
    """Against the labels of the test data: no bad document is kept, few good ones go."""
    sf = "/root/testdata/sf0.01"
    got = weak_supervision.judged(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "kept")
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r.kept for r in both if r["quality"] == 1], [r.kept for r in both if r["quality"] == 0]
    assert sum(good) >= 0.93 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_supervision_em():
    """Votes drawn from known accuracies: EM finds the classes better than the best rule alone."""
    rng = np.random.default_rng(1)
    truth, right = rng.random(20_000) < 0.7, [0.9, 0.85, 0.8, 0.75, 0.6]
    votes = np.stack([np.where(rng.random(20_000) < 0.2, 0, np.where((rng.random(20_000) < p) == truth, 1, -1)) for p in right], axis=1)
    post = weak_supervision.fit(list(Counter(map(tuple, votes.tolist())).items()), 5)
    found = np.array([post[tuple(v)] >= 0.5 for v in votes.tolist()])
    assert (found == truth).mean() > 0.9


def test_classifier_held_out(spark):
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality_classifier.scored(df, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for i, r in got.items())
    pairs = [(got[r.doc_id].score, r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    good, bad = [s for s, q in pairs if q == 1], [s for s, q in pairs if q == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.8


def test_classifier_odd(spark, odd, none):
    labels = spark.createDataFrame([(3, 1), (None, 1), (4, None), (5, 7)], "doc_id bigint, quality int")
    got = quality_classifier.scored(odd, labels).collect()
    assert len(got) == odd.count() and len({r.score for r in got}) == 1
    assert quality_classifier.scored(none, labels).collect() == []


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 14))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.3)).astype(float)
    trees = quality_classifier.fit(x, y)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95

    def walk(row):
        total = trees.base
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:50]], trees.score(x[:50]))


# ---------------------------------------------------------------- line dedup


def brute_lines(pairs):
    strip = " \t\n\r\x0b\x0c"
    key = lambda x: lower(x.strip(strip))
    held = defaultdict(list)
    for n, (i, t) in enumerate(pairs):
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append((i if i is not None else -(1 << 63), n))
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        me = i if i is not None else -(1 << 63)
        kept = [x for x in lines if len(key(x)) < 40 or len(held[key(x)]) < 5 or max(held[key(x)])[0] == me]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup(docs, odd, none):
    for df in (docs, odd):
        pairs = [(r.doc_id, r.text) for r in df.collect()]
        assert Counter(map(tuple, line_dedup.line_dedup(df).collect())) == brute_lines(pairs)
    assert sum(r.n_dropped for r in line_dedup.line_dedup(docs).collect()) > 0
    assert line_dedup.line_dedup(none).collect() == []


def test_runs_compact(spark):
    runs = line_dedup.LineRuns(fanout=2)
    for k in range(4):
        runs.add(spark.createDataFrame([(10 - k, bytearray(b"a")), (10 - k, bytearray(str(k).encode()))], "doc_id bigint, key binary"))
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    assert [(bytes(r.key), r.last) for r in runs.frequent(4).collect()] == [(b"a", 10)]


@pytest.mark.parametrize("batches", [4, 7])
def test_lines_spread_over_batches(spark, batches):
    """A line that no batch holds often enough is counted over all of them; runs are merged with no exchange."""
    spread = "The Same Line, Spread Thinly Over The Whole Of The Table"
    texts = [f"document {i} has a line of its own, forty characters or more\n" + (spread if i % 10 == 3 else "x") for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = Counter(map(tuple, line_dedup.line_dedup(df, batches=batches).collect()))
    assert got == brute_lines(list(enumerate(texts))) and sum(r[2] for r in got) == 4
    runs = line_dedup.LineRuns()
    for k in range(batches):
        runs.add(spark.createDataFrame([(100 - k, bytearray(b"a")), (100 - k, bytearray(str(k).encode()))], "doc_id bigint, key binary"))
    merged = runs.frequent(1)
    assert sorted((bytes(r.key), r.docs, r.last) for r in merged.collect()) == sorted([(str(k).encode(), 1, 100 - k) for k in range(batches)] + [(b"a", batches, 100)])
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    runs.close()


# ---------------------------------------------------------------- mixing


def test_raking_meets_marginals(spark):
    cells = spark.createDataFrame([(s, l, t, (i + 1) * 100) for i, (s, l, t) in enumerate((s, l, t) for s in "ab" for l in "xy" for t in "pq")], "source string, lang string, topic string, tokens bigint")
    want = {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"p": 0.2, "q": 0.8}}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, target double") for d, v in want.items()}
    got = mixing.raked(cells, targets).collect()
    total = sum(r.tokens for r in got)
    for d, shares in want.items():
        for v, share in shares.items():
            assert sum(r.weight for r in got if r[d] == v) / total == pytest.approx(share, abs=2e-3)


def test_mixed(docs, odd, none):
    for df in (docs, odd):
        got = mixing.mixed(df).collect()
        assert len(got) == df.count() and all(0 <= r.probability <= 1 and r.tokens == max(1, t) for r in got for t in [r.tokens])
        for r in got:
            want = r.doc_id is not None and int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32 < r.probability
            assert r.drawn == want
    tokens = Counter((r.doc_id, max(1, len(words_of(r.text)))) for r in docs.collect())
    assert Counter((r.doc_id, r.tokens) for r in mixing.mixed(docs).collect()) == tokens
    assert mixing.mixed(none).collect() == []


def drawn_shares(got, dim):
    whole = sum(r.probability * r.tokens for r in got)
    out = Counter()
    for r in got:
        out[r[dim]] += r.probability * r.tokens / whole
    return out


def test_mixed_probabilities_meet_marginals(spark):
    """The probabilities themselves meet the targets, on the default targets and with a source that holds a third."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    for df in (docs, hot):
        got = mixing.mixed(df).collect()
        assert all(0 <= r.probability <= 1 for r in got)
        for dim in mixing.DIMS:
            held = Counter()
            for r in got:
                held[r[dim]] += r.tokens
            whole = sum(n**0.7 for n in held.values())
            shares = drawn_shares(got, dim)
            for v, n in held.items():
                assert shares[v] == pytest.approx(n**0.7 / whole, rel=5e-3), (dim, v)


@pytest.mark.parametrize("fraction", [0.1, 1.0])
def test_probabilities_bounded_and_scaled(spark, monkeypatch, fraction):
    """A rare value lifted far above what its cells hold: neither the bounded fit nor the scaled one passes 1."""
    held = [("a", "x", "p", 9000), ("a", "y", "p", 800), ("b", "x", "p", 500), ("b", "y", "p", 20), ("a", "x", "q", 300), ("a", "y", "q", 40), ("b", "x", "q", 30), ("b", "y", "q", 5)]
    cells = spark.createDataFrame(held, "source string, lang string, topic string, tokens bigint")
    want = {"source": {"a": 0.7, "b": 0.3}, "lang": {"x": 0.8, "y": 0.2}, "topic": {"p": 0.9, "q": 0.1}}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, target double") for d, v in want.items()}
    for close in (mixing.CLOSE, -1.0):
        monkeypatch.setattr(mixing, "CLOSE", close)
        got = mixing.probabilities(cells, targets, fraction, 12).collect()
        assert len(got) == len(held) and all(0 <= r.probability <= 1 + 1e-9 for r in got)
        for d, shares in want.items():
            assert dict(drawn_shares(got, d)) == pytest.approx(shares, rel=2e-3)


def test_rare_values_do_not_shrink_the_draw(spark):
    """A topic that hardly occurs: without slack it bounds the whole draw, with it all marginals stay within half a point."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = docs.limit(1).withColumn("doc_id", F.lit(10**9)).withColumn("text", F.lit("a | b | c |")).withColumn("lang", F.lit("xx"))
    df = docs.filter(~F.col("text").rlike("[|#*$%&<>]")).unionByName(one)
    strict, eased = mixing.mixed(df).collect(), mixing.mixed(df, slack=0.005).collect()
    part = lambda got: sum(r.probability * r.tokens for r in got) / sum(r.tokens for r in got)
    assert part(eased) > 0.25 > 5 * part(strict) and all(0 <= r.probability <= 1 for r in eased)
    for dim in mixing.DIMS:
        held = Counter()
        for r in eased:
            held[r[dim]] += r.tokens
        whole, shares = sum(n**0.7 for n in held.values()), drawn_shares(eased, dim)
        assert all(abs(shares[v] - n**0.7 / whole) <= 0.0101 for v, n in held.items())


# ---------------------------------------------------------------- all together


def test_counts_cover_all_columns():
    assert len(textstats.TextCounter()(b"a b\nC. 1 #")) == len(textstats.COUNTS)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in out.collect()}
        assert 0 < len(after) <= len(before) and set(after) <= set(before)
        if name == "line_dedup":
            want = {i: t for i, _, _, t in brute_lines([(i, r.text) for i, r in before.items()])}
            assert all(r.text == want[i] and r.n_chars == len(r.text) for i, r in after.items())
        if name == "near_dedup":
            want, _ = brute_components([(i, r.text) for i, r in before.items()], 5)
            assert set(after) == {i for i, c in want.items() if i == c}
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert set(corpus_pipeline.run(spark, SF).columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert F is not None


COLUMNS = {
    "op1_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next", "op2_shards": "doc_id size text_crc32 law shard slot grown_shard", "op3_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_warc_derivatives": "page_id warc_type record_id refers_to block", "op5_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars", "op6_weak_supervision": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_quality_classifier": "doc_id held_out score predicted", "op8_near_duplicates": "doc_id n_shingles component_id kept", "op9_mixing": "doc_id probability drawn", "op10_line_dedup": "doc_id n_lines n_dropped kept_sha256",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_registered_query(spark, name):
    """The thin query itself: its contract's columns and rows, and its SQL where there is one."""
    from test_queries import compare

    out = queries.QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(out.columns)
    if name in queries.SQL:
        compare(out, queries.SQL[name], SF)
    else:
        table, times = ("pages", 2) if name == "op4_warc_derivatives" else ("documents", 1)
        assert out.count() == times * spark.read.parquet(f"{SF}/{table}.parquet").count()
