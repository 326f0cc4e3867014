"""Hand-made fixtures and plain-Python twins for rules, clustering, heads, sinks and streaming."""

from __future__ import annotations

import gzip
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from storyloom.functions import enrich as E
from storyloom.functions import hashes as H
from storyloom.functions import text as T
from storyloom.functions import urls as U
from storyloom.operators import clustering as C
from storyloom.operators import entities, heads, native
from storyloom.operators.addresses import simhash_pairs
from storyloom.operators.stories import TWINS, twins
from storyloom.plans.ranks import numbered, tile
from storyloom.sources import archive, feeds
from storyloom.streaming import ingest


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("https://www.example.org/a/b.cms?utm_source=tw&fbclid=abc", "https://example.org/a/b.cms"),
        ("HTTP://Example.ORG:80//a///b/?b=2&a=1#c", "https://example.org/a/b?a=1&b=2"),
        ("//example.org", "https://example.org"),
        ("example.org/x;v=1", "https://example.org/x"),
        ("https://example.org/?sid=9&x=", "https://example.org/?sid=9"),
        (" https://example.org:443/ ", "https://example.org/"),
        ("", ""),
        (None, ""),
    ],
)
def test_normalise_url(spark, raw, want):
    assert one(spark, raw, U.normalise_url) == want


def test_url_parts(spark):
    assert one(spark, "http://www.m.amp.a.in:8080/x", U.host_key) == "a.in"
    assert one(spark, "https://a.in/s?sid=1&source=x", lambda x: U.normalise_url(x, legacy=True)) == "https://a.in/s"
    assert one(spark, "b=2&a=%20x&utm_id=1&c=", U.normalise_query) == "a=+x&b=2"
    rng = np.random.default_rng(4)
    pairs = [tuple(int(x) for x in rng.integers(-(2**63), 2**63 - 1, 2)) for _ in range(50)]
    got = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", U.hamming(F.col("a"), F.col("b")).alias("d"))
    assert all(r.d == ((r.a ^ r.b) & (2**64 - 1)).bit_count() for r in got.collect())


def plain_murmur(data: bytes, seed: int) -> int:
    """The public algorithm in plain integers."""
    m, c1, c2 = 2**64 - 1, 0x87C37B91114253D5, 0x4CF5AD432745937F
    turn = lambda x, n: ((x << n) | (x >> (64 - n))) & m
    h1 = h2 = seed
    tail = data[len(data) // 16 * 16 :]
    for at in range(0, len(data) // 16 * 16, 16):
        k1, k2 = int.from_bytes(data[at : at + 8], "little"), int.from_bytes(data[at + 8 : at + 16], "little")
        h1 = ((turn(h1 ^ (turn(k1 * c1 & m, 31) * c2 & m), 27) + h2) * 5 + 0x52DCE729) & m
        h2 = ((turn(h2 ^ (turn(k2 * c2 & m, 33) * c1 & m), 31) + h1) * 5 + 0x38495AB5) & m
    k1, k2 = int.from_bytes(tail[:8], "little"), int.from_bytes(tail[8:], "little")
    h1 ^= turn(k1 * c1 & m, 31) * c2 & m
    h2 ^= turn(k2 * c2 & m, 33) * c1 & m
    h1, h2 = h1 ^ len(data), h2 ^ len(data)
    h1 = (h1 + h2) & m
    h2 = (h2 + h1) & m

    def settle(x):
        x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & m
        x = (x ^ x >> 33) * 0xC4CEB9FE1A85EC53 & m
        return x ^ x >> 33

    out = (settle(h1) + settle(h2)) & m
    return out - 2**64 if out >= 2**63 else out


def test_murmur():
    rng = np.random.default_rng(3)
    data = [rng.bytes(n) for n in range(70)] + ["कखग".encode(), b"foo"]
    assert H.murmur3_low(data).tolist() == [plain_murmur(d, 42) for d in data]
    assert H.murmur3_low([b"foo"], 0).tolist() == [-2129773440516405919] and H.murmur3_low([]).tolist() == []


def test_simhash_pairs_exact(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 60)]
    hashes = base + [b ^ int(np.bitwise_or.reduce(np.int64(1) << rng.integers(0, 63, 1 + k % 5))) for k, b in enumerate(base)] + [0, 0]
    got = {(r.a, r.b) for r in simhash_pairs(spark.createDataFrame(list(enumerate(hashes)), "id bigint, h bigint")).collect()}
    want = {(i, j) for i in range(len(hashes)) for j in range(i + 1, len(hashes)) if hashes[i] and hashes[j] and hashes[i] != hashes[j] and bin((hashes[i] ^ hashes[j]) & (2**64 - 1)).count("1") <= 3}
    assert got == want


def test_places(spark):
    rng = np.random.default_rng(6)
    rows = [(int(v), i) for i, v in enumerate(rng.integers(0, 50, 400))]
    df = spark.createDataFrame(rows, "v bigint, i bigint").repartition(5)
    got = numbered(df, F.col("v"), F.col("i")).withColumn("t", tile(F.col("place"), 400, 7)).orderBy("place").collect()
    assert [(r.v, r.i) for r in got] == sorted(rows) and [r.place for r in got] == list(range(1, 401))
    sizes = [sum(r.t == k for r in got) for k in range(1, 8)]
    assert sizes == [58] + [57] * 6
    assert numbered(df.limit(0), F.col("v")).count() == 0


# ---------------------------------------------------------------- clustering


def stream(seed: int, n: int = 120, size: int = 24):
    """Articles around a few directions, a part of them late, with noise; model is the seed."""
    rng = np.random.default_rng(seed)
    bases = [b / np.linalg.norm(b) for b in rng.normal(size=(8, size))]
    rows = []
    for i in range(n):
        v = rng.normal(size=size)
        if rng.random() < 0.8:
            v = 6 * bases[rng.integers(8)] + 0.9 * v * rng.random()
        t = int(rng.integers(0, 200_000)) - (8000 if rng.random() < 0.1 else 0)
        rows.append((f"s{seed}", seed * 1000 + i, t, [float(x) for x in v], f"site{rng.integers(6)}.example", f"title {i}"))
    return rows


def test_parts_equal_one_serial_fold(spark, monkeypatch):
    """Twenty streams, a model each: folding the parts of the anchor graph gives what one fold over all gives."""
    rules = C.Rules(size=24)
    assert rules.separable() and not C.Rules(join=0.5, gray=0.5, anchor=0.45).separable()
    rows = [r for seed in range(20) for r in stream(seed)]
    df = spark.createDataFrame(rows, "model string, article_id bigint, t bigint, vector array<double>, domain string, title string")
    key = lambda out: sorted((r.article_id, r.cluster_id, r.action, round(r.similarity, 6), r.article_count, r.outlet_count) for r in out.collect())
    fast, stories = C.assign(df, rules)
    monkeypatch.setattr(C, "FEW_EDGES", 0)
    assert key(C.assign(df, rules)[0]) == key(fast)
    slow, same = C.assign(df, rules, parallel=False)
    assert key(fast) == key(slow) and {r[2] for r in key(fast)} == {"seed", "join"}
    tell = lambda s: sorted((r.cluster_id, r.n, r.rep_id, r["first"], r["last"], tuple(r.outlets)) for r in s.collect())
    assert tell(stories) == tell(same)


def test_assignment_goes_on_from_state(spark):
    """Two halves of a stream, the second on the stories of the first, are the whole stream."""
    rules, rows = C.Rules(size=24), sorted(stream(7), key=lambda r: (r[2], r[1]))
    make = lambda part: spark.createDataFrame(part, "model string, article_id bigint, t bigint, vector array<double>, domain string, title string")
    whole = {r.article_id: r.cluster_id for r in C.assign(make(rows), rules, parallel=False)[0].collect()}
    one_half, stories = C.assign(make(rows[:60]), rules, parallel=False)
    other, _ = C.assign(make(rows[60:]), rules, stories=stories)
    assert {r.article_id: r.cluster_id for r in one_half.unionByName(other).collect()} == whole
    assert C.assign(make(rows[:1]).limit(0), rules)[0].count() == 0


def test_fold_holds_one_gap():
    """A part of 3,000 articles keeps rows for the stories of one gap only; the others are given out as they close."""
    rng, rules = np.random.default_rng(8), C.Rules(join=0.6, gray=0.6, size=8, gap=18 * 3600)
    part, seeds, given = C.Part("m", rules), 0, 0
    for k, v in enumerate(rng.normal(size=(3000, 8))):
        row = {"article_id": k, "t": k * 900, "assigned": None, "domain": None, "language": None, "title": None, "phash": None, "entities": [], "entity_keys": []}
        seeds += part.take(row, v)[3] == "seed"
        given, part.closed = given + len(part.closed), []
        assert len(part.stories) <= 300 and len(part.open) <= 73
    assert len(part.n) <= 600 and given + len(part.open) == seeds > 100


def test_merge_plan_is_greedy(spark):
    rng = np.random.default_rng(8)
    size = {i: int(rng.integers(1, 5)) for i in range(60)}
    rows = []
    for probe in range(60):
        other = int(rng.integers(0, 60))
        rows.append(("m", probe, size[probe], None if other == probe else other, None if other == probe else size[other], None if other == probe else float(rng.choice([0.5, 0.7, 0.8, 0.9]))))
    pairs = {}
    for _, p, _, o, _, s in rows:
        if o is not None and s >= 0.6:
            k = (min(p, o), max(p, o))
            pairs[k] = max(s, pairs.get(k, 0))
    used, want = set(), set()
    for (a, b), s in sorted(pairs.items(), key=lambda x: (-x[1], x[0])):
        if not used & {a, b}:
            used |= {a, b}
            want.add((a, b, s) if size[a] >= size[b] else (b, a, s))
    df = spark.createDataFrame(rows, "model string, probe bigint, probe_n bigint, other bigint, other_n bigint, similarity double")
    assert {(r.winner, r.loser, r.similarity) for r in C.plan_merges(df, 0.6).collect()} == want and len(want) > 5
    assert C.plan_merges(df.limit(0), 0.6).collect() == []


def test_state_is_of_one_model(spark, tmp_path):
    state = twins(spark)
    with pytest.raises(ValueError):
        C.save_state(state.unionByName(state.withColumn("model", F.lit("other"))), str(tmp_path), "m")
    C.save_state(state, str(tmp_path), "m")
    C.save_state(state.withColumn("last", F.col("last") + 1).withColumn("n", F.lit(9).cast("bigint")), str(tmp_path), "m")
    assert {r.n for r in C.load_state(spark, str(tmp_path), "m").collect()} == {9} and C.load_state(spark, str(tmp_path), "x") is None
    assert state.count() == len(TWINS)


# ---------------------------------------------------------------- heads


def test_heads(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        label = i % 4
        v = rng.normal(size=6) * 0.4
        v[label] += 2
        rows.append((i, f"p{i % 23}", [float(x) for x in v], [f"t{label}"] + (["even"] if label % 2 == 0 else []), f"t{label}"))
    df = spark.createDataFrame(rows, "id bigint, group string, vector array<double>, tags array<string>, label string")
    head, found = heads.train_tags(df, ["t0", "even", "never"], "enc")
    assert set(found) == {"t0", "even"} and all(f1 > 0.9 for _, f1 in found.values())
    said = {}
    for r in head.tags(df, "id", "vector", "enc").collect():
        said.setdefault(r.id, set()).add(r.tag)
    right = sum(said.get(i, set()) == set(tags) & {"t0", "even"} for i, _, _, tags, _ in rows)
    assert right > 360
    cat, accuracy = heads.train_category(df, ["t0", "t1", "t2", "t3"], "enc")
    assert accuracy > 0.9 and df.join(cat.category(df, "id", "vector", "enc"), "id").filter("category = label").count() > 370
    with pytest.raises(ValueError):
        cat.category(df, "id", "vector", "another encoder")
    big = E.Head(["a", "b"], np.eye(2) * 1e6, [0, 0], "enc")
    got = big.category(spark.createDataFrame([(1, [5.0, 1.0])], "id bigint, vector array<double>"), "id", "vector", "enc").first()
    assert (got.category, got.confidence) == ("a", 1.0)


# ---------------------------------------------------------------- sinks and streaming


def test_archive(spark, tmp_path):
    rows = spark.range(100).select("id", F.expr("timestamp'2026-01-01 00:00:00' + make_interval(0,0,0,cast(id % 4 as int))").alias("at"), F.lit("x").alias("body"))
    root = str(tmp_path / "archive")
    log = spark.createDataFrame(archive.export_days(rows, root, "at").collect(), archive.LOG)
    good = archive.verify_days(log, root, rows, "at").collect()
    assert {r.status for r in good} == {"verified"} and len(good) == 4
    again = spark.createDataFrame(archive.export_days(rows.filter("id % 4 = 1"), root, "at").collect(), archive.LOG)
    assert archive.parts(spark, root).filter("day = '2026-01-02'").agg(F.sum("rows")).first()[0] == 25 == again.first()["rows"]
    assert archive.read_days(spark, root, "2026-01-02", "2026-01-02").count() == 25
    left, after, report = archive.run_archive(rows, spark.createDataFrame([], archive.LOG), str(tmp_path / "run"), "at", "2026-01-10", hot_days=7, waiting=F.col("id") == 5)
    assert report.waiting == ["2026-01-02"] and report.pruned == ["2026-01-01"] and not report.failures
    assert left.count() == 75 and {r.status for r in after.collect()} == {"pruned"}
    archive.write_handoff(rows.withColumn("full_text", F.lit("y" * 9)), str(tmp_path / "h"), most=5)
    assert feeds.read_handoff(spark, str(tmp_path / "h"), "id bigint, full_text string").filter("full_text = 'yyyyy'").count() == 100
    archive.write_bodies(rows, str(tmp_path / "b"), "at")
    with gzip.open(next((tmp_path / "b" / "year=2026").rglob("*.gz"))) as f:
        assert "body" in json.loads(f.readline())


def test_documents_from_files(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(feeds.packed("<rss></rss>"))
    (tmp_path / "b.xml").write_bytes(b"x" * 5000)
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in feeds.read_documents(spark, str(tmp_path), 1000).collect()}
    assert got == {"a.xml": ("<rss></rss>", None), "b.xml": (None, "too large")}


def test_streaming(spark, tmp_path):
    spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 01:00:00"), ("b", "2026-01-02 00:00:00")], "k string, t string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t string").parquet(str(tmp_path / "in")).select("k", F.col("t").cast("timestamp").alias("t"))
    seen = []
    query = ingest.micro_batches(ingest.deduplicated(stream, "k", "t"), lambda df, i: seen.extend(r.k for r in df.collect()), str(tmp_path / "c"))
    query.awaitTermination(60)
    assert sorted(seen) == ["a", "b"]
    assert ingest.tumbling_counts(stream, "t", "k", slide="1 hour").isStreaming


# ---------------------------------------------------------------- entities and texts


def test_entities(spark):
    mentions = spark.createDataFrame([(1, 0, "Acme", "ORG"), (1, 1, "ACME", "ORG"), (1, 2, "paris", "GPE"), (1, 3, "Paris", "GPE"), (1, 4, "X", "ORG")], "article_id bigint, position int, text string, type string")
    articles = spark.createDataFrame([(1, "Acme grows", "In Paris today")], "article_id bigint, title string, body string")
    found = entities.entities(mentions, articles)
    assert [(r.entity_text, r.salience) for r in found.orderBy(F.desc("salience")).collect()] == [("Acme", 0.7), ("Paris", 0.4)]
    assert entities.evidence(found, ["paris"]).first()["keys"] == ["acme"]


def plain_clean(text):
    line = re.compile("(?i)(" + "|".join(T.ARTICLE_BOILERPLATE) + ")")
    out = []
    for x in (text or "").splitlines():
        y = x.strip()
        if not y:
            out.append("")
        elif not line.search(y) and not re.match(r"^https?://\S+$", y) and not re.match(r"^@\w{1,30}\s*$", y):
            out.append(x)
    whole = re.sub(r"\btext_fields\b", "", re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip())
    return re.sub(r"  +", " ", whole).strip()


def test_cleaned_text(spark):
    texts = ["Title\n\n \n\t\nAlso\u00a0read: x\nbody  text_fields one\r\n https://a.b/c \n@handle \n@not a handle\n© 2024 x\nsee https://a.b", "", None, "ADVERTISEMENT\nEditor’s note: y\nDon’t miss\nrelated stories\nlast\u2028line ", "x\x0bSubscribe now\x0cz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r.doc_id: r.t for r in df.select("doc_id", T.cleaned_article(F.col("text")).alias("t")).collect()} == {i: plain_clean(t) for i, t in enumerate(texts)}
    assert plain_clean(texts[0]) == "Title\n\nbody one\n@not a handle\nsee https://a.b"
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = native.x20_cleaned_text(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs) and all(r.cleaned == plain_clean(docs[r.doc_id]) for r in got)
