"""Findings of round 3: steps that did the same work several times, or sent what they need not."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from storyloom.functions import enrich as E
from storyloom.functions import hashes as H
from storyloom.functions import language as L
from storyloom.functions import pages as P
from storyloom.functions import text as T
from storyloom.operators import clustering as C
from storyloom.operators import heads
from storyloom.operators.addresses import flagged


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_is_split_once(spark):
    rows = [(0, None), (1, ""), (2, " \n "), (3, "Click TAP Here now"), (4, "one two  three"), (5, "a " * 50 + "share"), (6, "\x1cclick\x1f clicK")]
    df = spark.createDataFrame(rows, "id bigint, text string").select("id", P.text_score(F.col("text")).alias("s"))
    assert plan(df).count("split(") == 1
    assert {r.id: round(r.s, 6) for r in df.collect()} == {0: 0, 1: 0, 2: 0, 3: 0.4, 4: 3, 5: round(51 * (1 - 4 / 51), 6), 6: 0.2}


def test_keywords_meet_as_texts(spark):
    """Phrases are counted where their key's words meet, also of a key that occurs twice; none is a row of a shuffle."""
    rows = [(1, "Storm hits coast", "The storm hits. Storm warnings: storm, coast, read more read more"), (2, "Short", ""), (1, "Other title", "warnings were given for the storm and for the coast"), (None, "A null key", "has words of its own, and read more words")]
    df = E.keywords(spark.createDataFrame(rows, "id bigint, title string, body string"), "id", F.col("title"), F.col("body"), F.lit(None).cast("string"), 4)
    assert "explode" not in plan(df) and "MapInArrow" in plan(df)
    got: dict = {}
    for r in sorted(df.collect(), key=lambda r: r.place):
        got.setdefault(r.id, []).append(r.keyword)
    assert got == {1: ["storm", "storm hits", "coast", "for the"], None: ["null key", "and read", "has words", "its own"]}


def test_language_counts_do_not_repeat(spark):
    """Words are extracted and lower-cased once for all languages; scripts without letters are not searched; blanks before a body count on neither side."""
    rows = [(1, "the cat and the dog is in a house of wood"), (2, "Москва и Берлин"), (3, "नमस्ते abc"), (4, ""), (5, "　" * 3000 + "ab нет")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    once = df.select(L.function_word_language(F.col("text")).alias("x"))
    assert plan(once).count("regexp_extract_all") == 1 and once.first().x == "en"
    tops = {r.id: (r.t.script, r.t.n, r.t.early) for r in df.select("id", F.array_max(L.script_counts(L.letters(F.col("text")))).alias("t")).collect()}
    assert tops == {1: ("latn", 31, 0), 2: ("other", 13, 0), 3: ("deva", 6, 0), 4: ("telu", 0, 0), 5: ("other", 3, -2)}
    kept = L.with_detected(df, "language", F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("string"), script="script")
    assert {r.id: r.script for r in kept.collect()} == {k: v[0] for k, v in tops.items()}


def test_blocks_are_bounded_and_met_in_tiles(spark):
    """A row is sent 16 times at most, whatever the rows of its bucket; within a task, tiles give what whole blocks give."""
    rows = spark.range(100).select(F.lit("m").alias("model"), "id", F.lit(0).alias("at"))
    left, right, _ = C.blocks_of(rows, rows, 1, size=2)
    assert left.count() == right.count() == 1600

    def run(a, b):
        return a[["id"]].merge(b[["id"]].rename(columns={"id": "other"}), how="cross")

    def last(found):
        return found.sort_values(["id", "other"]).groupby("id").tail(2)

    schema = "id bigint, other bigint"
    assert sorted(map(tuple, C.blockwise(rows, rows, 1, run, schema, tile=7).collect())) == sorted(("m", a, b) for a in range(100) for b in range(100))
    assert sorted(map(tuple, C.blockwise(rows, rows, 1, run, schema, last, tile=7).collect())) == sorted(("m", a, b) for a in range(100) for b in (98, 99))


def test_near_flags_broadcast_nothing(spark):
    """Sides that grow with the input meet in shuffles, even where small ones would fit a broadcast."""
    run = spark.createDataFrame([(1, 7), (2, 0), (3, 6), (4, 1 << 40 | 255 << 20)], "id bigint, h bigint")
    out = flagged(run, spark.createDataFrame([(9, 1 << 40 | 255 << 20, 5)], "id bigint, h bigint, at bigint"))
    assert {r.id: r.near for r in out.collect()} == {1: False, 2: False, 3: True, 4: True}
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_simhash_holds_words_of_a_run():
    """The words of a large batch are never held together; hashes are those of each text alone."""
    texts, held = [f"word{k} and word{k + 1} " * 20 if k % 7 else None for k in range(400)], []

    def hashed(words):
        held.append(len(words))
        return H.sha_heads(words)

    got = T.simhashes(texts, hashed, 5_000)
    assert max(held) < 50 and list(got) == [int(T.simhashes([t], H.sha_heads)[0]) for t in texts]
    assert len(T.simhashes([], H.sha_heads)) == 0


def test_fits_run_together():
    """Jobs that do not wait for each other start together, their results stay in order, and an error is raised."""
    gate = threading.Barrier(heads.FOLDS, timeout=20)
    assert heads.together([lambda k=k: (gate.wait(), k)[1] for k in range(heads.FOLDS)]) == list(range(heads.FOLDS))
    with pytest.raises(ZeroDivisionError):
        heads.together([lambda: 1 / 0])
