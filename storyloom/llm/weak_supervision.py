"""Quality rules under weak supervision: rules vote or abstain, EM estimates how far each is to be trusted.

The votes of all documents are counted by pattern (3 ** number of rules at most), so EM runs on a table whose
size does not depend on the corpus while every document counts.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .textstats import text_counts

GOOD, BAD, ABSTAIN = 1, -1, 0


def rules() -> dict[str, Column]:
    """name -> vote, over the columns of text_counts; each rule looks at facts of its own.

    Only running prose is praised, and it is judged only where words are words: among symbols the rule abstains.
    Where a pass is no merit (no symbols, no repeats) a rule abstains.
    """
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    blame = lambda bad: F.when(bad, BAD).otherwise(ABSTAIN)
    short, stops = per("n_short", "n_words"), per("n_stops", "n_words")
    some, words = F.col("n_words") >= 10, per("n_symbols", "n_words") <= 0.1
    return {
        "prose": F.when(some & words & ((short < 0.1) | (stops < 0.005)), BAD).when(some & words & (short > 0.12) & (short < 0.7) & (stops > 0.008) & (stops < 0.5), GOOD).otherwise(ABSTAIN),
        "symbols": blame(per("n_symbols", "n_words") > 0.1),
        "word_length": blame((per("word_chars", "n_words") > 11) | (some & (per("word_chars", "n_words") < 2.5))),
        "repeats": blame(per("n_repeat_words", "n_words") > 0.2),
        "dup_lines": blame(per("n_dup_lines", "n_lines") > 0.3),
        "variety": blame(some & (per("n_distinct", "n_words") < 0.25)),
    }


VOTES = (BAD, ABSTAIN, GOOD)
#: Least share of a rule's good votes on good documents, and of its bad votes on bad ones.
TRUST = 0.5
Shares = list[dict[int, float]]


def posterior(pattern: tuple[int, ...], prior: float, good: Shares, bad: Shares) -> float:
    """Probability of good quality, given how often each rule votes so on good and on bad documents."""
    log = math.log(prior / (1 - prior)) + sum(math.log(g[v] / b[v]) for v, g, b in zip(pattern, good, bad, strict=True))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, log))))


def shares(patterns: list[tuple[tuple[int, ...], int]], post: dict[tuple[int, ...], float], rule: int) -> tuple[dict[int, float], dict[int, float]]:
    """How a rule's outcomes, abstentions included, are shared out over good and over bad documents; half a pseudo-count each."""
    good, bad = ({v: 0.5 for v in VOTES} for _ in range(2))
    for p, n in patterns:
        good[p[rule]] += post[p] * n
        bad[p[rule]] += (1 - post[p]) * n
    for vote, right, wrong in ((GOOD, good, bad), (BAD, bad, good)):
        whole = right[vote] + wrong[vote]
        right[vote] = max(right[vote], TRUST * whole)
        wrong[vote] = whole - right[vote]
    return tuple({v: m / sum(side.values()) for v, m in side.items()} for side in (good, bad))


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 100) -> dict[tuple[int, ...], float]:
    """Vote patterns with their counts -> posterior probability of good quality for every possible pattern.

    Dawid-Skene for two classes and three outcomes: for each class a rule has its own shares of bad votes, abstentions
    and good votes, all estimated.  The first posterior leans by the balance of votes.  What weak supervision takes for
    granted is that a vote is right at least TRUST of the time: where an estimate falls below, it is held there, so the
    classes cannot trade places or follow something else than quality.
    """
    post = {p: 1 / (1 + 4.0 ** -sum(p)) if any(p) else 0.5 for p, _ in patterns}
    total = sum(n for _, n in patterns)
    prior, good, bad = 0.5, [dict.fromkeys(VOTES, 1 / 3)] * n_rules, [dict.fromkeys(VOTES, 1 / 3)] * n_rules
    for _ in range(rounds):
        prior = min(0.99, max(0.01, (sum(post[p] * n for p, n in patterns) + 1) / (total + 2)))
        fitted = [shares(patterns, post, k) for k in range(n_rules)]
        good, bad = [g for g, _ in fitted], [b for _, b in fitted]
        after = {p: posterior(p, prior, good, bad) for p, _ in patterns}
        moved = max((abs(after[p] - post[p]) for p in post), default=0)
        post = after
        if moved < 1e-9:
            break
    return {p: posterior(p, prior, good, bad) for p in itertools.product(VOTES, repeat=n_rules)}


def judged(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, the COUNTS of every whole text, base_failed, quality (posterior), kept.

    base_failed: fewer than 10 words, or over a fifth of them in repeated windows of five.  Null texts count as
    empty and fail.  Repeated rows are judged alike; other columns are ignored; no rows give no rows.
    """
    votes = rules()
    names = list(votes)
    counted = materialize(text_counts(docs), "counts")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    code = sum(((v + 1) * 3**k for k, v in enumerate(votes.values())), F.lit(0))
    marked = counted.withColumn("base_failed", base).withColumn("pattern", code.cast("int"))
    decode = lambda x: tuple(x // 3**k % 3 - 1 for k in range(len(names)))
    seen = [(decode(r["pattern"]), r["count"]) for r in marked.groupBy("pattern").count().collect()]
    quality = fit(seen, len(names))
    rows = [(sum((v + 1) * 3**k for k, v in enumerate(p)), q) for p, q in quality.items()]
    table = docs.sparkSession.createDataFrame(rows, "pattern int, quality double")
    out = marked.join(F.broadcast(table), "pattern")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)).drop("pattern")
