"""Training of linear heads: folds by publisher, thresholds by F1 on held-out probabilities."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions.enrich import Head

FOLDS = 5
#: Thresholds tried for a tag.
STEPS = [round(0.04 + 0.02 * k, 2) for k in range(41)]


def together(jobs: list[Callable[[], object]]) -> list[object]:
    """Results of jobs that do not wait for each other, FOLDS at a time; a fit is mostly many short jobs."""
    with ThreadPoolExecutor(FOLDS) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]]


def _fit(rows: DataFrame, reg: float) -> object:
    return LogisticRegression(featuresCol="x", labelCol="y", regParam=reg, maxIter=25, standardization=False).fit(rows)


def held_out(rows: DataFrame, reg: float) -> DataFrame:
    """id, y, p: probabilities of class 1 of rows (id, group, x, y) from models that never saw their publisher."""
    fold = F.pmod(F.xxhash64("group"), F.lit(FOLDS))
    rows, out = rows.withColumn("fold", fold), None
    models = together([lambda k=k: _fit(rows.filter(F.col("fold") != k), reg) for k in range(FOLDS)])
    for k, model in enumerate(models):
        test = rows.filter(F.col("fold") == k)
        part = model.transform(test).select("id", "y", vector_to_array("probability")[1].alias("p"))
        out = part if out is None else out.unionByName(part)
    return out


def sweep(scored: DataFrame) -> tuple[float, float]:
    """(threshold, F1): the best of STEPS for rows (y, p), the smallest of equals.

    Rows fall into the steps first, so the sweep runs on counts: 42 rows at most reach the driver.
    """
    step = F.expr("cast(floor((p - 0.04) / 0.02 + 1e-9) as int)")
    counts = {r["step"]: (r["n"], r["good"]) for r in scored.groupBy(F.greatest(F.least(step, F.lit(len(STEPS) - 1)), F.lit(-1)).alias("step")).agg(F.count("*").alias("n"), F.sum("y").alias("good")).collect()}
    total = sum(g for _, g in counts.values())
    best = (0.5, 0.0)
    for k, t in enumerate(STEPS):
        n, tp = (sum(v[i] for s, v in counts.items() if s >= k) for i in (0, 1))
        f1 = 2 * tp / (n + total) if n + total else 0.0
        if f1 > best[1] + 1e-12:
            best = (t, float(f1))
    return best


def train_tags(vectors: DataFrame, labels: list[str], encoder: str, regs: tuple[float, ...] = (0.01,), least: int = 3) -> tuple[Head, dict[str, tuple[float, float]]]:
    """(head, {tag: (threshold, held-out F1)}) from rows (id, group, vector, tags array<string>).

    One-vs-rest logistic regression; of several regularisations the one with the best mean F1 counts.  A tag with
    fewer than `least` examples is never given (bias -10).
    """
    rows = vectors.select("id", "group", "tags", array_to_vector(F.col("vector").cast("array<double>")).alias("x"))
    size = len(vectors.select("vector").first()[0])
    w, b, found = np.zeros((len(labels), size)), np.full(len(labels), -10.0), {}
    for k, tag in enumerate(labels):
        own = rows.select("id", "group", "x", F.array_contains("tags", tag).cast("double").alias("y"))
        if (own.agg(F.sum("y")).first()[0] or 0) < least:
            continue
        tried = [(sweep(held_out(own, reg)), reg) for reg in regs]
        (threshold, f1), reg = max(tried, key=lambda x: x[0][1])
        model = _fit(own, reg)
        w[k], b[k] = model.coefficients.toArray(), model.intercept
        found[tag] = (threshold, f1)
    return Head(labels, w, b, encoder, np.array([found.get(t, (0.5, 0.0))[0] for t in labels])), found


def train_category(vectors: DataFrame, labels: list[str], encoder: str, regs: tuple[float, ...] = (0.01,)) -> tuple[Head, float]:
    """(head, held-out accuracy) from rows (id, group, vector, label): multinomial logistic regression, folds by publisher."""
    place = F.create_map(*[x for k, label in enumerate(labels) for x in (F.lit(label), F.lit(float(k)))])
    rows = vectors.select("id", "group", place[F.col("label")].alias("y"), array_to_vector(F.col("vector").cast("array<double>")).alias("x"), F.pmod(F.xxhash64("group"), F.lit(FOLDS)).alias("fold"))
    best = None
    for reg in regs:

        def fold(k: int, reg: float = reg) -> tuple[int, int]:
            model = _fit(rows.filter(F.col("fold") != k), reg)
            return tuple(model.transform(rows.filter(F.col("fold") == k)).agg(F.count_if(F.col("prediction") == F.col("y")).alias("r"), F.count("*").alias("n")).first())

        right, total = map(sum, zip(*together([lambda k=k, fold=fold: fold(k) for k in range(FOLDS)]), strict=True))
        if best is None or right / max(total, 1) > best[1]:
            best = (reg, right / max(total, 1))
    model = LogisticRegression(featuresCol="x", labelCol="y", regParam=best[0], maxIter=25, standardization=False, family="multinomial").fit(rows)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    wide = np.zeros((len(labels), w.shape[1])), np.full(len(labels), -1e9)
    wide[0][: len(w)], wide[1][: len(b)] = w, b
    return Head(labels, wide[0], wide[1], encoder), best[1]
