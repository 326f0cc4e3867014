"""Mixing sources to target weights: iterative proportional fitting over source, language and topic, then sampling.

Only DataFrame functions: token weights are summed into cells, the cells are raked to the marginals in turn under
the bound that none gives more than it holds, and every document is drawn with the probability of its cell by a hash
of its doc_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, materialize

DIMS = ("source", "lang", "topic")
ROUNDS = 6
#: A value gives at most this share of its tokens, so that the other marginals still have room.
ROOM = 0.95
#: Largest relative error of a marginal at which the bounded fit is taken.
CLOSE = 1e-3


def n_tokens(text: Column) -> Column:
    """Words of a text, at least 1, so that no document weighs nothing."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")
    return F.greatest(F.size(words), F.lit(1)).cast("bigint")


def topic(text: Column, words: Column) -> Column:
    """A coarse topic by form: list, short note, symbol-laden, or prose."""
    x = F.coalesce(text, F.lit(""))
    count = lambda chars: F.length(x) - F.length(F.translate(x, chars, ""))
    return F.when(count("|") * 5 > words, "list").when(count("#*$%&<>") * 5 > words, "symbols").when(words < 100, "note").otherwise("prose")


def uniform(doc_id: Column) -> Column:
    """A fixed draw in [0, 1) for each document: 32 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), doc_id.cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def flattened(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares of one marginal: token shares to a power below 1, which lifts the rare values."""
    of = cells.groupBy(dim).agg(F.sum("tokens").alias("t"))
    whole = W.partitionBy()  # one row per value of the marginal
    share = F.pow(F.col("t").cast("double"), F.lit(power))
    return of.select(dim, (share / F.sum(share).over(whole)).alias("target"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """cells (dimensions, tokens) with weight, raked so that each marginal of weight gets its target share.

    Values without a target keep no weight.  A fixed number of rounds, each fitting every marginal once.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        out = out.join(target.withColumnRenamed("target", f"{dim}_target"), dim, "left")
    for _ in range(rounds):
        for dim in targets:
            held = F.sum("weight").over(W.partitionBy(dim))
            out = out.withColumn("weight", F.when(held > 0, F.col("weight") * F.coalesce(F.col(f"{dim}_target"), F.lit(0.0)) * F.lit(total) / held).otherwise(F.lit(0.0)))
        out = materialize(out, "raked")
    return out.select(*targets, "tokens", "weight")


def targeted(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """cells with a column <dim>_target for each dimension, 0.0 where a value has none."""
    out = cells
    for dim, target in targets.items():
        out = out.join(target.withColumnRenamed("target", f"{dim}_target"), dim, "left")
    return out.fillna(0.0, [f"{dim}_target" for dim in targets])


def within_reach(cells: DataFrame, targets: dict[str, DataFrame], fraction: float, slack: float) -> tuple[dict[str, DataFrame], float]:
    """(targets, share) that values can give: none asks for more than ROOM of its tokens at a draw of `share` of all.

    A value that holds too little for its target lowers the share only as far as the marginal would else miss by more
    than slack; beyond that its target is what it holds, and the others share out the rest.  So a value that hardly
    occurs cannot shrink the draw.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    held = {d: t.join(cells.groupBy(d).agg((F.sum("tokens") / total).alias("held")), d).select(d, "target", "held") for d, t in targets.items()}
    rooms = [h.filter(F.col("target") > slack).agg(F.min(F.col("held") / (F.col("target") - slack))).first()[0] for h in held.values()]
    share = min([fraction, *[ROOM * r for r in rooms if r is not None]])
    out = {}
    for d, h in held.items():
        most = ROOM / share * F.col("held")
        eased = h
        for _ in range(4):
            full, free = eased.agg(F.sum(F.when(F.col("target") >= most, most)), F.sum(F.when(F.col("target") < most, F.col("target")))).first()
            scale = (1 - (full or 0.0)) / free if free else 1.0
            eased = eased.withColumn("target", F.when(F.col("target") >= most, most).otherwise(F.col("target") * scale))
        out[d] = eased.select(d, "target")
    return out, share


def _error(cells: DataFrame, dims: list[str], relative: bool = True) -> float:
    """Largest error of the drawn marginals (probability * tokens) of cells that carry their targets."""
    drawn = F.col("probability") * F.col("tokens")
    whole = F.sum(drawn).over(W.partitionBy())  # one row per cell
    by = lambda d: F.col(f"{d}_target") if relative else F.lit(1.0)
    off = [F.when(F.col(f"{d}_target") > 0, F.abs(F.sum(drawn).over(W.partitionBy(d)) / whole - F.col(f"{d}_target")) / by(d)).otherwise(0.0) for d in dims]
    return float(cells.select(F.greatest(*off).alias("off") if len(off) > 1 else off[0].alias("off")).agg(F.max("off")).first()[0] or 0)


def probabilities(cells: DataFrame, targets: dict[str, DataFrame], fraction: float, rounds: int = ROUNDS, slack: float = 0.0) -> DataFrame:
    """cells with the probability at which to draw each: probability * tokens has the target marginals.

    The drawn share of all tokens is `fraction`, or less where a value holds too few tokens for its target.  A step
    fits one marginal exactly: cells that would pass 1 give all they hold, and the factor of the rest makes up for
    it.  Where that does not come CLOSE, plain raked weights are scaled by the largest ratio, so none passes 1.
    slack: how far a marginal may miss its target, in points of share, rather than shrink the draw (see within_reach).
    """
    if slack:
        targets, fraction = within_reach(cells, targets, fraction, slack)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    out = materialize(targeted(cells, targets), "targets")
    room = [F.when(F.col(f"{d}_target") > 0, F.sum("tokens").over(W.partitionBy(d)) / (F.col(f"{d}_target") * total)) for d in targets]
    room = [r for r in out.select(*[r.alias(f"r{k}") for k, r in enumerate(room)]).agg(*[F.min(f"r{k}") for k in range(len(room))]).first() if r is not None]
    share = min([fraction, *[ROOM * r for r in room]])
    out = out.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for dim in targets:
            first = W.partitionBy(dim).orderBy(F.desc("ratio"), *DIMS)
            out = out.withColumn("ratio", F.col("weight") / F.col("tokens"))
            full = F.coalesce(F.sum("tokens").over(first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
            rest = F.sum("weight").over(first.rowsBetween(W.currentRow, W.unboundedFollowing))
            # the factor if all cells before this one are full; the right one is the largest
            out = out.withColumn("factor", F.when(rest > 0, (F.col(f"{dim}_target") * F.lit(total * share) - full) / rest))
            out = out.withColumn("weight", F.col("weight") * F.coalesce(F.max("factor").over(W.partitionBy(dim)), F.lit(0.0))).drop("ratio", "factor")
        out = materialize(out, "raked")
    out = out.withColumn("probability", F.least(F.lit(1.0), F.col("weight") / F.col("tokens")))
    if _error(out, list(targets), not slack) > (slack or CLOSE):
        out = materialize(raked(cells, targets, rounds).withColumn("ratio", F.col("weight") / F.col("tokens")), "scaled")
        top = out.agg(F.max("ratio")).first()[0] or 0.0
        out = out.withColumn("probability", F.col("ratio") * (min(fraction, 1.0 / top) if top > 0 else 0.0))
    return out.select(*cells.columns, "probability")


def mixed(docs: DataFrame, power: float = 0.7, fraction: float = 0.5, rounds: int = ROUNDS, targets: dict[str, DataFrame] | None = None, slack: float = 0.0) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, drawn: every document with its calibrated probability.

    The expected token mix of the drawn documents has the target marginals.  It holds `fraction` of all tokens, or
    less where a value has too few tokens for its target at that size; with slack, such values give what they hold
    and marginals may miss by so many points of share.  targets: per dimension a frame (value, target); by
    default token shares to `power`.  Null source and lang count as '(none)', null texts as one token.  Rows of one
    doc_id are drawn alike; a null doc_id is never drawn.  Other columns are ignored; no rows give no rows.
    """
    tokens = n_tokens(F.col("text"))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("(none)")).alias("source"), F.coalesce("lang", F.lit("(none)")).alias("lang"), tokens.alias("tokens"), topic(F.col("text"), tokens).alias("topic"))
    rows = materialize(rows, "tokens")
    cells = materialize(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "cells")
    targets = targets or {d: flattened(cells, d, power) for d in DIMS}
    cells = probabilities(cells, targets, fraction, rounds, slack)
    cells = cells.select(*DIMS, F.round(F.coalesce("probability", F.lit(0.0)), 6).alias("probability"))
    same = reduce(lambda a, b: a & b, [rows[d] == cells[d] for d in DIMS])
    out = rows.join(cells, same, "left").select(rows["doc_id"], *[rows[d] for d in DIMS], rows["tokens"], "probability")
    return out.withColumn("drawn", F.coalesce(uniform(F.col("doc_id")) < F.col("probability"), F.lit(False)))
