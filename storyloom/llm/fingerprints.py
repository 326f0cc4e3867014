"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

Terms are the words of a text, weighted by their counts.  For sample k every term draws r, c ~ Gamma(2, 1) and
b ~ U(0, 1) from hashes of (term, k).  With weight w: t = floor(ln w / r + b), ln a = ln c - r (t - b) - r, and
the term of least a is the sample (Ioffe 2010).  Two texts share sample k with probability sum min(w, w') / sum max(w, w').
The least ln a itself identifies term and t, so a plain min() per sample draws the whole signature.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, materialize, partitions

SAMPLES = 48
#: Samples drawn by one row: the generated code of a row stays small enough to be compiled.
LANE = 8
#: Cells of the quantile table that Gamma(2, 1) is drawn from.
CELLS = 8192
#: Stands for a missing doc_id.
_NO_ID = -(1 << 63)


def gamma_quantiles(spark: SparkSession) -> DataFrame:
    """One row: key 0, the mid-cell quantiles of Gamma(2, 1), and their logarithms.  Its size is fixed, so it is broadcast."""
    values = []
    x = 0.01
    for i in range(CELLS):
        u = (i + 0.5) / CELLS
        for _ in range(60):  # Newton on 1 - exp(-x) (1 + x) = u
            step = (1 - math.exp(-x) * (1 + x) - u) / (x * math.exp(-x))
            x = max(x - step, x / 2)
            if abs(step) < 1e-13 * x:
                break
        values.append(x)
    return spark.createDataFrame([(0, values, [math.log(v) for v in values])], "key bigint, r_of array<double>, ln_c_of array<double>")


def _least(r: Column, ln_c: Column, b: Column, ln_w: Column) -> Column:
    return ln_c - r * (F.floor(ln_w / r + b) - b) - r


def signatures(words: DataFrame, keys: list[str], samples: int) -> DataFrame:
    """words: keys, h (the term's hash), w (its count; 0: none) -> keys, lane, least: the LANE minima of that lane.

    Rows must be dealt by a subset of keys already; no shuffle is added.
    """
    spark = words.sparkSession
    lanes = F.explode(F.sequence(F.lit(0), F.lit(samples // LANE - 1))).alias("lane")
    ln_w = F.when(F.col("w") > 0, F.log(F.col("w").cast("double"))).alias("ln_w")
    drawn = words.select(*keys, "h", ln_w, F.pmod("h", F.lit(1)).alias("key")).join(F.broadcast(gamma_quantiles(spark)), "key")
    drawn = drawn.select(*keys, "h", "ln_w", "r_of", "ln_c_of", lanes)
    hashes = [F.xxhash64("h", F.col("lane") * LANE + j).alias(f"x{j}") for j in range(LANE)]
    drawn = drawn.select(*keys, "lane", "ln_w", "r_of", "ln_c_of", *hashes)
    cell = lambda j, at: F.shiftrightunsigned(f"x{j}", at).bitwiseAND(F.lit(CELLS - 1)).cast("int")
    draws = [c for j in range(LANE) for c in (F.get("r_of", cell(j, 51)).alias(f"r{j}"), F.get("ln_c_of", cell(j, 38)).alias(f"c{j}"), (F.col(f"x{j}").bitwiseAND(F.lit((1 << 38) - 1)) * F.lit(2.0**-38)).alias(f"b{j}"))]
    drawn = drawn.select(*keys, "lane", "ln_w", *draws)
    least = [F.min(_least(F.col(f"r{j}"), F.col(f"c{j}"), F.col(f"b{j}"), F.col("ln_w"))).alias(f"a{j}") for j in range(LANE)]
    return drawn.groupBy(*keys, "lane").agg(*least).select(*keys, "lane", F.array(*[F.col(f"a{j}") for j in range(LANE)]).alias("least"))


def _hex(minima: Column) -> Column:
    """Four hex digits for each sample; a text without terms has none."""
    one = lambda x: F.lpad(F.lower(F.hex(F.pmod(F.xxhash64(x), F.lit(65536)))), 4, "0")
    return F.when(minima[0].isNull(), F.lit("")).otherwise(F.array_join(F.transform(minima, one), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two fingerprints without samples are alike, one alone is like none; null with null."""
    at = lambda x, i: F.substring(x, i * 4 + 1, F.lit(4))
    n = F.floor(F.length(a) / 4).cast("int")
    same = F.size(F.filter(F.sequence(F.lit(0), n - 1), lambda i: at(a, i) == at(b, i)))
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when((F.length(a) == 0) & (F.length(b) == 0), 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(same / n)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, fingerprint of every whole text (null: empty); repeated doc_ids give a row each.

    Other columns are ignored whatever their names; a null doc_id is kept; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition(partitions(docs.sparkSession), "doc_id")
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    # every text keeps a row of its own, with no count, so that blank texts stay
    term = F.explode(F.concat(F.array(F.lit(None).cast("string")), F.filter(F.split("text", SPACES), lambda w: w != "")))
    words = rows.select("doc_id", "uid", term.alias("term")).select("doc_id", "uid", F.xxhash64("term").alias("h"), F.col("term").isNotNull().cast("int").alias("w"))
    words = words.groupBy("doc_id", "uid", "h").agg(F.sum("w").alias("w"))
    lanes = signatures(words, ["doc_id", "uid"], samples)
    whole = lanes.groupBy("doc_id", "uid").agg(F.sort_array(F.collect_list(F.struct("lane", "least"))).alias("l"))
    return whole.select("doc_id", _hex(F.flatten(F.col("l.least"))).alias("fingerprint"))


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, need): the next larger doc_id (after the last: the first), by a distributed sort of ids.

    need: code points of the next text that the edit of this one takes.  A null doc_id has no place in the order.
    """
    spark = docs.sparkSession
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.length(F.coalesce("text", F.lit("")))).alias("n"))
    ids = ids.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id").withColumn("at", F.monotonically_increasing_id())
    ids = materialize(ids.select("doc_id", F.floor(F.col("n") / 4).cast("int").alias("need"), F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("off")), "order")
    # one row per sorted partition: the rows before it
    starts = ids.groupBy("part").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = ids.join(starts.select("part", before.alias("start")), "part").select("doc_id", "need", (F.col("start") + F.col("off")).alias("pos"))
    total = max(1, ids.count())
    after = placed.select(F.col("doc_id").alias("next_id"), F.col("pos").alias("after"))
    return placed.withColumn("after", F.pmod(F.col("pos") + 1, F.lit(total))).join(after, "after").select("doc_id", "next_id", "need")


def edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edit: the last quarter replaced by as much of the next text's start.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Rows that repeat a doc_id share its place in the order; the least of their texts stands for it as a next text.
    A row with a null doc_id has no next text: it loses its last quarter and near_next is null.
    """
    spark = docs.sparkSession
    n_parts = partitions(spark)
    order = materialize(successors(docs), "successors")
    asked = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("previous_id"), "need")
    # ids without nulls keep Spark from filtering one use of the shuffled texts, so both uses share one shuffle
    rows = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition(n_parts, "doc_id")
    heads = rows.join(asked, "doc_id").select(F.col("previous_id").alias("doc_id"), F.expr("substring(text, 1, need)").alias("head"))
    heads = heads.groupBy("doc_id").agg(F.min("head").alias("head"))  # one row each unless a doc_id repeats
    rows = rows.join(heads, "doc_id", "left").withColumn("uid", F.monotonically_increasing_id())
    rows = rows.withColumn("n", F.length("text")).withColumn("q", F.expr("cast(floor(n / 4) as int)"))
    cut = F.expr("substring(text, 1, n - q)")
    # whole words of the kept part count for both texts; what follows the last space differs
    rows = rows.withColumn("keep", cut).withColumn("fresh", F.expr("substring(coalesce(head, ''), 1, q)"))
    rows = rows.withColumn("common", F.regexp_extract("keep", r"(?s)^.*[\x20\x09-\x0D]", 0))
    rows = rows.select(
        "doc_id", "uid", "common",
        F.expr("substring(text, length(common) + 1, n)").alias("tail"),
        F.concat(F.expr("substring(keep, length(common) + 1, n)"), F.col("fresh")).alias("new_tail"),
        F.col("n").cast("bigint").alias("n_chars"),
        F.unhex(F.sha2(F.concat("keep", "fresh").cast("binary"), 256)).alias("edited"),
    )
    mark = lambda column, b, e: F.transform(F.filter(F.split(column, SPACES), lambda w: w != ""), lambda w: F.struct(w.alias("term"), F.lit(b).alias("b"), F.lit(e).alias("e")))
    # every text keeps a row of its own, with no count, so that blank texts stay
    own = F.array(F.struct(F.lit("").alias("term"), F.lit(0).alias("b"), F.lit(0).alias("e")))
    keys = ["doc_id", "uid", "n_chars", "edited"]
    words = rows.select(*keys, F.explode(F.concat(own, mark("common", 1, 1), mark("tail", 1, 0), mark("new_tail", 0, 1))).alias("x"))
    words = words.select(*keys, F.xxhash64("x.term").alias("h"), F.col("x.b").alias("b"), F.col("x.e").alias("e"))
    words = words.groupBy(*keys, "h").agg(F.sum("b").alias("b"), F.sum("e").alias("e"))
    # terms of one weight in both texts are drawn once (side 0), others for the text (1) and for its edit (2)
    sides = F.when(F.col("b") == F.col("e"), F.array(F.struct(F.lit(0).alias("side"), F.col("b").alias("w"))))
    sides = sides.otherwise(F.array(F.struct(F.lit(1).alias("side"), F.col("b").alias("w")), F.struct(F.lit(2).alias("side"), F.col("e").alias("w"))))
    words = words.select(*keys, "h", F.explode(sides).alias("x")).select(*keys, "h", F.col("x.side").alias("side"), F.col("x.w").alias("w"))
    lanes = signatures(words, [*keys, "side"], samples)
    whole = lanes.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("lane") * 3 + F.col("side"), "least"))).alias("m"))

    def joined(side: int) -> Column:
        def lane(i: Column) -> Column:
            common, own = F.try_element_at("m", (i * 3).cast("int")), F.try_element_at("m", (i * 3 + side).cast("int"))
            return F.coalesce(F.zip_with(common, own, lambda x, y: F.least(x, y)), common, own)

        return _hex(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(samples // LANE - 1)), lane)))

    whole = whole.select(F.nullif("doc_id", F.lit(_NO_ID)).alias("doc_id"), "n_chars", F.lower(F.hex("edited")).alias("edited_sha256"), joined(1).alias("fingerprint"), joined(2).alias("edited_fingerprint"))
    whole = materialize(whole, "signatures")
    # the next text is the least of its doc_id's texts; for a doc_id held once it is the only one
    following = whole.groupBy("doc_id").agg(F.min("fingerprint").alias("next_fingerprint"))
    following = order.join(following.withColumnRenamed("doc_id", "next_id"), "next_id").select("doc_id", "next_fingerprint")
    return whole.join(following, "doc_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
