"""Vector rules: dot products, guards and sums as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """Scaled to length one; the length is computed once."""
    return F.get(F.transform(F.array(norm(a)), lambda n: F.transform(a, lambda x: x / n)), F.lit(0))


def valid(a: Column, size: int) -> Column:
    """Right length, no null or NaN, not zero.  NaN ranks above every number, so it is tested first."""
    return F.coalesce((F.size(a) == size) & ~F.exists(a, lambda x: x.isNull() | F.isnan(x)) & (norm(a) > 0), F.lit(False))


def vector_sum(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """keys, sum (array<double>), n: exact sums by position, pre-aggregated before the shuffle."""
    parts = df.select(*keys, F.posexplode(vector).alias("at", "x")).groupBy(*keys, "at").agg(F.sum(F.col("x").cast("double")).alias("x"), F.count("*").alias("n"))
    whole = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"), F.max("n").alias("n"))
    return whole.select(*keys, F.col("v.x").alias("sum"), "n")
