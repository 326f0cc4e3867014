"""Places in a total order of a whole table, without bringing the table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import materialize


def numbered(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """df with its rows numbered from 1 in a total order.

    Rows are dealt to ranges, numbered within their range, and set off by the counts of the ranges before; only one
    count for each partition reaches the driver.  Ties of the whole order must not matter to the caller.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    own = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    counts = sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    before, starts = 0, []
    for at, n in counts:
        starts.append((at, before))
        before += n
    offsets = df.sparkSession.createDataFrame(starts, "_range int, _before bigint")
    out = ranged.withColumn(name, own).join(F.broadcast(offsets), "_range")  # one row for each partition
    return out.withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def tile(place: Column, total: int, tiles: int) -> Column:
    """The tile (from 1) of a place, as ntile deals them: the first ones are larger by one."""
    small, extra = divmod(total, tiles)
    cut = extra * (small + 1)
    return F.when(place <= cut, F.floor((place - 1) / F.lit(small + 1)) + 1).otherwise(extra + F.floor((place - 1 - cut) / F.lit(max(small, 1))) + 1)


def oldest_over(ids: DataFrame, hard: int, target: int, most: int, key: str = "id") -> DataFrame:
    """The ids to delete, oldest (smallest) first, at most `most`: all but the newest `target`, where there are more than `hard`."""
    if ids.count() <= hard:
        return ids.select(key).limit(0)
    places = numbered(ids.select(key), F.desc(key))
    return places.filter(F.col("place") > target).select(key).orderBy(key).limit(most)
