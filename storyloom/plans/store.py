"""Tables between jobs: written to the folder that driver and executors share, and joins that hot keys do not slow."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that make up more than 1/HOT of all rows are joined apart; there are fewer than HOT of them.
HOT = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only in local mode where none is named (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="storyloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove materialized tables that no later job reads."""
    for t in tables:
        remove(t.sparkSession, t.scratch)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder; a missing one is no error."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(found, True)


def skewed_join(left: DataFrame, right: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """left joined with right on key, hot keys without a shuffle.

    right has one row for each key; its column `size` says about how many rows of left hold the key.  Keys of more
    than a share 1/HOT of all such rows are fewer than HOT, so their rows are broadcast whatever the input; all
    others meet in a shuffle whose largest key is that small.  left is read twice: once for hot keys, once for the rest.
    """
    total = right.agg(F.sum(size)).first()[0] or 0
    hot, cold = right.filter(F.col(size) * HOT > total), right.filter(F.col(size) * HOT <= total)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(rest.join(cold.hint("merge"), key, how))
