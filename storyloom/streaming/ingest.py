"""Streaming mode of ingest: exact dedup within a watermark, windows, failure streaks in state, writes that repeat harmlessly."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

RETENTION = "30 hours"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def deduplicated(stream: DataFrame, key: str, time: str, retention: str = RETENTION) -> DataFrame:
    """First row of each key; state is kept for the retention of the watermark, as clusters are."""
    return stream.withWatermark(time, retention).dropDuplicatesWithinWatermark([key])


def tumbling_counts(stream: DataFrame, time: str, *keys: str, width: str = "1 day", slide: str | None = None, retention: str = RETENTION) -> DataFrame:
    """Counts by window and key, late rows accepted up to the retention; a slide makes windows overlap."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, retention).groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


class _Streak(StatefulProcessor):
    """Failures in a row by key; a key trips once the streak reaches its limit."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("streak", "streak bigint, longest bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer) -> Iterator[pd.DataFrame]:  # noqa: N802
        streak, longest = self.state.get() if self.state.exists() else (0, 0)
        order = pd.concat(list(rows)).sort_values("place")
        for bad in order["bad"].tolist():
            streak = streak + 1 if bad else 0
            longest = max(longest, streak)
        self.state.update((int(streak), int(longest)))
        yield pd.DataFrame({"key": [key[0]], "streak": [int(streak)], "longest": [int(longest)], "tripped": [longest >= self.limit]})

    def close(self) -> None:
        pass


def failure_streaks(stream: DataFrame, limit: int = 3) -> DataFrame:
    """stream (key bigint, place bigint, bad boolean) -> key, streak, longest, tripped after each batch, from state.

    Rows of a key count in order of place within a batch, and batches in order of arrival.  Needs the RocksDB state store.
    """
    return stream.groupBy("key").transformWithStateInPandas(statefulProcessor=_Streak(limit), outputStructType="key bigint, streak bigint, longest bigint, tripped boolean", outputMode="Update", timeMode="None")


def micro_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a batch operator on every micro-batch.  step gets the batch id: writing under it makes repeats harmless."""
    return stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def exactly_once(root: str) -> Callable[[DataFrame, int], None]:
    """A step that writes each batch under its id: a batch that comes again replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return write


def run_to_table(stream: DataFrame, root: str, mode: str = "append") -> None:
    """Run a stream over what is there into Parquet files."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", root).option("checkpointLocation", f"{root}-checkpoint").trigger(availableNow=True).start().awaitTermination()


def table_stream(spark: SparkSession, folder: str, name: str, files: int = 1) -> DataFrame:
    """A table of a folder as a file stream, so many files to a micro-batch."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", name).parquet(folder)
