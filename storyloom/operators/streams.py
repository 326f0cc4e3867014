"""Queries of the streaming mode: file streams over the driver's tables, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators.lifecycle import folder
from storyloom.operators.stories import read
from storyloom.plans.registry import query
from storyloom.streaming import ingest as I

#: The same rows in four files, in order of event_id, as they would arrive.
FILES = 4


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of four files; every tenth has a time 40 hours back, and is late once the watermark has passed."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    n = e.agg(F.max("event_id")).first()[0] or 0
    root = folder(spark, "arrivals")
    part = F.least(F.floor(F.col("event_id") * FILES / F.lit(n + 1)), F.lit(FILES - 1)).cast("int")
    late = F.when(F.col("event_id") % 10 == 0, F.col("ts") - F.expr("INTERVAL 40 HOURS")).otherwise(F.col("ts"))
    rows = e.withColumn("ts", late).withColumn("part", part)
    for k in range(FILES):  # one file after the other, so that their order of arrival is fixed
        rows.filter(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(root)
    return spark.readStream.schema(rows.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(root)


@query("t1_dedup_in_watermark", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def t1_dedup_in_watermark(spark, sf_dir):
    """Each user and kind of event once: a retention longer than the data keeps all keys in state."""
    stream = arrivals(spark, sf_dir).withColumn("key", F.concat_ws("/", "user_id", "event_type"))
    root = folder(spark, "deduplicated")
    I.run_to_table(I.deduplicated(stream, "key", "ts", "36500 days").select("user_id", "event_type"), root)
    return spark.read.schema("user_id bigint, event_type string").parquet(root)


@query("t2_late_accepted", "SELECT event_type, count(*) AS n, count(*) FILTER (event_id % 10 = 0) AS late FROM events GROUP BY 1")
def t2_late_accepted(spark, sf_dir):
    """Rows 40 hours late are counted where the retention is longer; the sum over windows shows that none was lost."""
    stream = arrivals(spark, sf_dir).withColumn("late", F.col("event_id") % 10 == 0)
    root = folder(spark, "late")

    def step(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/k={k}")

    I.micro_batches(I.tumbling_counts(stream, "ts", "event_type", "late", retention="36500 days"), step, f"{root}-checkpoint", "update").awaitTermination()
    rows = spark.read.schema("start timestamp, event_type string, late boolean, n bigint, k int").parquet(root)
    last = rows.groupBy("start", "event_type", "late").agg(F.max_by("n", "k").alias("n"))
    return last.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("late"), F.col("n"))).alias("late"))


@query("t4_stream_windows", "SELECT CAST(epoch(date_trunc('day', CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 40 HOUR ELSE ts END)) AS BIGINT) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def t4_stream_windows(spark, sf_dir):
    """Tumbling windows over the stream, complete at its end."""
    root = folder(spark, "windows")

    def step(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/last")

    counts = I.tumbling_counts(arrivals(spark, sf_dir), "ts", "event_type", retention="36500 days")
    counts.writeStream.outputMode("complete").foreachBatch(step).option("checkpointLocation", f"{root}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("start timestamp, event_type string, n bigint").parquet(f"{root}/last")
    return rows.select(F.unix_timestamp("start").alias("day"), "event_type", "n")


@query("t6_stateful_streaks", """WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS grp FROM events),
s AS (SELECT user_id, grp, sum(bad) AS n FROM e GROUP BY 1, 2) SELECT user_id AS key, CAST(max(n) AS BIGINT) AS longest, max(n) >= 3 AS tripped FROM s GROUP BY 1""")  # fmt: skip
def t6_stateful_streaks(spark, sf_dir):
    """Failures in a row kept in state across micro-batches; the batch form is streak_breaker."""
    stream = arrivals(spark, sf_dir).select(F.col("user_id").alias("key"), F.col("event_id").alias("place"), (F.col("event_type") == "error").alias("bad"))
    root, before = folder(spark, "streaks"), spark.conf.get(I.STATE_STORE, None)

    def step(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/k={k}")

    spark.conf.set(I.STATE_STORE, I.ROCKS)
    try:
        I.failure_streaks(stream).writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", f"{root}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(I.STATE_STORE, before) if before else spark.conf.unset(I.STATE_STORE)
    rows = spark.read.schema("key bigint, streak bigint, longest bigint, tripped boolean, k int").parquet(root)
    return rows.groupBy("key").agg(F.max("longest").alias("longest"), F.max("tripped").alias("tripped"))


@query("t7_exactly_once", "SELECT event_id FROM events")
def t7_exactly_once(spark, sf_dir):
    """Every batch is written twice under its id, as after a failure; each row stands once."""
    root = folder(spark, "once")
    write = I.exactly_once(root)

    def twice(batch: DataFrame, k: int) -> None:
        write(batch, k)
        write(batch, k)

    I.micro_batches(arrivals(spark, sf_dir).select("event_id"), twice, f"{root}-checkpoint").awaitTermination()
    return spark.read.schema("event_id bigint, batch int").parquet(root).select("event_id")


@query("t8_micro_batches", f"WITH p AS (SELECT least(CAST(event_id * {FILES} // (SELECT max(event_id) + 1 FROM events) AS INTEGER), {FILES - 1}) AS batch FROM events) SELECT CAST(batch AS INTEGER) AS batch, count(*) AS n FROM p GROUP BY 1")
def t8_micro_batches(spark, sf_dir):
    """A batch operator (a count) on every micro-batch; one file is one batch."""
    root = folder(spark, "batches")

    def step(batch: DataFrame, k: int) -> None:
        batch.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/batch={k}")

    I.micro_batches(arrivals(spark, sf_dir), step, f"{root}-checkpoint").awaitTermination()
    return spark.read.schema("n bigint, batch int").parquet(root).select("batch", "n")
