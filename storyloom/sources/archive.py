"""Sinks: day-partitioned archive with verification and guarded prune, hand-off and body files, typed Parquet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DecimalType, DoubleType, FloatType, IntegralType, MapType, StructType, VariantType

PART_ROWS = 10_000
#: day date, rows, min_id, max_id, parts, sha256 of every part by path, status, pruned.
LOG = "day date, rows bigint, min_id bigint, max_id bigint, parts array<struct<path:string,rows:bigint,bytes:bigint,sha256:string>>, status string, pruned bigint"


class ArchiveError(RuntimeError):
    """An archive step that was refused."""


def archive_types(df: DataFrame, *keep: str) -> DataFrame:
    """Columns as the archive stores them: *_at are timestamps, nested values JSON, integers 64 bits, other numbers doubles, the rest text."""

    def stored(f) -> Column:
        c = F.col(f.name)
        if f.name in keep or isinstance(f.dataType, BooleanType):
            return c
        if f.name.endswith("_at"):
            return c.cast("timestamp")
        if isinstance(f.dataType, (StructType, ArrayType, MapType, VariantType)):
            return F.to_json(c)
        if isinstance(f.dataType, IntegralType):
            return c.cast("bigint")
        return c.cast("double" if isinstance(f.dataType, (FloatType, DoubleType, DecimalType)) else "string")

    return df.select(*[stored(f).alias(f.name) for f in df.schema.fields])


def write_parquet(df: DataFrame, path: str, *by: str) -> None:
    """Typed rows as Parquet, zstd at its ninth level; partitions that come again are replaced."""
    writer = archive_types(df, *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", PART_ROWS)
    writer = writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "9")
    (writer.partitionBy(*by) if by else writer).parquet(path)


# ------------------------------------------------------------------ hand-off and bodies
def matched(inserted: DataFrame, crawled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hand-off rows, counts): inserted (id, url_hash, ...) with the crawled body (url_hash, full_text, paywalled); rows without one are counted."""
    body = crawled.groupBy("url_hash").agg(F.first("full_text").alias("full_text"), F.first("paywalled").alias("paywalled"), F.lit(True).alias("found"))
    both = inserted.join(body, "url_hash", "left")
    good = F.coalesce("found", F.lit(False)) & F.col("id").isNotNull()
    return both.filter(good).withColumn("paywalled", F.coalesce("paywalled", F.lit(False))).drop("found"), both.agg(F.count_if(good).alias("written"), F.count_if(~good).alias("unmatched"))


def write_handoff(df: DataFrame, root: str, body: str = "full_text", most: int = 80_000) -> None:
    """Gzipped JSON lines of new rows, bodies cut to `most` characters."""
    df.withColumn(body, F.left(F.coalesce(F.col(body), F.lit("")), F.lit(most))).write.mode("append").json(root, compression="gzip")


def write_bodies(df: DataFrame, root: str, time: str) -> None:
    """Bodies under year/month/day folders."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    df.withColumns({k: F.date_format(time, v) for k, v in parts.items()}).write.mode("append").partitionBy(*parts).json(root, compression="gzip")


def read_bodies(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, year string, month string, day string").json(root)


# ------------------------------------------------------------------ archive by day
def day_stats(rows: DataFrame, time: str, key: str = "id") -> DataFrame:
    """day, rows, min_id, max_id of the table by UTC day."""
    return rows.groupBy(F.to_date(time).alias("day")).agg(F.count("*").alias("rows"), F.min(key).alias("min_id"), F.max(key).alias("max_id"))


def parts(spark: SparkSession, root: str, key: str = "id") -> DataFrame:
    """day, path, rows, bytes, sha256, ids, min_id, max_id of every part as it stands in the folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    files = files.select(F.regexp_extract("path", "day=[^/]+/[^/]+$", 0).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    held = spark.read.parquet(root).select("day", key, F.regexp_extract(F.input_file_name(), "day=[^/]+/[^/]+$", 0).alias("path"))
    held = held.groupBy("day", "path").agg(F.count("*").alias("rows"), F.count_distinct(key).alias("ids"), F.min(key).alias("min_id"), F.max(key).alias("max_id"))
    return held.join(files, "path").withColumn("day", F.col("day").cast("date"))


def export_days(rows: DataFrame, root: str, time: str, key: str = "id") -> DataFrame:
    """Write whole days, PART_ROWS at most to a part, and return their LOG.

    A day that comes again replaces its old parts.  A day whose parts do not hold what the table held before is
    logged as 'changed' and must be exported again; all others are 'uploaded'.
    """
    spark = rows.sparkSession
    before = day_stats(rows, time, key)
    dated = rows.withColumn("day", F.to_date(time))
    placed = dated.repartition("day", F.floor(F.col(key) / PART_ROWS)).sortWithinPartitions("day", key)
    write_parquet(placed, root, "day")
    found = parts(spark, root, key).groupBy("day").agg(F.sum("rows").alias("written"), F.sort_array(F.collect_list(F.struct("path", "rows", "bytes", "sha256"))).alias("parts"))
    log = before.join(found, "day", "left")
    return log.select("day", "rows", "min_id", "max_id", "parts", F.when(F.col("written") == F.col("rows"), "uploaded").otherwise("changed").alias("status"), F.lit(0).cast("bigint").alias("pruned"))


def verify_days(log: DataFrame, root: str, table: DataFrame, time: str, key: str = "id") -> DataFrame:
    """day, status, reason: 'verified' where every part has its checksum and rows, ids are distinct and complete, and the table has not changed."""
    spark = log.sparkSession
    said = log.filter("status in ('uploaded', 'verified')").select("day", "rows", "min_id", "max_id", F.explode_outer("parts").alias("p"))
    real = parts(spark, root, key).select("day", "path", F.col("rows").alias("r"), "sha256", "ids", F.col("min_id").alias("lo"), F.col("max_id").alias("hi"))
    both = said.select("day", "rows", "min_id", "max_id", "p.path", F.col("p.rows").alias("said_rows"), F.col("p.sha256").alias("said_sha")).join(real, ["day", "path"], "left")
    days = both.groupBy("day", "rows", "min_id", "max_id").agg(
        F.count_if(~F.col("sha256").eqNullSafe(F.col("said_sha"))).alias("bad_sum"), F.count_if(~F.col("r").eqNullSafe(F.col("said_rows"))).alias("bad_rows"), F.sum("r").alias("r"), F.sum("ids").alias("ids"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    now = day_stats(table, time, key).select("day", F.col("rows").alias("now"))
    days = days.join(now, "day", "left")
    reason = F.when(F.col("bad_sum") > 0, "checksum mismatch").when(F.col("bad_rows") > 0, "row count mismatch").when((F.col("r") != F.col("rows")) | (F.col("ids") != F.col("rows")), "ids not distinct or incomplete")
    reason = reason.when((F.col("lo") != F.col("min_id")) | (F.col("hi") != F.col("max_id")), "id range differs").when(~F.col("now").eqNullSafe(F.col("rows")), "the table has changed")
    return days.select("day", F.when(reason.isNull(), "verified").otherwise("broken").alias("status"), reason.alias("reason"))


def prune_verdicts(log: DataFrame, table: DataFrame, time: str, today: str, hot_days: int) -> DataFrame:
    """day, verdict: 'prune' for verified days outside the hot window whose rows left plus rows pruned are those archived; else why not."""
    left = table.groupBy(F.to_date(time).alias("day")).agg(F.count("*").alias("left"))
    both = log.join(left, "day", "left").withColumn("left", F.coalesce("left", F.lit(0)))
    hot = F.col("day") >= F.date_sub(F.lit(today).cast("date"), max(hot_days, 1))
    verdict = F.when(F.col("status") == "pruned", "already pruned").when(F.col("status") != "verified", "not verified").when(hot, "inside the hot window").when(F.col("left") + F.col("pruned") != F.col("rows"), "changed since export").otherwise("prune")
    return both.select("day", verdict.alias("verdict"))


def pruned(table: DataFrame, verdicts: DataFrame, time: str) -> DataFrame:
    """The rows left once the days with verdict 'prune' are gone; other days are never touched."""
    gone = verdicts.filter("verdict = 'prune'").select(F.col("day").alias("gone"))
    return table.join(gone, F.to_date(time) == F.col("gone"), "left_anti")


def pending_days(table: DataFrame, log: DataFrame, time: str, today: str, hot_days: int) -> DataFrame:
    """day, status of days before the hot window that are not pruned yet (null: not exported)."""
    limit = F.date_sub(F.lit(today).cast("date"), hot_days)
    days = table.select(F.to_date(time).alias("day")).distinct().filter(F.col("day") < limit)
    return days.join(log.select("day", "status"), "day", "left").filter("status is null or status <> 'pruned'")


@dataclass
class Report:
    """What an archive run did, day by day."""

    exported: list[str] = field(default_factory=list)
    waiting: list[str] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)
    pruned: list[str] = field(default_factory=list)


def run_archive(table: DataFrame, log: DataFrame, root: str, time: str, today: str, hot_days: int = 30, waiting: Column | None = None, max_days: int | None = None, prune: bool = True, step: Callable | None = None) -> tuple[DataFrame, DataFrame, Report]:
    """(rows left, log, report): each pending day is exported, verified and pruned by itself, so a bad one does not stop the others.

    waiting: a condition of rows that are not done yet; days that hold one are not archived this time.  Days that are
    uploaded but not verified are exported again; verified ones are only pruned.  step is called before each day.
    """
    spark, report = table.sparkSession, Report()
    days = [(r["day"], r["status"]) for r in pending_days(table, log, time, today, hot_days).orderBy("day").limit(max_days or 100_000).collect()]
    open_days = {r[0] for r in table.filter(waiting).select(F.to_date(time)).distinct().collect()} if waiting is not None else set()
    rows = {r["day"]: r.asDict(recursive=True) for r in log.collect()}
    for day, status in days:
        name = day.isoformat()
        if status != "verified" and day in open_days:
            report.waiting.append(name)
            continue
        try:
            if step:
                step(name)
            own = table.filter(F.to_date(time) == F.lit(day))
            if status != "verified":
                new = spark.createDataFrame(export_days(own, root, time).collect(), LOG)
                if new.first()["status"] != "uploaded":
                    raise ArchiveError("the day changed during export")
                verdict = verify_days(new, root, own, time).first()
                if verdict["status"] != "verified":
                    raise ArchiveError(verdict["reason"])
                rows[day] = new.first().asDict(recursive=True) | {"status": "verified"}
                report.exported.append(name)
            if prune and prune_verdicts(spark.createDataFrame([rows[day]], LOG), own, time, today, hot_days).first()["verdict"] == "prune":
                rows[day] = rows[day] | {"status": "pruned", "pruned": rows[day]["rows"]}
                report.pruned.append(name)
        except Exception as e:  # one bad day never blocks the others; it is tried again next time
            report.failures[name] = str(e).splitlines()[0] if str(e) else type(e).__name__
    gone = spark.createDataFrame([(d,) for d in report.pruned], "d string").select(F.col("d").cast("date").alias("gone"))
    return table.join(gone, F.to_date(time) == F.col("gone"), "left_anti"), spark.createDataFrame(list(rows.values()), LOG), report


def read_days(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    """Partition-pruned read of a range of days."""
    return spark.read.parquet(root).filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
