"""Writes as snapshots: feed polls, enrichment batches, single saves, catalogue, run logs, coverage days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storyloom.functions import arrays as A

#: What a poll can come to: condition over the poll and the feed, then is_active and disabled_reason; the first that holds counts.
OUTCOMES: tuple[tuple[str, bool, str | None], ...] = (
    ("success and reactivate", True, None),
    ("not success and fails >= {most}", False, "errors"),
    ("success and dormant", False, "dormant"),
)


def polled(feeds: DataFrame, polls: DataFrame, now: int, most: int = 5) -> DataFrame:
    """Feeds after polls (id, success, new_articles, reactivate, dormant); feeds without a poll stay as they are.

    A missing flag is false and a missing count 0.  Feeds and polls are joined by id as text, so numeric and textual
    ids meet.
    """
    said = polls.groupBy(F.col("id").cast("string").alias("key")).agg(
        F.coalesce(F.bool_or("success"), F.lit(False)).alias("success"), F.coalesce(F.sum("new_articles"), F.lit(0)).alias("new_articles"), F.coalesce(F.bool_or("reactivate"), F.lit(False)).alias("reactivate"),
        F.coalesce(F.bool_or("dormant"), F.lit(False)).alias("dormant"), F.lit(True).alias("polled"),
    )
    rows = feeds.join(said, F.col("id").cast("string") == F.col("key"), "left").withColumn("fails", F.when(F.col("success"), 0).otherwise(F.col("fail_count") + 1))
    which = F.coalesce(*[F.when(F.expr(cond.format(most=most)), k) for k, (cond, _, _) in enumerate(OUTCOMES)], F.lit(-1))
    rows = rows.withColumn("which", which)
    outcome = lambda at, old: F.coalesce(*[F.when(F.col("which") == k, F.struct(F.lit(o[at]).cast(dict(feeds.dtypes)[old]).alias("v"))) for k, o in enumerate(OUTCOMES)], F.struct(F.col(old).alias("v")))["v"]
    found = F.col("success") & (F.col("new_articles") > 0)
    new: dict[str, Column] = {
        "fail_count": F.col("fails"), "last_polled_at": F.lit(now), "last_success_at": F.when(F.col("success"), now).otherwise(F.col("last_success_at")), "articles_found": F.col("articles_found") + F.col("new_articles"),
        "last_new_article_at": F.when(found, now).otherwise(F.col("last_new_article_at")), "is_active": outcome(1, "is_active"), "disabled_reason": outcome(2, "disabled_reason"),
    }
    return rows.select(*[F.when(F.col("polled"), new[c]).otherwise(F.col(c)).cast(t).alias(c) if c in new else F.col(c) for c, t in feeds.dtypes])


# ------------------------------------------------------------------ enrichment
#: Columns that an enrichment sets; one that is missing becomes null, as the step gave nothing.
ENRICHED = ("word_count", "language_detected", "sentiment", "category", "ai_summary", "keywords")
#: What a later page crawl may bring, and the most characters of each.
CRAWLED = {"description": 2000, "top_image_url": 500, "author": 300}


def saved(articles: DataFrame, items: DataFrame, now: int) -> DataFrame:
    """Articles after items (id, update struct, crawl struct or null): enrichment overwrites, crawl fills in, the error goes, the time is set last.

    The page's description, image and author overwrite where it has them; a title and a date only fill missing ones.
    """
    rows = articles.join(items.select("id", "update", "crawl", F.lit(True).alias("hit")), "id", "left")
    page = lambda c: F.col(f"crawl.{c}")
    blank = F.coalesce(F.col("title"), F.lit("")) == ""
    new: dict[str, Column] = {c: F.col(f"update.{c}") for c in ENRICHED} | {c: F.coalesce(F.left(page(c), F.lit(n)), F.col(c)) for c, n in CRAWLED.items()}
    new |= {
        "title": F.when(blank & page("title").isNotNull(), F.left(page("title"), F.lit(1000))).otherwise(F.col("title")), "published_at": F.coalesce("published_at", page("published_at")), "is_crawled": F.coalesce(page("is_crawled"), "is_crawled"),
        "enrich_error": F.lit(None), "enriched_at": F.lit(now),
    }
    return rows.select(*[F.when(F.col("hit"), new[c]).otherwise(F.col(c)).cast(t).alias(c) if c in new else F.col(c) for c, t in articles.dtypes])


def replaced_entities(entities: DataFrame, items: DataFrame, articles: DataFrame) -> DataFrame:
    """entities (article_id, text, type, salience) with those of the items' articles replaced; articles that do not exist get none."""
    kept = entities.join(items.select(F.col("id").alias("article_id")), "article_id", "left_anti")
    new = items.join(articles.select("id"), "id", "left_semi").select(F.col("id").alias("article_id"), F.inline("entities"))
    return kept.select("article_id", "text", "type", "salience").unionByName(new)


def tallied(stories: DataFrame, items: DataFrame, articles: DataFrame) -> DataFrame:
    """Active stories (cluster_id, status, entity_set, top_entities) with the entities and keys of their newly saved articles."""
    home = articles.filter("cluster_id is not null").select("id", "cluster_id")
    rows = items.join(home, "id")
    one = F.lit(1).cast("bigint")
    found = rows.groupBy("cluster_id").agg(
        A.list_in_order(F.col("id"), F.transform("entities", lambda e: F.struct(e["text"].alias("text"), e["type"].alias("type"), one.alias("count")))).alias("ents"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("entity_keys")))).alias("keys"),
    )
    both = stories.join(found, "cluster_id", "left")
    hit = F.col("ents").isNotNull() & (F.col("status") == "active")
    new = {"top_entities": A.merged_entities(F.col("top_entities"), F.flatten("ents"), 30), "entity_set": A.union("entity_set", "keys", 200)}
    return both.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in stories.columns])


def failed(articles: DataFrame, errors: DataFrame, most: int = 1000) -> DataFrame:
    """Articles with the text of their last error, cut; they stay unenriched."""
    rows = articles.join(errors.select("id", F.left("error", F.lit(most)).alias("_error")), "id", "left")
    return rows.withColumn("enrich_error", F.coalesce("_error", "enrich_error")).select(*articles.columns)


# ------------------------------------------------------------------ queue sweep
def swept(queue: DataFrame, outcomes: DataFrame, now: int, min_age: int, lease: int, most: int = 10) -> DataFrame:
    """id, outcome, attempts of what a sweep claims: rows old enough, not enriched, with no live lease and attempts left.

    outcomes (id, saved boolean): what became of each; a claim raises the attempts.  Not saved and out of attempts is
    'dead letter'; not saved otherwise is 'released' and gives its attempt back.
    """
    free = F.col("enrich_claimed_at").isNull() | (F.col("enrich_claimed_at") < now - lease)
    claimed = queue.filter(F.col("enriched_at").isNull() & (F.col("crawled_at") <= now - min_age) & free & (F.col("enrich_attempts") < most)).withColumn("tried", F.col("enrich_attempts") + 1)
    rows = claimed.join(outcomes.select("id", "saved"), "id", "left").withColumn("saved", F.coalesce("saved", F.lit(False)))
    dead = ~F.col("saved") & (F.col("tried") >= most)
    outcome = F.when(F.col("saved"), "saved").when(dead, "dead letter").otherwise("released")
    return rows.select("id", outcome.alias("outcome"), F.when(F.col("saved") | dead, F.col("tried")).otherwise(F.col("enrich_attempts")).alias("attempts"))


# ------------------------------------------------------------------ catalogue, runs, coverage
def catalogue_new(rows: DataFrame, stored: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The best row of each key by `order` that no stored row shares under any of `keys`; conflicts are ignored."""
    best = rows.withColumn("_k", F.row_number().over(W.partitionBy(keys[0]).orderBy(*order))).filter("_k = 1").drop("_k")
    for k in keys:
        best = best.join(stored.select(F.explode(F.array(*keys)).alias(k)).distinct(), k, "left_anti")
    return best.select(*rows.columns)


def run_log(log: DataFrame, started: DataFrame, finished: DataFrame) -> DataFrame:
    """The run log after starts and finishes: a start opens a row, a finish completes it; columns that the log lacks are dropped."""
    opened = log.unionByName(started.select(*[c for c in started.columns if c in log.columns]), allowMissingColumns=True)
    own = [c for c in finished.columns if c in log.columns and c != "run_id"]
    done = finished.select("run_id", *[F.col(c).alias(f"_{c}") for c in own])
    return opened.join(done, "run_id", "left").select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in own else F.col(c) for c in log.columns])


def write_coverage(rows: DataFrame, root: str) -> None:
    """Coverage rows by day: days that come again are replaced whole, other days stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(root)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new, and those of old whose key new does not have."""
    return old.join(new.select(*keys), keys, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))
