"""Changes to stored tables as snapshot functions: a new table out of the old one and a batch of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.runtime import broadcast_if_small, staged


def upserted(old: DataFrame, new: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """``old`` with the rows of ``new`` put in its place by key; among new rows of one key the last in ``order`` wins.

    One aggregate on the key; columns that only one side has are null on the other (additive schemas). Rows with a null
    key are kept apart as one key.
    """
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c != "_new"]
    rank = F.struct("_new", *[F.col(c) for c in order], F.xxhash64(*columns))
    return both.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*columns), rank).alias("r")).select("r.*")


def touched(articles: DataFrame, hashes: DataFrame, at: Column) -> DataFrame:
    """``articles`` with ``extracted_at`` set where their content hash is one of ``hashes``."""
    seen = hashes.select(F.col("content_hash").alias("_h")).distinct().withColumn("_hit", F.lit(True))
    out = articles.join(seen, F.col("content_hash") == F.col("_h"), "left")
    return out.withColumn("extracted_at", F.when(F.col("_hit"), at).otherwise(F.col("extracted_at"))).select(*articles.columns)


def kept_by_ids(df: DataFrame, key: str, keep: DataFrame) -> DataFrame:
    """Rows whose key is in ``keep``; an empty keep list keeps all. The test is one row joined on, so the plan stays lazy."""
    ids = keep.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    marked = df.join(ids.withColumn("_in", F.lit(True)), F.col(key) == F.col("_k"), "left")
    none = ids.agg((F.count(F.lit(1)) == 0).alias("_none"))
    return marked.join(F.broadcast(none)).filter(F.col("_none") | F.col("_in")).select(*df.columns)


def purged_by_day(df: DataFrame, day: Column, days: Sequence[str]) -> DataFrame:
    """Rows whose day is one of ``days`` or unknown."""
    return df.filter(day.isNull() | day.isin(list(days)))


def replayed_frontier(log: DataFrame) -> DataFrame:
    """The state of each URL after its transitions, by ``(ts, seq)``: a fold that splits into aggregates.

    Log: url_hash, url, source_id, action (upsert, crawled, failed, skipped), error_type, content_hash, next_crawl_at, ts,
    seq. An upsert makes the row pending and keeps old values where its own are null; crawled clears the error; failed
    and skipped count a retry and clear the next crawl. What comes before the first upsert of a URL is ignored. Every
    field is the last of some kind of transition, so partial aggregates suffice and a hot URL costs one row per task; only
    the URLs that something happened to before their first upsert, which are few, are joined back to their rows.
    """
    order = F.struct("ts", "seq")
    firsts = log.groupBy("url_hash").agg(F.min(order).alias("_any"), F.min(F.when(F.col("action") == "upsert", order)).alias("_first"))
    early = staged(firsts.filter(F.col("_first").isNull() | (F.col("_any") < F.col("_first"))).select(F.col("url_hash").alias("_u"), "_first", F.lit(True).alias("_early")), "early")
    rows = log.filter(F.col("url_hash").isNotNull()).join(broadcast_if_small(early, 96), F.col("url_hash") == F.col("_u"), "left")
    rows = rows.filter(F.col("_early").isNull() | (order >= F.col("_first"))).drop("_u", "_first", "_early")
    bad, crawled, up = F.col("action").isin("failed", "skipped"), F.col("action") == "crawled", F.col("action") == "upsert"
    last = lambda value, when: F.max_by(value, F.when(when, order))
    out = rows.groupBy("url_hash").agg(
        last("url", up).alias("url"),
        last("source_id", up).alias("source_id"),
        F.max_by(F.when(up, F.lit("pending")).otherwise(F.col("action")), order).alias("status"),
        F.count_if(bad).alias("retry_count"),
        F.max_by("error_type", F.when(bad, order)).alias("_error"),
        F.max(F.when(bad, order)).alias("_bad"),
        F.max(F.when(crawled, order)).alias("_crawled"),
        F.min("ts").alias("first_seen_at"),
        F.max("ts").alias("last_seen_at"),
        F.max(F.when(crawled, F.col("ts"))).alias("last_crawled_at"),
        last("next_crawl_at", up & F.col("next_crawl_at").isNotNull()).alias("_next"),
        F.max(F.when(up & F.col("next_crawl_at").isNotNull(), order)).alias("_planned"),
        last("content_hash", (up | crawled) & F.col("content_hash").isNotNull()).alias("content_hash"),
    )
    error = F.when(F.col("_bad").isNotNull() & (F.col("_crawled").isNull() | (F.col("_bad") > F.col("_crawled"))), F.col("_error"))
    planned = F.when(F.col("_bad").isNull() | (F.col("_planned") > F.col("_bad")), F.col("_next"))
    return out.select(
        "url_hash", "url", "source_id", "status", "retry_count", error.alias("last_error_type"), "first_seen_at", "last_seen_at", "last_crawled_at", planned.alias("next_crawl_at"), "content_hash"
    )


def window_ladder(counts: DataFrame, rungs: Sequence[int], least: int) -> DataFrame:
    """One row (hours, n): the first rung with at least ``least`` rows; (null, null) if none has.

    ``counts`` has one row with a column h<rung> for each rung, made in one pass by conditional counts.
    """
    hours = n = None
    for r in rungs:
        c = F.col(f"h{r}")
        hours = F.when(c >= least, r) if hours is None else hours.when(c >= least, r)
        n = F.when(c >= least, c) if n is None else n.when(c >= least, c)
    return counts.select(hours.alias("hours"), n.alias("n"))
