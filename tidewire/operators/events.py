"""Ranking of hot events with their mentions, sources and knowledge attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.arrays import distinct_array, ordered_array
from tidewire.functions.rules import first_label
from tidewire.operators.ranking import top_n_per_group
from tidewire.runtime import staged


@dataclass(frozen=True)
class Pool:
    """A named candidate pool: its condition over event columns, its priority (smaller first) and its quota."""

    name: str
    condition: Column
    priority: int
    quota: int


def web_urls(url: Column) -> Column:
    """Whether a URL is there and is an http one."""
    return url.isNotNull() & url.startswith("http")


def candidates(events: DataFrame, pools: Sequence[Pool]) -> DataFrame:
    """Events that fall in some pool, with ``pool`` and ``pool_priority`` of the first that fits; the rest is dropped."""
    rules = sorted(pools, key=lambda p: p.priority)
    kind = first_label([(p.condition, p.name) for p in rules])
    rank = F.create_map(*[F.lit(x) for p in rules for x in (p.name, p.priority)])
    return events.filter(web_urls(F.col("source_url"))).withColumn("pool", kind).filter(F.col("pool").isNotNull()).withColumn("pool_priority", rank[F.col("pool")])


def top_events(events: DataFrame, pools: Sequence[Pool], limit: int) -> DataFrame:
    """One row for each event, at most each pool's quota, at most ``limit`` rows, the hottest first.

    Order: priority, more articles, stronger tone, smaller event id. Both windows have constant bounds, so Spark limits
    each group before the shuffle; the result is bounded by ``limit`` and may be broadcast.
    """
    heat = [F.col("num_articles").desc_nulls_last(), F.abs("tone100").desc_nulls_last(), F.col("event_id").asc()]
    one = top_n_per_group(candidates(events, pools), ["event_id"], [F.col("pool_priority").asc(), *heat, F.col("source_url").asc_nulls_last()], 1)
    place = F.row_number().over(Window.partitionBy("pool").orderBy(*heat))
    quota = F.create_map(*[F.lit(x) for p in pools for x in (p.name, p.quota)])
    # the constant bound lets Spark limit each pool before the shuffle; the quota of the own pool follows
    kept = one.withColumn("_place", place).filter(F.col("_place") <= max(p.quota for p in pools)).filter(F.col("_place") <= quota[F.col("pool")]).drop("_place")
    return kept.orderBy(F.col("pool_priority").asc(), *heat).limit(limit)


def latest_mentions(mentions: DataFrame, top: DataFrame, blocked_hosts: str) -> DataFrame:
    """The latest mention of each (event, url) for the top events, without blocked hosts; ``top`` is bounded by its limit.

    The mentions of these events are written first, so that the pattern of hosts is tried on them alone and not, pushed
    below the join, on every mention there is.
    """
    own = staged(mentions.join(F.broadcast(top.select("event_id")), "event_id", "left_semi"), "top_mentions")
    near = own.filter(web_urls(F.col("url")) & ~F.lower("url").rlike(blocked_hosts))
    return top_n_per_group(near, ["event_id", "url"], [F.col("mention_time").desc_nulls_last(), F.col("source_name").asc_nulls_last()], 1)


def event_sources(top: DataFrame, mentions: DataFrame, urls: int = 20, names: int = 10) -> DataFrame:
    """Each top event with its newest mention urls, its source names, and how many different urls mention it.

    Events without a mention keep their own url as the only source and count one.
    """
    most = top_n_per_group(mentions, ["event_id"], [F.col("mention_time").desc_nulls_last(), F.col("url").asc()], urls)
    lists = most.groupBy("event_id").agg(ordered_array(F.col("url"), [(F.col("mention_time"), True)], urls).alias("source_urls"))
    counts = mentions.groupBy("event_id").agg(distinct_array(F.col("source_name"), names).alias("mention_sources"), F.count_distinct("url").alias("source_count"))
    joined = top.join(lists, "event_id", "left").join(counts, "event_id", "left")
    return joined.select(
        *top.columns,
        F.coalesce("source_urls", F.array("source_url")).alias("source_urls"),
        F.coalesce("mention_sources", F.array().cast("array<string>")).alias("mention_sources"),
        F.greatest(F.coalesce("source_count", F.lit(1)), F.lit(1)).alias("source_count"),
    )


def event_documents(top: DataFrame, mentions: DataFrame, limit: int = 12) -> DataFrame:
    """(event_id, url, doc_time, is_primary): the event's own url first, then its newest mentions, ``limit`` in all."""
    own = top.filter(web_urls(F.col("source_url"))).select("event_id", F.col("source_url").alias("url"), F.col("added").alias("doc_time"), F.lit(1).alias("is_primary"))
    other = mentions.select("event_id", "url", F.col("mention_time").alias("doc_time"), F.lit(0).alias("is_primary"))
    docs = own.union(other).distinct()
    return top_n_per_group(docs, ["event_id"], [F.col("is_primary").desc(), F.col("doc_time").desc_nulls_last(), F.col("url").asc()], limit)


def knowledge_of_events(docs: DataFrame, knowledge: DataFrame, columns: Sequence[str], limit: int = 50) -> DataFrame:
    """Each event's different attribute values over its documents, ``limit`` of each column in ascending order, joined by ';'."""
    hits = knowledge.join(F.broadcast(docs.select("event_id", "url")), knowledge["document"] == F.col("url"))
    return hits.groupBy("event_id").agg(*[F.array_join(distinct_array(F.col(c), limit), ";").alias(c) for c in columns])


def limited_then_distinct(events: DataFrame, knowledge: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """Events joined to knowledge rows by their own url, limited in order, and only then one row for each event.

    The join may fan out and the limit counts the fanned rows, so fewer than ``limit`` events can remain.
    """
    joined = events.join(knowledge, events["source_url"] == knowledge["document"], "left").orderBy(*order).limit(limit)
    return top_n_per_group(joined, ["event_id"], list(order), 1)


def with_scores(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``df`` with further computed columns, each of which may use the ones before it."""
    for name, c in columns.items():
        df = df.withColumn(name, c)
    return df
