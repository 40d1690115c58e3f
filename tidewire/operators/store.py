"""Rollups, snapshots and joins over the crawl store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import urls

UNKNOWN = "(unknown)"


def named(source: Column) -> Column:
    """The trimmed source id, or '(unknown)' for null and blank ones."""
    return F.coalesce(F.nullif(F.trim(source), F.lit("")), F.lit(UNKNOWN))


def source_health(profiles: DataFrame, articles: DataFrame, errors: DataFrame, frontier: DataFrame, discovered: DataFrame) -> DataFrame:
    """One row for each source of any of profiles, articles, errors and frontier: counts, last times, success share.

    Four aggregates on the source key and left joins of their small results; no row of a fact table moves but partial
    sums and the different (source, url) pairs. Blank ids count on the profile side only. The last error type is the one
    of the newest error, ties by the larger id. A source without articles and errors has the share 0.
    """
    ids = profiles.select("source_id")
    for facts in (articles, errors, frontier):
        ids = ids.union(facts.filter(F.col("source_id").isNotNull() & (F.col("source_id") != "")).select("source_id"))
    seen = frontier.select("source_id", "url").union(discovered.select("source_id", "url")).distinct()
    seen = seen.groupBy("source_id").agg(F.count("url").alias("urls_seen"))
    arts = articles.groupBy("source_id").agg(F.count(F.lit(1)).alias("articles"), F.max("extracted_at").alias("last_success_at"))
    errs = errors.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("errors"), F.max("created_at").alias("last_error_at"), F.max_by("error_type", F.struct("created_at", "id")).alias("last_error_type")
    )
    out = ids.distinct().join(seen, "source_id", "left").join(arts, "source_id", "left").join(errs, "source_id", "left")
    a, e = F.coalesce("articles", F.lit(0)), F.coalesce("errors", F.lit(0))
    share = F.when(a + e > 0, F.round(a / (a + e), 6)).otherwise(0.0)
    return out.select(
        "source_id", F.coalesce("urls_seen", F.lit(0)).alias("urls_seen"), a.alias("articles"), e.alias("errors"), "last_success_at", "last_error_at", "last_error_type", share.alias("success_rate")
    )


def intake(counted: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per source of several tables, side by side: a full outer merge done as one union and one aggregate.

    Null and blank sources count under '(unknown)', missing counts are 0.
    """
    parts: DataFrame | None = None
    for name, df in counted.items():
        own = df.groupBy(named(F.col("source_id")).alias("source_id")).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit(name))
        parts = own if parts is None else parts.unionByName(own)
    return parts.groupBy("source_id").agg(*[F.coalesce(F.sum(F.when(F.col("what") == name, F.col("n"))), F.lit(0)).alias(name) for name in counted])


def top_labels(df: DataFrame, key: str, label: str, n: int = 4) -> DataFrame:
    """(key, labels): the ``n`` most frequent labels of each key as 'label:count, ...'; ties by label, nulls left out."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key).orderBy(F.desc("n"), F.asc(label))
    top = counts.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n)
    item = F.struct("r", F.concat(F.col(label), F.lit(":"), F.col("n").cast("string")).alias("s"))
    return top.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"]), ", ").alias("labels"))


def with_zero_rows(counts: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Counts for every value of a small dimension, 0 where none was counted."""
    return values.join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def suffix_join(left: DataFrame, domain: str, allowed: DataFrame, name: str = "allowed") -> DataFrame:
    """Rows whose domain is an allowed one or lies below it, with the longest allowed domain.

    The parents of a domain are exploded and matched by equality, so no pair of rows is compared by text.
    """
    own = left.withColumn("_row", F.monotonically_increasing_id()).select("*", F.posexplode(urls.domain_suffixes(F.col(domain))).alias("_depth", "_suffix"))
    hits = own.join(allowed.select(F.lower(name).alias("_suffix")).distinct(), "_suffix")
    w = Window.partitionBy("_row").orderBy("_depth")
    return hits.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*left.columns, F.col("_suffix").alias("matched_domain"))


def alias_index(articles: DataFrame, order: list[Column]) -> DataFrame:
    """(key, id): the first article, in order, for the page key of its URL with and without www. and its query."""
    keys = F.array(urls.page_key(F.col("url")), urls.page_query_key(F.col("url")), urls.loose_key(F.col("url")))
    rows = articles.filter(F.col("url").isNotNull()).select("*", F.explode(F.array_distinct(keys)).alias("key"))
    w = Window.partitionBy("key").orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("key", "id")


def overlap_counts(members: DataFrame, group: str, item: str) -> DataFrame:
    """(a, b, n): how many different items each pair of groups shares, a < b.

    Items are grouped first, so a hot item costs pairs of the groups that hold it and not of its rows.
    """
    sets = members.filter(F.col(group).isNotNull() & F.col(item).isNotNull()).select(group, item).distinct()
    held = sets.groupBy(item).agg(F.array_sort(F.collect_set(group)).alias("g")).filter(F.size("g") > 1)
    pairs = held.select(F.posexplode("g").alias("i", "a"), "g").select("a", F.explode(F.slice("g", F.col("i") + 2, F.size("g"))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def drop_reasons(df: DataFrame, rules: list[tuple[str, Column]], default: str = "kept") -> DataFrame:
    """``df`` with ``reason``: the name of the first rule that is true, else ``default``."""
    out: Column | None = None
    for name, condition in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return df.withColumn("reason", out.otherwise(default))
