"""Merging of rows that tell the same story."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.ranking import distributed_rank, top_n_per_group


def merged(df: DataFrame, cluster: str, id_col: str, lead: Sequence[Column], sums: Sequence[str], urls: str, cap: int = 20) -> DataFrame:
    """One row for each cluster: its leading row's id, the largest of each number, and the union of the url arrays.

    The urls of the leading rows come first; ``cap`` of them stay. A null cluster is no cluster: such rows pass alone.
    ``lead`` must end in a unique key. Rows are ranked over range partitions and each url of a cluster counts at its first
    place, so a hot cluster sends a task no more than ``cap`` urls of each partition.
    """
    key = F.coalesce(F.col(cluster).cast("string"), F.concat(F.lit("\u0001"), F.col(id_col).cast("string")))
    rows = df.withColumn("_c", key)
    size = rows.groupBy("_c").agg(F.count(F.lit(1)).alias("members"), *[F.max(c).alias(c) for c in sums])
    placed = distributed_rank(rows, ["_c"], lead, "_r")
    first = placed.filter("_r = 1").select("_c", F.col(id_col))
    listed = placed.select("_c", "_r", F.posexplode(urls).alias("_p", "_u")).filter("_u IS NOT NULL")
    at = listed.groupBy("_c", "_u").agg(F.min(F.struct("_r", "_p")).alias("_at"))
    leading = top_n_per_group(at, ["_c"], [F.col("_at").asc()], cap)
    lists = leading.groupBy("_c").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_u"))), lambda x: x["_u"]).alias("_l"))
    out = first.join(size, "_c").join(lists, "_c", "left")
    return out.select(id_col, "members", *sums, F.coalesce("_l", F.array().cast("array<string>")).alias(urls))


def best_of_cluster(df: DataFrame, cluster: Column, id_col: str, order: Sequence[Column]) -> DataFrame:
    """The first row of each cluster in order; rows without a cluster all pass."""
    key = F.coalesce(cluster.cast("string"), F.concat(F.lit("\u0001"), F.col(id_col).cast("string")))
    return top_n_per_group(df.withColumn("_c", key), ["_c"], list(order), 1).drop("_c")


def label_matrix(df: DataFrame, row: str, labels: Column, values: Sequence[str]) -> DataFrame:
    """How many rows of each ``row`` value carry each label, one column for each of ``values``; a row may carry many."""
    long = df.select(F.col(row), F.explode(labels).alias("label"))
    return long.groupBy(row).pivot("label", list(values)).agg(F.count(F.lit(1))).na.fill(0)


def better_time(old: Column, new: Column, has_clock_old: Column, has_clock_new: Column) -> Column:
    """The time to keep: one with a clock before one without, then the later; null loses."""
    return (
        F.when(old.isNull(), new)
        .when(new.isNull(), old)
        .when(has_clock_new & ~has_clock_old, new)
        .when(has_clock_old & ~has_clock_new, old)
        .otherwise(F.greatest(old, new))
    )


def age_hours(at: Column, as_of: Column) -> Column:
    """Whole hours from ``at`` to ``as_of``, 0 at least; null without a time."""
    seconds = F.unix_micros(F.to_timestamp(as_of)) - F.unix_micros(F.to_timestamp(at))
    return F.when(at.isNotNull(), F.greatest(F.lit(0), F.floor(seconds / 3_600_000_000)))
