"""Ranks inside groups of any size, without pulling a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.runtime import broadcast_if_small, fresh, staged


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | Column) -> DataFrame:
    """Rows whose rank in their group is at most ``n``; ``order`` must end in a unique key.

    Catalyst turns a constant bound into a group limit below the shuffle, so a hot group sends at
    most ``n`` rows per task. Nulls sort as ``order`` says; an empty input gives no rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    (rank,) = fresh(df, "_rank")
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n).drop(rank)


def one_row_each(df: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """``df`` with one row for each key: the one of the largest ``newest``, ties by a hash of the whole row.

    Only keys are grouped to find which of them repeat; rows of all others are passed on without a shuffle, so that texts
    move only where copies have to be told apart. Rows with a null key all stay.
    """
    (n,) = fresh(df, "_n")
    several = staged(df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > 1).select(key), "repeated_keys")
    small = broadcast_if_small(several, 64)
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rank = F.struct(*([F.col(newest)] if newest else []), F.xxhash64(whole))
    chosen = df.join(small, key, "left_semi").groupBy(F.col(key).alias(n)).agg(F.max_by(whole, rank).alias("_row")).select("_row.*")
    return df.join(small, key, "left_anti").unionByName(chosen)


def distributed_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add ``name``: the 1-based rank of each row in its group, for groups larger than one task holds.

    ``order`` must end in a unique key. Null group values form a group of their own; an empty frame stays empty.
    """
    return distributed_running_sum(df, keys, order, F.lit(1), name)


def distributed_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the group up to and with this one, as a long.

    The rows are range-partitioned by group and order and sorted inside each partition, so a hot group spreads over
    many tasks. Sums run inside each (group, partition) piece, and the offset of a piece is the sum of the pieces before
    it: at most one piece per group and partition boundary, a table of groups plus partitions. Null weights count 0.
    """
    piece, w, inner = fresh(df, "_piece", "_w", "_inner")
    spread = df.withColumn(w, F.coalesce(weight, F.lit(0)).cast("long")).repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *order)
    # the range bounds come from a sample; staging fixes which row went where before it is summed
    placed = staged(spread.withColumn(piece, F.spark_partition_id()), "ranked")
    inside = Window.partitionBy(*keys, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    pieces = placed.groupBy(*keys, piece).agg(F.sum(w).alias(inner))
    before = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    names = fresh(placed, "_before", "_at", *[f"_key{i}" for i in range(len(keys))])
    offsets = pieces.select(
        F.coalesce(F.sum(inner).over(before), F.lit(0)).alias(names[0]), F.col(piece).alias(names[1]), *[F.col(k).alias(n) for k, n in zip(keys, names[2:], strict=True)]
    )
    small = broadcast_if_small(staged(offsets, "offsets"), 80)
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names[2:], strict=True)] + [F.col(piece) == F.col(names[1])]
    summed = placed.withColumn(inner, F.sum(w).over(inside)).join(small, on, "inner")
    return summed.select(*[c for c in df.columns if c != name], (F.col(inner) + F.col(names[0])).alias(name))
