"""Quotas, samples, chunks and greedy picks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewire.operators.ranking import distributed_rank, distributed_running_sum, top_n_per_group
from tidewire.runtime import fresh, staged


def round_robin(df: DataFrame, key: str, newest: Sequence[Column], n: int) -> DataFrame:
    """``n`` rows, one of each group in turn, the largest groups first; ``newest`` orders inside a group and is unique.

    No group gives more than ``n`` rows, so each task sends at most ``n`` rows of a group to the window.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    first = top_n_per_group(df, [key], newest, n)
    turns = first.withColumn("_turn", F.row_number().over(Window.partitionBy(key).orderBy(*newest)))
    joined = turns.join(sizes.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")))
    order = [F.col("_turn").asc(), F.col("_size").desc(), F.col(key).asc_nulls_first(), *newest]
    return joined.orderBy(*order).limit(n).select(*df.columns)


def batches(df: DataFrame, order: Sequence[Column], size: int, name: str = "batch") -> DataFrame:
    """``df`` with the number of its batch of ``size`` rows, from 0, over the whole order; works at any size."""
    whole = df.withColumn("_all", F.lit(0))
    ranked = distributed_rank(whole, ["_all"], order, "_rank")
    return ranked.withColumn(name, F.floor((F.col("_rank") - 1) / size)).select(*df.columns, name)


def chunks_by_size(df: DataFrame, order: Sequence[Column], size: str, most: int, block: int | None = None, name: str = "chunk") -> DataFrame:
    """``df`` with the number of its chunk: in order, a new chunk begins where the sizes would exceed ``most``.

    ``order`` must end in a unique key. A row larger than ``most`` is a chunk of its own. Null and negative sizes count 0.
    With ``block`` a chunk also ends after each ``block`` rows.
    """
    return _chunks_in_blocks(df, order, size, most, block, name) if block else _chunks(df, order, size, most, name)


def _chunks(df: DataFrame, order: Sequence[Column], size: str, most: int, name: str) -> DataFrame:
    """The greedy chunks over range partitions.

    Where a chunk ends depends on all chunks before it, but a partition needs to know only how full the chunk is that is
    open at its start. For each row that could be its first chunk start (none lies behind the first ``most``) the
    partition tells how many chunks follow and how full the last is; these short tables are chained from partition to
    partition, and then each partition is numbered by itself.
    """
    piece, own = fresh(df, "_piece", "_size")
    sized = df.withColumn(own, F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("double"))
    placed = staged(sized.repartitionByRange(*order).withColumn(piece, F.spark_partition_id()), "chunked")
    sorted_by = lambda rows: rows.repartition(piece).sortWithinPartitions(piece, *order)

    def starts(at: int, sizes: np.ndarray) -> pd.DataFrame:
        upto = np.cumsum(sizes)
        before = upto - sizes
        after = np.maximum(np.searchsorted(upto, before + most, "right"), np.arange(len(sizes)) + 1)
        # row 0, and rows that add to the sum, up to the first where the sum alone exceeds a chunk
        j = np.arange(min(np.searchsorted(upto, most, "right") + 1, len(sizes)))
        j = j[(j == 0) | (sizes[j] > 0)]
        now, last, count = j.copy(), j.copy(), np.zeros(len(j), "int64")
        while (live := now < len(sizes)).any():
            last[live] = now[live]
            count[live] += 1
            now[live] = after[now[live]]
        return pd.DataFrame({"_piece": at, "_upto": upto[j], "_count": count, "_held": upto[-1] - before[last], "_total": upto[-1]})

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for batch in batches:
            pieces, sizes = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(pieces)) + 1), len(pieces)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if parts and pieces[a] != at:
                    yield pa.RecordBatch.from_pandas(starts(at, np.concatenate(parts)), preserve_index=False)
                    parts = []
                at = int(pieces[a])
                parts.append(sizes[a:b])
        if parts:
            yield pa.RecordBatch.from_pandas(starts(at, np.concatenate(parts)), preserve_index=False)

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        held, number, out = None, -1, []
        for at, own_rows in rows.sort_values(["_piece", "_upto"], kind="stable").groupby("_piece"):
            # the very first row opens chunk 0, as if a full chunk stood before it
            entry = float("inf") if held is None else held
            out.append((at, entry, number))
            later = own_rows[own_rows["_upto"] > most - entry]
            if len(later):
                number, held = number + int(later["_count"].iloc[0]), later["_held"].iloc[0]
            else:
                held = entry + own_rows["_total"].iloc[0]
        return pd.DataFrame(out, columns=["_at", "_entry", "_number"])

    made = sorted_by(placed.select(piece, own, *[F.col(f"`{c}`") for c in df.columns])).select(piece, own).mapInArrow(tables, "_piece long, _upto double, _count long, _held double, _total double")
    entries = staged(made.groupBy(F.lit(0).alias("_g")).applyInPandas(chain, "_at int, _entry double, _number long"), "entries")
    entered = sorted_by(placed.join(F.broadcast(entries), F.col(piece) == F.col("_at")))
    at = {c: entered.columns.index(c) for c in (piece, own, "_entry", "_number")}
    kept, columns = [entered.columns.index(c) for c in df.columns], [*df.columns, name]

    def number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, number = None, 0.0, 0
        for batch in batches:
            out = []
            for here, n, entry, first in zip(*[batch.column(at[c]).to_pylist() for c in (piece, own, "_entry", "_number")], strict=True):
                if here != current:
                    current, held, number = here, entry, first
                if held + n > most:
                    number, held = number + 1, 0.0
                held += n
                out.append(number)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(out, pa.int64())], names=columns)

    fields = StructType([*df.schema.fields, StructField(name, LongType())])
    return entered.mapInArrow(number_rows, fields)


def _chunks_in_blocks(df: DataFrame, order: Sequence[Column], size: str, most: int, block: int, name: str) -> DataFrame:
    """The greedy chunks of each block of rows, numbered on from block to block."""
    whole = df.withColumn("_all", F.lit(0))
    ranked = distributed_rank(whole, ["_all"], order, "_rank").withColumn("_block", F.floor((F.col("_rank") - 1) / block)).drop("_all")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_rank")
        number, held, out = 0, 0, []
        for i, n in enumerate(rows[size].fillna(0)):
            if i and held + n > most:
                number, held = number + 1, 0
            held += n
            out.append(number)
        return rows.assign(_number=out)

    packed = ranked.groupBy("_block").applyInPandas(pack, f"{fields}, _number long")
    # numbers in a block become numbers overall by the chunks of the blocks before
    per_block = packed.groupBy("_block").agg((F.max("_number") + 1).alias("_n")).withColumn("_all", F.lit(0))
    before = distributed_running_sum(per_block, ["_all"], [F.col("_block").asc()], F.col("_n"), "_upto")
    before = before.select(F.col("_block").alias("_b"), (F.col("_upto") - F.col("_n")).alias("_before"))
    joined = packed.join(before, F.col("_block") == F.col("_b"))
    return joined.select(*df.columns, (F.col("_number") + F.col("_before")).alias(name))


def capped_per_key(df: DataFrame, key: Column, order: Sequence[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows for each key, the first in order; rows with a null key are one group."""
    return top_n_per_group(df.withColumn("_key", key), ["_key"], order, cap).drop("_key")


def greedy_pick(df: DataFrame, order: Sequence[Column], n: int, category: str, caps: dict[str, int], priority: Sequence[str]) -> DataFrame:
    """Up to ``n`` rows: one of each priority category, then in order, under joint caps. ``order`` must end in a unique key.

    ``caps`` maps a column to how many picked rows may have the same value there; nulls are one value. Rows alike in all
    capped columns are taken or refused alike, so only the first of each such group, and of each such group and category,
    can be picked. Each pick depends on the ones before: these rows are read in order by one task that holds the picks
    only and stops at the last one. Result has ``pick``, its 1-based position.
    """
    keys = list(caps)
    most = max(min([n, *caps.values()]), 0)
    first = top_n_per_group(df, keys, order, most)
    wanted = df.filter(F.col(category).isin(list(priority)))
    leading = top_n_per_group(wanted, [*keys, category], order, max([0, *Counter(priority).values()]))
    turn, pos = fresh(df, "_turn", "_pos")
    pool = staged(first.unionByName(leading).distinct().withColumn(pos, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))), "pool")
    turns = F.array(*[F.when(F.col(category) == v, F.lit(i)) for i, v in enumerate(priority)], F.lit(len(priority)))
    read = pool.select(pos, F.explode(F.array_compact(turns)).alias(turn), *[F.col(c).cast("string").alias(f"_cap{i}") for i, c in enumerate(keys)])
    limits = [caps[c] for c in keys]

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        used: Counter[tuple] = Counter()
        picked: dict[int, int] = {}
        served: set[int] = set()
        for batch in batches:
            for at, now, *values in batch.itertuples(index=False, name=None):
                own = [(i, None if pd.isna(v) else v) for i, v in enumerate(values)]
                if len(picked) < n and at not in picked and now not in served and all(used[k] < limits[k[0]] for k in own):
                    used.update(own)
                    picked[at] = len(picked) + 1
                    if now < len(priority):
                        served.add(now)
            if len(picked) >= n:
                break
        yield pd.DataFrame(list(picked.items()), columns=["_at", "pick"])

    picks = read.repartition(1).sortWithinPartitions(turn, pos).mapInPandas(choose, "_at int, pick int")
    return pool.join(F.broadcast(picks), F.col(pos) == F.col("_at")).select(*[pool[c] for c in df.columns], "pick")


def rebalanced(df: DataFrame, bucket: str, priority: Sequence[str], caps: dict[str, int], order: Sequence[Column], n: int) -> DataFrame:
    """Up to ``n`` rows: the best of each priority bucket, then the rest in order under the buckets' caps, then what the
    caps left over. ``place`` numbers the result from 1. ``order`` must end in a unique key.
    """
    best = top_n_per_group(df, [bucket], order, max([n, *caps.values()]))
    w = Window.partitionBy(bucket).orderBy(*order)
    at = best.withColumn("_r", F.row_number().over(w))
    rank = F.create_map(*[F.lit(x) for i, b in enumerate(priority) for x in (b, i)])
    capped = F.lit(False)
    for b, cap in caps.items():
        capped = capped | ((F.col(bucket) == b) & (F.col("_r") > cap))
    segment = F.when(F.col(bucket).isin(list(priority)) & (F.col("_r") == 1), 0).when(capped, 2).otherwise(1)
    lead = F.when(segment == 0, rank[F.col(bucket)]).otherwise(0)
    picked = at.withColumns({"_segment": segment, "_lead": lead}).orderBy("_segment", "_lead", *order).limit(n)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_segment", "_lead", *order))
    return picked.withColumn("place", place).select(*df.columns, "place")
