"""Problem 4: at most so many records for each contributor.

Method: suitor b-matching. A record proposes to all its contributors; each contributor holds its strongest proposals up
to its capacity; a record pushed out anywhere is withdrawn everywhere and frees its places. Run to its fixed point this
equals going through the records from the strongest to the weakest and keeping each whose contributors all have room.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.ranking import distributed_rank
from tidewire.runtime import broadcast_if_small, staged


#: At most so many proposals are settled in one task, in order: some 20 MB.
TAIL_ROWS = 200_000


def capacity(docs: DataFrame, id_col: str, share: float) -> int:
    """floor(share of all different ids); null ids are not counted."""
    n = docs.select(F.countDistinct(id_col)).first()[0]
    return int(n * round(share * 1_000_000)) // 1_000_000


def _settled_in_order(open_: DataFrame, used: DataFrame | None, cap: int) -> DataFrame:
    """(record, kept) of a bounded remainder, from the strongest record to the weakest in one task."""
    free = F.lit(cap).cast("long")
    if used is not None:
        open_ = open_.join(used, "contributor", "left")
        free = free - F.coalesce("held", F.lit(0))
    rows = open_.select("record", "contributor", "score", free.alias("free")).repartition(1).sortWithinPartitions(F.col("score").desc_nulls_last(), F.col("record").asc())

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        room: dict[str, int] = {}
        lines = ((r, c, f) for b in batches for r, c, f in zip(b["record"], b["contributor"], b["free"], strict=True))
        out: list[tuple] = []
        for record, own in groupby(lines, key=itemgetter(0)):  # a record has one score, so its rows stand together
            names = []
            for _, name, free_ in own:
                room.setdefault(name, free_)
                names.append(name)
            kept = all(room[n] > 0 for n in names)
            for n in names:
                room[n] -= kept
            out.append((record, kept))
        yield pd.DataFrame(out, columns=["record", "kept"])

    return rows.mapInPandas(settle, f"record {dict(open_.dtypes)['record']}, kept boolean")


def suitor_matching(proposals: DataFrame, cap: int, tail: int = TAIL_ROWS) -> DataFrame:
    """Match (record, contributor, score) proposals; returns (record, kept) for every record.

    Strength is the higher score, null scores last, ties by the smaller record id. In each round every undecided record
    stands in the line of each of its contributors. One that is within the free capacity in all its lines is held for
    good, because all the stronger ones before it could at most fill the places it does not need; one that meets a
    contributor without free capacity is displaced for good, and its places in other lines go to weaker ones. Records with
    one contributor are settled in the first round. The strongest undecided record is decided in every round, so the loop
    ends; chains of records that wait for each other shorten fast where strengths are mixed. As soon as at most ``tail``
    proposals are left they are settled in order in one task, so a long chain costs no round for each of its links.

    Ranks come from range partitions, so a contributor with a third of all rows never meets in one task. Repeated
    (record, contributor) rows count once; a record's score is its largest. Proposals with a null contributor are
    ignored, and a record that has only such proposals does not appear.
    """
    lists = proposals.filter(F.col("contributor").isNotNull() & F.col("record").isNotNull()).groupBy("record").agg(F.collect_set("contributor").alias("names"), F.max("score").alias("score"))
    open_ = staged(lists.select("record", F.explode("names").alias("contributor"), "score"), "proposals")
    decided: DataFrame | None = None
    used: DataFrame | None = None
    order: list[Column] = [F.col("score").desc_nulls_last(), F.col("record").asc()]
    while True:
        ranked = distributed_rank(open_, ["contributor"], order, "place")
        if used is not None:
            ranked = ranked.join(broadcast_if_small(used, 96), "contributor", "left")
        else:
            ranked = ranked.withColumn("held", F.lit(0).cast("long"))
        free = F.lit(cap) - F.coalesce("held", F.lit(0))
        verdict = ranked.groupBy("record").agg(
            F.min((F.col("place") <= free).cast("int")).alias("fits"),
            F.max((free <= 0).cast("int")).alias("shut"),
            F.count(F.lit(1)).alias("lines"),
        )
        verdict = staged(verdict.withColumn("kept", F.when(F.col("fits") == 1, True).when(F.col("shut") == 1, False)), "verdict")
        # where every record left stands in one line only, its place is final: what stands before it stays there
        single_only = verdict.filter("lines > 1").isEmpty()
        if single_only:
            settled = verdict.select("record", F.coalesce("kept", F.lit(False)).alias("kept"))
        else:
            settled = verdict.filter(F.col("kept").isNotNull()).select("record", "kept")
        decided = settled if decided is None else decided.unionByName(settled)
        if single_only:
            return decided
        left = open_.join(settled, "record", "left_anti")
        held = open_.join(settled.filter("kept"), "record", "left_semi").groupBy("contributor").agg(F.count(F.lit(1)).alias("held"))
        if used is not None:
            held = held.unionByName(used).groupBy("contributor").agg(F.sum("held").alias("held"))
        used, open_ = staged(held, "held"), staged(left, "proposals")
        if open_.limit(tail + 1).count() <= tail:
            return decided.unionByName(_settled_in_order(open_, used, cap))


def capped(docs: DataFrame, id_col: str = "id", contributors: str = "source_id", score_col: str = "quality_score", share: float = 0.02) -> DataFrame:
    """(id, kept) for every record with a contributor; ``contributors`` is a string or an array of strings.

    Empty or blank contributors count as none. An empty table gives no rows.
    """
    names = F.col(contributors) if dict(docs.dtypes)[contributors].startswith("array") else F.array(contributors)
    proposals = docs.select(F.col(id_col).alias("record"), F.explode(names).alias("contributor"), F.col(score_col).cast("double").alias("score"))
    proposals = proposals.filter(F.trim("contributor") != "")
    return suitor_matching(proposals, capacity(docs, id_col, share)).withColumnRenamed("record", "id")
