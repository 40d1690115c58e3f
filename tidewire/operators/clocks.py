"""Problem 5: one unambiguous instant for each record, whatever form, precision and zone its time was written in.

Method: where a time names no zone, the zone is estimated. A record cannot have been published after it was taken in,
so for each source and each candidate history of offsets (a zone of the time zone database) the local times are
converted and set against the ingestion times. A lag violates the usual order the more, the rarer it is among records
that name their zone; the history with the least violation wins. A declared clock is taken as the known history.
"""

from __future__ import annotations

import datetime as dt
import math
import zoneinfo
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.instants import at_clock, written_time
from tidewire.runtime import broadcast_if_small, staged

#: Lags are priced in buckets of a quarter of an hour, from two hours before ingestion to two days after publication.
BUCKET = 900_000_000
FIRST_BUCKET, LAST_BUCKET = -8, 192
WIDE = 1000


def candidate_zones(first_year: int, last_year: int) -> list[str]:
    """One zone of the time zone database for each history of offsets within the years, whichever name sorts first.

    Histories are compared on every tenth day; names of fixed offsets and of single words, UTC aside, are left out.
    """
    days = [dt.datetime(first_year, 1, 1, 12, tzinfo=dt.UTC) + dt.timedelta(days=n) for n in range(0, 366 * (last_year - first_year + 1), 10)]
    out: dict[tuple, str] = {}
    names = [z for z in zoneinfo.available_timezones() if z == "UTC" or ("/" in z and not z.startswith(("Etc/", "SystemV/", "Antarctica/", "Arctic/")))]
    for name in sorted(names, key=lambda z: (z != "UTC", z)):
        zone = zoneinfo.ZoneInfo(name)
        out.setdefault(tuple(d.astimezone(zone).utcoffset() for d in days), name)
    return sorted(out.values())


def _ingested(c: Column) -> Column:
    return F.unix_micros(F.to_timestamp(F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z"))))


def _bucket(lag: Column) -> Column:
    return F.least(F.greatest(F.floor(lag / BUCKET), F.lit(FIRST_BUCKET)), F.lit(LAST_BUCKET)).cast("int")


def violation_costs(lags: DataFrame) -> dict[tuple[str, int], float]:
    """What a lag costs, by lane and bucket: the less often zoned records show it, the more; ``lags`` has (lane, lag).

    Publication after ingestion is the rarest and so the dearest. Lanes without zoned records are priced by all lanes
    together, under the lane ''. The result has at most as many entries as lanes and buckets.
    """
    counts = lags.filter(F.col("lag").isNotNull()).groupBy("lane", _bucket(F.col("lag")).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    by_lane: dict[str, dict[int, int]] = {"": {}}
    for r in counts:
        for lane in {r.lane, ""}:
            own = by_lane.setdefault(lane, {})
            own[r.b] = own.get(r.b, 0) + r.n
    out: dict[tuple[str, int], float] = {}
    # the outermost buckets hold all that lies beyond; spread over WIDE buckets each, as dense as the others
    wide = {FIRST_BUCKET: WIDE, LAST_BUCKET: WIDE}
    for lane, seen in by_lane.items():
        total = sum(seen.values()) + LAST_BUCKET - FIRST_BUCKET + 1
        for b in range(FIRST_BUCKET, LAST_BUCKET + 1):
            if not seen:  # nothing to learn from: one unit for each time after ingestion
                out[lane, b] = 1.0 if b < 0 else 0.001 * b
            else:
                out[lane, b] = -math.log((seen.get(b, 0) + 1) / total / wide.get(b, 1))
    return out


def estimated_zones(records: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """(source_id, zone_name, violations, records) by alignment, for rows (source_id, t, seen) and perhaps (lane).

    ``t`` is a time of written_time, ``seen`` the ingestion instant in microseconds. Records that name their zone show
    which lags are usual in their lane, the way they were taken in; for the others each candidate's lags are priced by
    that. The sums are aggregated on each task before they move, so a source with a third of all rows costs one row per
    task and candidate. Rows without source or ingestion time take no part; violations counts times after ingestion; ties
    go to the zone name that sorts first.
    """
    if "lane" not in records.columns:
        records = records.withColumn("lane", F.lit(""))
    lanes = records.select("lane", (F.col("seen") - F.col("t.micros")).alias("lag"))
    costs = violation_costs(lanes.withColumn("lane", F.coalesce("lane", F.lit(""))))
    by_lane = {lane: F.array(*[F.lit(costs[lane, b]) for b in range(FIRST_BUCKET, LAST_BUCKET + 1)]) for lane in {k for k, _ in costs}}
    known = sorted(by_lane.keys() - {""})
    prices = by_lane[""]
    for lane in known:
        prices = F.when(F.col("lane") == lane, by_lane[lane]).otherwise(prices)
    tried = records.filter(F.col("source_id").isNotNull() & F.col("t.year").isNotNull() & F.col("seen").isNotNull())
    tried = tried.select("source_id", "t", "seen", "lane", F.explode(F.array(*[F.lit(z) for z in sorted(candidates)])).alias("zone_name"))
    sums = (
        tried.withColumn("lag", F.col("seen") - at_clock(F.col("t"), F.col("zone_name")))
        .filter(F.col("lag").isNotNull())
        .groupBy("source_id", "zone_name")
        .agg(F.count_if(F.col("lag") < 0).alias("violations"), F.sum(F.get(prices, _bucket(F.col("lag")) - FIRST_BUCKET)).alias("cost"), F.count(F.lit(1)).alias("records"))
    )
    sums = staged(sums, "zone_costs")
    habits = _habits(sums, candidates)
    habit = F.get(F.array(*[F.lit(habits[z]) for z in sorted(candidates)]), F.array_position(F.array(*[F.lit(z) for z in sorted(candidates)]), F.col("zone_name")).cast("int") - 1)
    best = Window.partitionBy("source_id").orderBy(F.round(F.col("cost") + habit, 6), "zone_name")
    return sums.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select("source_id", "zone_name", "violations", "records")


def _habits(sums: DataFrame, candidates: Sequence[str], rounds: int = 12) -> dict[str, float]:
    """What each candidate costs for being rare among all sources: the negative log of its share, fitted with them in turns.

    A source with few records thus goes to a clock that others are seen to keep. Each round brings one number for each
    candidate back; a share is never taken for less than a tenth of an equal one.
    """
    share = {z: 1 / len(candidates) for z in candidates}
    own = Window.partitionBy("source_id")
    names = sorted(candidates)
    for _ in range(rounds):
        logs = F.get(F.array(*[F.lit(math.log(share[z])) for z in names]), F.array_position(F.array(*[F.lit(z) for z in names]), F.col("zone_name")).cast("int") - 1)
        fit = sums.withColumn("fit", logs - F.col("cost"))
        odds = fit.withColumn("odds", F.exp(F.col("fit") - F.max("fit").over(own)))
        parts = odds.withColumn("part", F.col("odds") / F.sum("odds").over(own)).groupBy("zone_name").agg(F.sum("part").alias("n")).collect()
        total = sum(r.n for r in parts)
        if not total:
            break
        found = {r.zone_name: r.n / total for r in parts}
        share = {z: max(found.get(z, 0.0), 0.1 / len(candidates)) for z in candidates}
    return {z: -math.log(x) for z, x in share.items()}


def agreement(records: DataFrame, zones: DataFrame) -> DataFrame:
    """(source_id, agreeing, compared): of the records without a zone, how many instants the zones of ``zones`` give alike.

    ``records`` has (source_id, t), ``zones`` (source_id, zone_name, declared_zone), one row a source.
    """
    open_ = records.filter(F.col("t.year").isNotNull()).join(broadcast_if_small(zones, 120), "source_id")
    same = at_clock(F.col("t"), F.col("zone_name")) == at_clock(F.col("t"), F.col("declared_zone"))
    return open_.groupBy("source_id").agg(F.count_if(same).alias("agreeing"), F.count_if(same.isNotNull()).alias("compared"))


def written(records: DataFrame, clocks: DataFrame, time_col: str, seen_col: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., source_id, t, seen, zone_name) for each record, with the declared clock of its source.

    A null, empty or blank source is null. A source that two clock rows declare takes the smaller pair.
    """
    known = clocks.filter(F.col("source_id").isNotNull()).groupBy("source_id").agg(F.min(F.struct("zone_name", "date_order")).alias("c"))
    known = broadcast_if_small(known.select(F.col("source_id").alias("_s"), "c.zone_name", "c.date_order"), 160)
    rows = records.select(
        *keep,
        F.when(F.trim("source_id") != "", F.col("source_id")).alias("source_id"),
        F.col(time_col).alias("_text"),
        (_ingested(F.col(seen_col)) if seen_col else F.lit(None).cast("long")).alias("seen"),
    )
    joined = rows.join(known, F.col("source_id") == F.col("_s"), "left")
    return joined.select(*keep, "source_id", written_time(F.col("_text"), F.col("date_order")).alias("t"), "seen", "zone_name")


def instants(parts: DataFrame, candidates: Sequence[str], keep: Sequence[str], lane: str | None = None) -> DataFrame:
    """(keep..., utc_micros) of the rows of ``written`` that name an instant; one row per different key and instant.

    Sources whose clock is not declared get the estimated one; where there are none such, nothing is estimated.
    """
    parts = staged(parts, "written_times")
    unknown = F.col("zone_name").isNull() & F.col("source_id").isNotNull() & F.col("t.year").isNotNull()
    zone = F.when(F.col("source_id").isNotNull(), F.col("zone_name"))
    if not parts.filter(unknown).isEmpty():
        guessed = estimated_zones(parts.filter(unknown | F.col("t.micros").isNotNull()).select("source_id", "t", "seen", (F.col(lane) if lane else F.lit("")).alias("lane")), candidates)
        guessed = broadcast_if_small(staged(guessed.select(F.col("source_id").alias("_g"), F.col("zone_name").alias("_guess")), "zones"), 120)
        parts = parts.join(guessed, F.col("source_id") == F.col("_g"), "left")
        zone = F.when(F.col("source_id").isNotNull(), F.coalesce("zone_name", "_guess"))
    rows = parts.select(*keep, F.coalesce("t.micros", at_clock(F.col("t"), zone)).alias("utc_micros"))
    return rows.filter(F.col("utc_micros").isNotNull()).distinct()
