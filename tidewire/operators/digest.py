"""Ranked merges, pools, supplements and quotas, as digests and publications are put together from many partial results.

Every operator ranks inside bounded or group-limited windows: what is kept of a group is limited before it is gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.ranking import top_n_per_group
from tidewire.runtime import fresh


def merged_topics(df: DataFrame, cluster: str, order: Sequence[Column], url: str, tier: str, most_urls: int = 3) -> DataFrame:
    """One row for each cluster: its first row in ``order``, the first different URLs of all its rows, and its best tier.

    ``order`` must end in a unique key. Each URL is first reduced to its first place in the cluster, so a cluster of any
    size sends one row a URL and gathers ``most_urls`` of them. Rows with a null cluster are clusters of their own.
    """
    key, place = fresh(df, "_key", "_place")
    rows = df.withColumn(key, F.coalesce(F.col(cluster).cast("string"), F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))))
    first = top_n_per_group(rows, [key], order, 1)
    best = rows.groupBy(key).agg(F.min(tier).alias("best_tier"), F.count(F.lit(1)).alias("members"))
    own = top_n_per_group(rows.filter(F.col(url).isNotNull()), [key, url], order, 1)
    ranked = own.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col(place) <= most_urls)
    urls = ranked.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(place, F.col(url).alias("u")))), lambda x: x["u"]).alias("urls"))
    joined = first.join(best, key).join(urls, key, "left")
    return joined.select(*[c for c in df.columns if c not in (tier, url)], F.col("best_tier").alias(tier), "members", F.coalesce("urls", F.array().cast("array<string>")).alias("urls"))


def candidate_pools(df: DataFrame, group: str, headline: str, order: Sequence[Column], most: int = 48, key_chars: int = 120) -> DataFrame:
    """The first ``most`` rows of each group, one for each headline, with ``rank`` and ``pool``, the group's headlines before the cut.

    Headlines are the same when their first ``key_chars`` characters are, letter case aside. Null headlines count as one.
    """
    key, n = fresh(df, "_headline", "_n")
    rows = df.withColumn(key, F.substring(F.lower(F.trim(F.coalesce(F.col(headline), F.lit("")))), 1, key_chars))
    once = top_n_per_group(rows, [group, key], order, 1)
    sizes = rows.groupBy(F.col(group).alias(n)).agg(F.count_distinct(key).alias("pool"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= most)
    return ranked.join(sizes, F.col(group).eqNullSafe(F.col(n))).select(*df.columns, "rank", "pool")


def supplemented(picks: DataFrame, pool: DataFrame, key: str, group: str, target: Mapping[str, int] | int, order: Sequence[Column]) -> DataFrame:
    """``picks`` and, for each group below its target, the first rows of ``pool`` whose key no pick has, up to the target.

    ``origin`` tells picks (0) from supplements (1). Both frames have the same columns; groups that ``target`` does not
    name get nothing. A key that the pool holds twice is used once. Null keys are never supplements.
    """
    have = picks.groupBy(group).agg(F.count(F.lit(1)).alias("_have"))
    if isinstance(target, int):
        goal = F.lit(target)
    else:
        goals = F.create_map(*[F.lit(x) for kv in target.items() for x in kv]) if target else F.create_map().cast("map<string,int>")
        goal = F.coalesce(F.try_element_at(goals, F.col(group)), F.lit(0))
    unseen = pool.filter(F.col(key).isNotNull()).join(picks.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")
    once = top_n_per_group(unseen, [key], order, 1)
    need = once.join(have, group, "left").withColumn("_need", goal - F.coalesce("_have", F.lit(0)))
    ranked = need.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_r") <= F.col("_need"))
    return picks.withColumn("origin", F.lit(0)).unionByName(ranked.select(*picks.columns).withColumn("origin", F.lit(1)))


def one_per_cluster(levels: Sequence[DataFrame], cluster: str, rank: str, caps: Sequence[int]) -> DataFrame:
    """The levels' rows with ``level`` from 0: of a cluster only its first row by level and rank, then so many rows a level.

    Null clusters are no cluster and all stay in line; ``rank`` is unique inside a level.
    """
    both: DataFrame | None = None
    for n, df in enumerate(levels):
        own = df.withColumn("level", F.lit(n))
        both = own if both is None else both.unionByName(own)
    first = top_n_per_group(both.filter(F.col(cluster).isNotNull()), [cluster], [F.col("level").asc(), F.col(rank).asc()], 1)
    kept = first.unionByName(both.filter(F.col(cluster).isNull()))
    place = F.row_number().over(Window.partitionBy("level").orderBy(F.col(rank).asc()))
    cap = F.get(F.array(*[F.lit(c) for c in caps]), F.col("level"))
    return kept.withColumn("_r", place).filter(F.col("_r") <= cap).drop("_r")


def quota_links(df: DataFrame, group: str, host: Column, order: Sequence[Column], cap: int, per_host: int = 2, pool: int = 4) -> DataFrame:
    """Up to ``cap`` rows of each group with ``place``: of its first ``cap`` * ``pool`` rows in order, at most ``per_host`` of a host."""
    h, r = fresh(df, "_host", "_r")
    first = top_n_per_group(df, [group], order, cap * pool).withColumn(h, host)
    spread = top_n_per_group(first, [group, h], order, per_host)
    return spread.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("place") <= cap).drop(h, r)


def topics_in_order(df: DataFrame, topic: str, topics: Sequence[str], order: Sequence[Column], per_topic: int = 2, most_topics: int = 8) -> DataFrame:
    """Rows of the first ``most_topics`` of the listed topics that have any, ``per_topic`` each, with ``topic_rank`` from 1.

    Rows of other topics are left out; topics without rows take no rank.
    """
    at = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col(topic))
    held = top_n_per_group(df.filter(F.col(topic).isin(list(topics))), [topic], order, per_topic)
    # at most topics x per_topic rows are left, so the ranking window is bounded
    return held.withColumn("topic_rank", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(at))).filter(F.col("topic_rank") <= most_topics)


def signal_clusters(df: DataFrame, entity: str, score: str, order: Sequence[Column], url: str, label: str, links: int = 6, most: int = 10) -> DataFrame:
    """The ``most`` entities of the highest leads: lead row, members, mix of labels as 'label:n, ...', first different links.

    ``order`` must end in a unique key and begins with the score; entities tie by name. Null entities and labels count nowhere.
    """
    rows = df.filter(F.col(entity).isNotNull())
    lead = top_n_per_group(rows, [entity], order, 1)
    top = lead.orderBy(*order[:1], F.col(entity)).limit(most)
    own = rows.join(F.broadcast(top.select(entity)), entity, "left_semi")
    counts = own.filter(F.col(label).isNotNull()).groupBy(entity, label).agg(F.count(F.lit(1)).alias("n"))
    mix = counts.groupBy(entity).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(label).alias("l")))), lambda x: F.concat(x["l"], F.lit(":"), (-x["k"]).cast("string"))), ", ").alias("mix")
    )
    first = top_n_per_group(own.filter(F.col(url).isNotNull()), [entity, url], order, 1)
    placed = first.withColumn("_p", F.row_number().over(Window.partitionBy(entity).orderBy(*order))).filter(F.col("_p") <= links)
    held = placed.groupBy(entity).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", F.col(url).alias("u")))), lambda x: x["u"]).alias("links"))
    sizes = own.groupBy(entity).agg(F.count(F.lit(1)).alias("members"))
    return top.join(sizes, entity).join(mix, entity, "left").join(held, entity, "left")


def watch_status(watched: DataFrame, hits: DataFrame, entity: str, link: str, order: Sequence[Column], links: int = 5) -> DataFrame:
    """(entity, hits, links) for every watched entity, those without a hit too; links in order, repeats counted once."""
    counts = hits.groupBy(entity).agg(F.count(F.lit(1)).alias("hits"))
    first = top_n_per_group(hits.filter(F.col(link).isNotNull()), [entity, link], order, 1)
    placed = first.withColumn("_p", F.row_number().over(Window.partitionBy(entity).orderBy(*order))).filter(F.col("_p") <= links)
    held = placed.groupBy(entity).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", F.col(link).alias("u")))), lambda x: x["u"]).alias("links"))
    out = watched.select(entity).distinct().join(counts, entity, "left").join(held, entity, "left")
    return out.select(entity, F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("links", F.array().cast("array<string>")).alias("links"))


def shares(df: DataFrame, flags: Mapping[str, Column], digits: int = 4) -> DataFrame:
    """One row: the number of rows and, for each flag, its count and its share rounded; null flags are false, no rows give 0."""
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in flags.items()]
    out = df.agg(*aggs)
    part = lambda name: F.when(F.col("total") > 0, F.round(F.col(name) / F.col("total"), digits)).otherwise(0.0)
    return out.select("total", *[c for name in flags for c in (F.col(name), part(name).alias(f"{name}_share"))])


def merged_excerpts(df: DataFrame, key: str, text: str, order: Sequence[Column], sources: int = 5, most: int = 600, least: int = 30, sep: str = " ") -> DataFrame:
    """(key, excerpt, used): the first usable texts of each key joined until ``most`` characters would be passed.

    A text is usable with at least ``least`` characters after trimming; ``sources`` of them are looked at. One that does not
    fit any more ends the excerpt, but the first is cut to fit. Keys without a usable text give no row.
    """
    good = df.withColumn("_t", F.trim(F.col(text))).filter(F.length("_t") >= least)
    first = top_n_per_group(good, [key], order, sources)
    placed = first.withColumn("_p", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    held = placed.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_t"))), lambda x: x["_t"]).alias("_all"))
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"), F.lit(False).alias("full"))

    def add(acc: Column, t: Column) -> Column:
        fits = (acc["n"] == 0) | (F.length(acc["s"]) + len(sep) + F.length(t) <= most)
        put = F.when(acc["n"] == 0, F.substring(t, 1, most)).otherwise(F.concat(acc["s"], F.lit(sep), t))
        ok = ~acc["full"] & fits
        return F.struct(F.when(ok, put).otherwise(acc["s"]).alias("s"), F.when(ok, acc["n"] + 1).otherwise(acc["n"]).alias("n"), (~ok).alias("full"))

    return held.select(key, F.aggregate("_all", start, add).alias("r")).select(key, F.col("r.s").alias("excerpt"), F.col("r.n").alias("used"))


def uncopied(bullets: Column, summary: Column, head: int = 80, least: int = 40) -> Column:
    """The bullets that the summary does not hold: neither equal to it nor, from ``least`` characters on, with their first ``head`` in it."""
    base = F.lower(F.trim(F.coalesce(summary, F.lit(""))))

    def stays(b: Column) -> Column:
        low = F.lower(F.trim(b))
        return (low != base) & ~((F.length(low) >= least) & base.contains(F.substring(low, 1, head)))

    return F.filter(bullets, lambda b: F.coalesce(stays(b), F.lit(False)))


def alike_texts(a: Column, b: Column, contained: int = 24, overlap: float = 0.82) -> Column:
    """Whether two texts say the same: equal, one with ``contained`` characters inside the other, or most words of the smaller in common."""
    x, y = F.lower(F.trim(F.coalesce(a, F.lit("")))), F.lower(F.trim(F.coalesce(b, F.lit(""))))
    inside = ((F.length(x) >= contained) & y.contains(x)) | ((F.length(y) >= contained) & x.contains(y))
    words = lambda t: F.array_distinct(F.filter(F.split(t, r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    small = F.least(F.size(words(x)), F.size(words(y)))
    return (x != "") & (y != "") & ((x == y) | inside | ((small > 0) & (F.size(F.array_intersect(words(x), words(y))) >= overlap * small)))


def link_packs(items: DataFrame, item: str, order: Sequence[Column], url: str, per_item: int = 2, most_items: int = 12, most_urls: int = 25) -> DataFrame:
    """(item, url, place) of the first items with links: so many links an item, each URL once at its first place, a cap over all.

    ``order`` ends in a unique key and gives both the order of items, by their first row, and of links. Items without a link
    take no place. What is left after the two limits is at most ``most_items`` x ``per_item`` rows.
    """
    rows = items.filter(F.col(url).isNotNull() & (F.trim(url) != "") & F.col(item).isNotNull())
    lead = top_n_per_group(rows, [item], order, 1).orderBy(*order).limit(most_items)
    own = rows.join(F.broadcast(lead.select(item)), item, "left_semi")
    links = top_n_per_group(top_n_per_group(own, [item, url], order, 1), [item], order, per_item)
    once = top_n_per_group(links, [url], order, 1)
    return once.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))).filter(F.col("place") <= most_urls).select(item, url, "place")


def partial_counts(partials: DataFrame, sectors: str, code: str, topics: str) -> DataFrame:
    """(code, topics, partials): over stored partial results with nested sectors, how many topics each sector has in how many.

    ``sectors`` is an array of structs that hold the sector's ``code`` and the array ``topics``; null arrays count as empty.
    """
    rows = partials.select(F.explode(sectors).alias("s")).select(F.col(f"s.{code}").alias(code), F.greatest(F.lit(0), F.coalesce(F.size(F.col(f"s.{topics}")), F.lit(0))).alias("n"))
    return rows.groupBy(code).agg(F.sum("n").cast("long").alias("topics"), F.count_if(F.col("n") > 0).alias("partials"))


def tidied(df: DataFrame, sector: str, soft: Column, reroutes: Sequence[tuple[Column, str]], headline: str, order: Sequence[Column], most: int = 25) -> DataFrame:
    """Topics without the soft ones, sent to the sector of the first reroute that fits, one a headline, the first ``most`` of each sector."""
    kept = df.filter(~F.coalesce(soft, F.lit(False)))
    to: Column | None = None
    for condition, name in reroutes:
        to = F.when(condition, name) if to is None else to.when(condition, name)
    moved = kept if to is None else kept.withColumn(sector, to.otherwise(F.col(sector)))
    return candidate_pools(moved, sector, headline, order, most).drop("pool")


def filtered_unless_empty(df: DataFrame, bad: Column) -> DataFrame:
    """Rows that are not bad, or all rows where nothing would be left; the test is one aggregated row, so the plan stays lazy."""
    good = ~F.coalesce(bad, F.lit(False))
    none = df.agg((F.count_if(good) == 0).alias("_none"))
    return df.join(F.broadcast(none)).filter(good | F.col("_none")).drop("_none")


def token_budget(limit: int, prompt: Column, output: Column, per_minute: int | None = None, reserve: int = 0) -> Column:
    """The tokens left for input: the window less prompt, output and reserve, no more than a minute allows, never below 0."""
    left = F.lit(limit) - F.coalesce(prompt, F.lit(0)) - F.coalesce(output, F.lit(0)) - reserve
    return F.greatest(F.lit(0), left if per_minute is None else F.least(left, F.lit(per_minute)))
