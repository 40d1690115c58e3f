"""Choosing what to crawl next, by rows of stored feeds, sitemaps, links, profiles and registries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.rules import first_label
from tidewire.operators.ranking import top_n_per_group
from tidewire.runtime import staged


def feed_frontier(entries: DataFrame, source: str, url: str, when: Column, on_day: Column, budget: int | Column) -> DataFrame:
    """Up to ``budget`` on-day entries of each source over all its feeds, newest first, those without a time last.

    An entry that several feeds hold counts once, at its newest time; ties go by URL. ``when`` becomes ``entry_time``.
    """
    rows = entries.filter(F.coalesce(on_day, F.lit(False)) & F.col(url).isNotNull()).groupBy(source, url).agg(F.max(when).alias("entry_time"))
    return top_n_per_group(rows, [source], [F.col("entry_time").desc_nulls_last(), F.col(url).asc()], budget)


def fallback_sources(sources: DataFrame, frontier: DataFrame, source: str) -> DataFrame:
    """Sources without any row in the frontier, which are to be read from their homepage."""
    return sources.filter(F.col(source).isNotNull()).join(frontier.select(source).distinct(), source, "left_anti")


def sitemap_frontier(entries: DataFrame, source: str, loc: str, lastmod: str, priority: Column, recent: Column, same_host: Column, budget: int) -> DataFrame:
    """Up to ``budget`` entries of each source by priority, then newest; undated ones whose URL looks recent come first.

    Entries of other hosts are left out, repeats count once with their newest time; ties go by URL. ``place`` is the rank.
    """
    rows = entries.filter(F.coalesce(same_host, F.lit(False))).groupBy(source, loc).agg(F.max(lastmod).alias(lastmod))
    rank = F.when(F.col(lastmod).isNull() & recent, 2).when(F.col(lastmod).isNotNull(), 1).otherwise(0)
    order = [priority.asc(), rank.desc(), F.col(lastmod).desc_nulls_last(), F.col(loc).asc()]
    first = top_n_per_group(rows, [source], order, budget)
    return first.withColumn("place", F.row_number().over(Window.partitionBy(source).orderBy(*order)))


def hops(seeds: DataFrame, links: DataFrame, node: str, source: str, target: str, depth: int, admitted: Column | None = None) -> DataFrame:
    """(node, depth) of what is reached from the seeds in up to ``depth`` steps over the links, with the fewest steps.

    Breadth first, one join a step, each step's new nodes written so that lineage does not grow; ``admitted`` is a test
    on the link rows. Nodes seen before are dropped by an anti join, so cycles end.
    """
    own = links if admitted is None else links.filter(admitted)
    own = own.select(F.col(source).alias("_from"), F.col(target).alias("_to")).filter(F.col("_from").isNotNull() & F.col("_to").isNotNull())
    front = staged(seeds.select(F.col(node).alias("_n")).filter(F.col("_n").isNotNull()).distinct(), "hop")
    seen = front.withColumn("depth", F.lit(0))
    for step in range(1, depth + 1):
        found = own.join(front, F.col("_from") == F.col("_n"), "left_semi").select(F.col("_to").alias("_n")).distinct()
        front = staged(found.join(seen, "_n", "left_anti"), "hop")
        seen = seen.unionByName(front.withColumn("depth", F.lit(step)))
    return seen.select(F.col("_n").alias(node), "depth")


def date_gate(candidate: Column, extracted: Column, by_url: Column, undated: str, inside) -> Column:  # noqa: ANN001
    """What a crawl does with a page by its dates: 'kept', 'outside', or ``undated`` where nothing dates it.

    The candidate's own date decides where there is one, then the extracted one, then whether the URL names a day of the
    window; ``inside`` tells for a date whether it is in the window.
    """
    judged = lambda c: F.when(inside(c), F.lit("kept")).otherwise(F.lit("outside"))
    return F.when(candidate.isNotNull(), judged(candidate)).when(extracted.isNotNull(), judged(extracted)).when(by_url, F.lit("kept")).otherwise(F.lit(undated))


def access_gate(text: Column, full: int, hard: Sequence[str], soft: Sequence[str]) -> Column:
    """Whether a page shuts readers out: long texts only by the hard markers, shorter ones by the soft ones too; null is short."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hit = lambda marks: first_label([(low.contains(m), "x") for m in marks]).isNotNull() if marks else F.lit(False)
    return hit(hard) | ((F.length(low) < full) & hit(soft))


def summary_articles(entries: DataFrame, pages: DataFrame, url: str, summary: str, text_hash: Column, known: DataFrame, least: int = 180) -> DataFrame:
    """Feed entries whose page gave no text and whose own summary can stand for it, each text once.

    ``pages`` has (url, ok), ``known`` one column of text hashes that are stored already.
    """
    failed = pages.groupBy(url).agg(F.max("ok").alias("ok")).filter(~F.col("ok")).select(url)
    rows = entries.join(failed, url, "left_semi").filter((F.length(F.trim(summary)) >= least) & F.col("title").isNotNull()).withColumn("text_hash", text_hash)
    rows = rows.join(known.toDF("text_hash").distinct(), "text_hash", "left_anti")
    return top_n_per_group(rows, ["text_hash"], [F.col(url).asc()], 1)


def due_profiles(sources: DataFrame, profiles: DataFrame, source: str, at: str, now: Column, days: int) -> DataFrame:
    """Sources whose newest profile is older than ``days`` or missing."""
    fresh = profiles.groupBy(source).agg(F.max(at).alias("_at")).filter(F.col("_at") >= now - F.make_interval(days=F.lit(days))).select(source)
    return sources.join(fresh, source, "left_anti")


def first_valid(candidates: DataFrame, source: str, order: Sequence[Column], valid: Column) -> DataFrame:
    """The first candidate of each source, in order, that is valid; sources without one give no row."""
    return top_n_per_group(candidates.filter(F.coalesce(valid, F.lit(False))), [source], order, 1)


def registry_status(registry: DataFrame, attempts: Sequence[tuple[DataFrame, Sequence[str]]], failed: DataFrame, key: str) -> DataFrame:
    """(registry columns, hits, status) by cascaded counts: the first of the (rows, columns) attempts that match gives the hits.

    A registry row matches an attempt's rows in all its columns. Status is 'success' with hits, 'failed' where ``failed``
    (one column of keys) names the row, else 'zero_hit'. Rows without values for an attempt do not match it.
    """
    out, names = registry, []
    for n, (rows, columns) in enumerate(attempts):
        counts = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(f"_n{n}"))
        out = out.join(counts, list(columns), "left")
        names.append(f"_n{n}")
    bad = failed.toDF(key).distinct().withColumn("_bad", F.lit(True))
    out = out.join(bad, key, "left").withColumn("hits", F.coalesce(*names, F.lit(0)))
    return out.withColumn("status", F.when(F.col("hits") > 0, "success").when(F.col("_bad"), "failed").otherwise("zero_hit")).select(*registry.columns, "hits", "status")


def counts_by(df: DataFrame, group: str, label: str, labels: Sequence[str]) -> DataFrame:
    """One row for each group with a count a label and ``total``, in one pass; a null group is one of its own."""
    return df.groupBy(group).agg(*[F.count_if(F.col(label) == x).alias(x) for x in labels], F.count(F.lit(1)).alias("total"))


def content_stats(df: DataFrame, group: str, size: str, full: int) -> DataFrame:
    """Rows, mean and median of the sizes above 0, the share of full ones, and a rating by it, for each group."""
    some = F.when(F.col(size) > 0, F.col(size))
    out = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(some), 4).alias("mean"), F.median(some).alias("median"), F.round(F.count_if(F.col(size) >= full) / F.count(F.lit(1)), 4).alias("full_share"))
    return out.withColumn("rating", F.when(F.col("full_share") >= 0.8, "full").when(F.col("full_share") >= 0.3, "partial").otherwise("poor"))


def ledger(opened: DataFrame, closed: DataFrame, key: str) -> DataFrame:
    """Runs with what closed them: each run's last closing row sets its end and counts, its notes only where it has some.

    ``opened`` has (key, started_at, notes), ``closed`` (key, finished_at, items, notes); runs without a closing stay open.
    """
    last = closed.groupBy(key).agg(F.max_by(F.struct("finished_at", "items", "notes"), F.struct("finished_at", "items")).alias("c"))
    note = F.coalesce(F.nullif(F.trim("c.notes"), F.lit("")), F.col("notes"))
    return opened.join(last, key, "left").select(key, "started_at", F.col("c.finished_at").alias("finished_at"), F.col("c.items").alias("items"), note.alias("notes"))


def retained(df: DataFrame, at: str, now: Column, days: int, least: int = 3) -> DataFrame:
    """Rows of the last ``days``, but never fewer than ``least`` days; rows without a time stay."""
    return df.filter(F.col(at).isNull() | (F.col(at) >= now - F.make_interval(days=F.lit(max(days, least)))))


def truncated_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) of what emptying these tables removes; the tables themselves are replaced by empty frames of their schema."""
    out: DataFrame | None = None
    for name, df in tables.items():
        own = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = own if out is None else out.unionByName(own)
    return out
