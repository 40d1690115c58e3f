"""Fuzzy matches: sequence similarity, blocked scored joins, and dictionary containment."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidewire.functions import scores, urls
from tidewire.operators import nearest
from tidewire.runtime import broadcast_if_small, staged


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The Ratcliff-Obershelp similarity of two strings with the junk heuristic; null counts as empty."""
    out = []
    for x, y in zip(a.fillna(""), b.fillna(""), strict=True):
        out.append(1.0 if x == y else SequenceMatcher(None, x, y).ratio())
    return pd.Series(out, dtype="float64")


def words(text: Column, least: int = 4) -> Column:
    """The different words of at least ``least`` letters or digits, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"(?U)(\w{{{least},}})"), F.lit(1)))


def overlap(a: Column, b: Column) -> Column:
    """The share of the words of ``a`` that ``b`` has too; 0 without words."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(0.0)


@cache
def _letters(text: str) -> Counter[str]:
    return Counter(text)


def sequence_ratio_from(least: float):  # noqa: ANN201
    """``sequence_ratio`` where that is at least ``least``, else 0: pairs whose letters cannot reach it are not aligned."""

    @F.pandas_udf(DoubleType())
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a.fillna(""), b.fillna(""), strict=True):
            if x == y:
                out.append(1.0)
            elif 2 * (_letters(x) & _letters(y)).total() < least * (len(x) + len(y)):
                out.append(0.0)
            else:
                r = SequenceMatcher(None, x, y).ratio()
                out.append(r if r >= least else 0.0)
        if _letters.cache_info().currsize > 50_000:
            _letters.cache_clear()
        return pd.Series(out, dtype="float64")

    return ratio


def resolved_urls(wanted: DataFrame, known: DataFrame, least: float = 0.72, contained: float = 0.82, strong: float = 0.48) -> DataFrame:
    """(raw_url, url, score): the known URL that each wanted one stands for.

    ``wanted`` is (raw_url) or (raw_url, headline), ``known`` (url) or (url, title); of several headlines or titles of a URL
    the smallest counts. The same page key scores 1. Otherwise the paths of URLs of the same host are compared, a path
    within the other scores ``contained`` at least; where both headline and title are there, the score is multiplied by
    0.55 + 0.45 x the title score. The best candidate at ``least`` or more wins, ties by the smaller URL. What is left goes
    to the best title of its host, then of any host, at ``strong`` or more. The title score is the similarity of headline
    and title, or 0.7 x the share of the headline's words in the title if that is more. Pairs that cannot be the best are
    left out by bounds alone (see nearest), so the result is that of comparing all.
    """
    given = wanted if "headline" in wanted.columns else wanted.withColumn("headline", F.lit(None).cast("string"))
    titled = known if "title" in known.columns else known.withColumn("title", F.lit(None).cast("string"))
    text = lambda c: F.when(F.trim(F.col(c)) != "", F.lower(F.trim(F.col(c))))
    w = given.filter(F.col("raw_url").isNotNull()).groupBy("raw_url").agg(F.min(text("headline")).alias("hl"))
    w = staged(w.select("raw_url", "hl", words(F.col("hl")).alias("hw"), urls.page_query_key(F.col("raw_url")).alias("k"), urls.host(F.col("raw_url")).alias("h"), urls.path(F.col("raw_url")).alias("p")), "wanted")
    k = titled.filter(F.col("url").isNotNull()).select(urls.page_query_key(F.col("url")).alias("url"), text("title").alias("title")).groupBy("url").agg(F.min("title").alias("title"))
    k = staged(k.select("url", "title", words(F.col("title")).alias("tw"), urls.host(F.col("url")).alias("h"), urls.path(F.col("url")).alias("q")), "known")
    w, k = w.withColumn("hw", F.array_join("hw", " ")), k.withColumn("tw", F.array_join("tw", " "))
    best = lambda scored: scored.groupBy("raw_url").agg(F.min_by(F.struct("url", "score"), F.struct(-F.col("score"), F.col("url"))).alias("b")).select("raw_url", "b.url", "b.score")

    exact = w.join(k.select("url"), F.col("k") == F.col("url")).select("raw_url", "url", F.lit(1.0).alias("score"))
    left = w.join(exact.select("raw_url"), "raw_url", "left_anti").filter((F.col("h") != "") & (F.length("p") >= 10))
    by_path = _in_blocks(left.select("h", "raw_url", "p", "hl", "hw"), k.select("h", "url", "q", "title", "tw"), nearest.by_path(least, contained))
    found = staged(exact.unionByName(best(by_path)), "resolved")

    heads = k.filter("title IS NOT NULL").select("h", "url", "title", "tw")
    open_ = w.filter("hl IS NOT NULL").join(found.select("raw_url"), "raw_url", "left_anti").select("raw_url", "hl", "hw", "h")
    for here in (True, False):
        rest = staged(open_, "open")
        if rest.isEmpty():
            break
        # the same title is the best there is and needs no comparing
        on = ["hl", "h"] if here else ["hl"]
        same = best(rest.join(heads.withColumn("hl", F.col("title")).select("url", *on), on).withColumn("score", F.lit(1.0)))
        others = rest.join(same.select("raw_url"), "raw_url", "left_anti")
        of = (lambda df: df) if here else (lambda df: df.withColumn("h", F.lit("")))
        scored = _in_blocks(of(others), of(heads), nearest.by_title(strong))
        matched = staged(same.unionByName(best(scored)), "by_title")
        found = found.unionByName(matched)
        open_ = rest.join(matched.select("raw_url"), "raw_url", "left_anti")
    return found


#: Known URLs of a host that one task compares at most; of the wanted ones it takes an eighth of those of the host, or so many.
KNOWN_BLOCK, WANTED_BLOCK = 65_536, 512


def _in_blocks(wanted: DataFrame, known: DataFrame, find) -> DataFrame:  # noqa: ANN001
    """(raw_url, url, score) of ``find`` over all pairs of blocks of each host ``h``, so that a large host is many tasks."""
    sizes = wanted.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).join(known.groupBy("h").agg(F.count(F.lit(1)).alias("_m")), "h")
    each = F.greatest(F.lit(WANTED_BLOCK), F.ceil(F.col("_m") / 8))
    sizes = staged(sizes.select("h", F.ceil(F.col("_n") / each).alias("_ws"), F.ceil(F.col("_m") / KNOWN_BLOCK).alias("_ks")), "block_sizes")
    small = broadcast_if_small(sizes, 64)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    a = wanted.join(small, "h").withColumn("_w", F.pmod(F.xxhash64("raw_url"), "_ws")).withColumn("_k", every("_ks")).drop("_ws", "_ks")
    b = known.join(small, "h").withColumn("_k", F.pmod(F.xxhash64("url"), "_ks")).withColumn("_w", every("_ws")).drop("_ws", "_ks")
    keys = ["h", "_w", "_k"]
    # the work of a block does not follow its bytes, so small ones are not to be put together in few tasks
    spark = wanted.sparkSession
    n = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    a, b = a.repartition(n, *keys), b.repartition(n, *keys)
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(find, "raw_url string, url string, score double")


#: What names and numbers look like in a headline.
HINTS = r"(\b[A-Z][a-zA-Z]{2,}\b|\b[A-Z]{2,}\b|\b\d[\d.,]{1,8}\b)"


def headline_matches(headlines: DataFrame, articles: DataFrame, least: float = 0.36, stop: Sequence[str] = (), weights: tuple[float, float, float] = (0.35, 0.4, 0.25)) -> DataFrame:
    """(headline, id, score): the article that fits a headline best, by words, sequence and names; ties by the smaller id.

    The score weighs the share of the headline's words (three letters and more, without marks and stop words) in title and
    text, the similarity of headline and title, and the share of its names and numbers in title and text. It is nothing
    where the headline has names of which the article holds none, or none with four Latin letters in its title; where
    neither sequence nor words come near; and where there is no title. ``articles`` is (id, title) or (id, title, text).

    Candidates share a word or a number with the headline, however common it is; headlines are few beside the articles.
    """
    own = lambda c: F.array_except(F.array_distinct(F.regexp_extract_all(scores.folded(c), F.lit(r"(?U)(\w{3,})"), F.lit(1))), F.array(*[F.lit(x) for x in stop]).cast("array<string>"))
    raw = F.col("headline")
    h = headlines.filter(raw.isNotNull()).select("headline").distinct()
    h = h.select("headline", own(raw).alias("w"), scores.folded(raw).alias("hf"), F.array_distinct(F.transform(F.regexp_extract_all(raw, F.lit(HINTS), F.lit(1)), lambda x: F.lower(x))).alias("names"))
    h = staged(h, "headlines")
    text = F.substring("text", 1, 1000) if "text" in articles.columns else F.lit("")
    a = articles.filter(F.trim("title") != "").select("id", scores.folded(F.col("title")).alias("tf"), F.concat_ws(" ", scores.folded(F.col("title")), scores.folded(text)).alias("blob"))
    a = a.withColumn("v", own(F.col("blob")))
    keyed = broadcast_if_small(h.select("headline", F.explode(F.array_union("w", "names")).alias("x")), 200)
    hits = a.select("id", F.explode(F.array_union("v", F.split("tf", r"[^\p{L}\p{N}.,]+"))).alias("x")).join(keyed, "x").select("headline", "id").distinct()
    pairs = hits.join(broadcast_if_small(h, 600), "headline").join(a, "id")
    words_in, seq = overlap(F.col("w"), F.col("v")), sequence_ratio(F.col("hf"), F.col("tf"))
    held = F.filter("names", lambda n: F.col("blob").contains(n))
    strong = F.filter("names", lambda n: (F.length(n) >= 4) & n.rlike("^[ -~]+$"))
    unnamed = (F.size("names") > 0) & (F.size(held) == 0)
    elsewhere = (F.size(strong) > 0) & ~F.exists(strong, lambda n: F.col("tf").contains(n))
    named = F.when(F.size("names") > 0, F.size(held) / F.size("names")).otherwise(0.0)
    rated = pairs.filter(~unnamed & ~elsewhere).withColumns({"_w": words_in, "_s": seq, "_n": named}).filter((F.col("_s") >= 0.24) | (F.col("_w") >= 0.42))
    total = F.least(F.lit(1.0), weights[0] * F.col("_w") + weights[1] * F.col("_s") + weights[2] * F.col("_n"))
    scored = rated.withColumn("score", F.round(total, 6)).filter(F.col("score") >= least)
    return scored.groupBy("headline").agg(F.min_by(F.struct("id", "score"), F.struct(-F.col("score"), F.col("id"))).alias("b")).select("headline", "b.id", "b.score")


def story_sources(stories: DataFrame, articles: DataFrame, floor: float = 0.36, loose: float = 0.2, cap: int = 3) -> DataFrame:
    """(story, id, pass, place): up to ``cap`` articles for each story by its needed and forbidden title words.

    ``stories`` has (story, text, needed, forbidden), the last two arrays of words; ``articles`` has (id, title). An article
    whose title holds a forbidden word, or none of the needed ones where there are any, never fits. The first pass takes word
    overlap of ``floor`` and more, the second fills up from ``loose``; inside a pass the larger overlap, then the smaller id.
    """
    s = stories.filter(F.col("text").isNotNull()).select("story", words(scores.folded(F.col("text")), 3).alias("w"), F.coalesce("needed", F.array().cast("array<string>")).alias("need"), F.coalesce("forbidden", F.array().cast("array<string>")).alias("ban"))
    a = articles.filter(F.col("title").isNotNull()).select("id", words(scores.folded(F.col("title")), 3).alias("v")).distinct()
    keyed = broadcast_if_small(staged(s.select("story", F.explode("w").alias("x")), "story_words"), 120)
    pairs = a.select("id", F.explode("v").alias("x")).join(keyed, "x").groupBy("story", "id").agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.join(broadcast_if_small(s, 400), "story").join(a, "id")
    fits = ~F.arrays_overlap("ban", "v") & ((F.size("need") == 0) | F.arrays_overlap("need", "v"))
    rated = rows.filter(fits).withColumn("score", F.round(F.col("n") / F.size("w"), 6)).filter(F.col("score") >= loose)
    rated = rated.withColumn("pass", F.when(F.col("score") >= floor, 1).otherwise(2))
    w = Window.partitionBy("story").orderBy("pass", F.desc("score"), "id")
    return rated.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= cap).select("story", "id", "pass", "place")


def compacted(text: str) -> str:
    """A text in lower case, of which only ASCII letters and digits and Han characters are left."""
    return re.sub(r"[^0-9a-z\u3400-\u9fff]+", "", text.lower())


def entity_hits(texts: DataFrame, key: str, text: str, watchlist: DataFrame, compact: bool = True) -> DataFrame:
    """(key, entity, alias): for each text and entity, the first alias, in list order, that the text holds.

    The text holds an alias as a substring or, with ``compact``, where both are compacted, so spaces and hyphens do not
    count. ``watchlist`` (entity, aliases) is a small dimension; it goes to the tasks as one literal, each text is scanned once.
    """
    rows = [(r.entity, [(a.lower(), compacted(a) if compact else "") for a in r.aliases if a]) for r in watchlist.orderBy("entity").collect()]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, t in zip(batch["_key"], batch["_text"], strict=True):
                low = (t or "").lower()
                close = compacted(low) if compact else ""
                for entity, aliases in rows:
                    hit = next((a for a, c in aliases if a in low or (c and c in close)), None)
                    if hit is not None:
                        out.append((k, entity, hit))
            yield pd.DataFrame(out, columns=["_key", "entity", "alias"])

    own = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return own.mapInPandas(scan, f"_key {dict(own.dtypes)['_key']}, entity string, alias string").withColumnRenamed("_key", key)


def prose_covered(item: Column, prose: Column, head: int = 60, least: float = 0.72) -> Column:
    """Whether a text stands in a longer one: wholly, by its first ``head`` characters, or nearly the whole of it; empty texts do not."""
    a, b = F.lower(F.trim(F.coalesce(item, F.lit("")))), F.lower(F.trim(F.coalesce(prose, F.lit(""))))
    by_head = (F.length(a) >= head) & b.contains(F.substring(a, 1, head))
    return (a != "") & (b.contains(a) | by_head | (sequence_ratio_from(least)(a, b) >= least))


def distinct_bullets(bullets: DataFrame, key: str, text: str, order: str, least: float = 0.58, cap: int = 12) -> DataFrame:
    """Each group's texts without those that are similar to one kept before, ``cap`` at most.

    A choice depends on the ones before, so a group is read in order by one task, which holds the kept texts only.
    """
    fields = bullets.schema
    at_key, at_text = bullets.columns.index(key), bullets.columns.index(text)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept, begun = None, [], False
        for batch in batches:
            takes = []
            for i, (k, t) in enumerate(zip(batch.column(at_key).to_pylist(), batch.column(at_text).to_pylist(), strict=True)):
                if not begun or k != group:
                    group, kept, begun = k, [], True
                own = str(t or "").lower()
                if len(kept) < cap and all(SequenceMatcher(None, own, x).ratio() < least for x in kept):
                    kept.append(own)
                    takes.append(i)
            yield batch.take(pa.array(takes, pa.int64()))

    return bullets.repartition(F.col(key)).sortWithinPartitions(key, order).mapInArrow(choose, fields)
