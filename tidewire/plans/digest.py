"""Digest and publication queries: articles stand for sub-topics, their hosts for domains, their URLs for sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.operators import digest
from tidewire.runtime import table

SECTORS = ("s0", "s1", "s2", "s3")


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, cluster, sector, tier, headline, url, score, seen): one row an article."""
    a = table(spark, sf_dir, "articles").select("id", "source_id", "url", "title", "quality_score", "extracted_at")
    a = a.groupBy("id").agg(*[F.max(c).alias(c) for c in a.columns if c != "id"])
    n = F.length("url")
    return a.select(
        "id", F.col("source_id").alias("cluster"), F.concat(F.lit("s"), (n % 4).cast("string")).alias("sector"), F.when(n % 7 == 0, "A").when(n % 3 == 0, "B").otherwise("C").alias("tier"),
        F.col("title").alias("headline"), "url", F.coalesce("quality_score", F.lit(0.0)).alias("score"), F.col("extracted_at").alias("seen"),
    )


def _order() -> list[Column]:
    return [F.col("tier").asc(), F.col("score").desc(), F.col("id").asc()]


def digest_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = digest.merged_topics(_topics(spark, sf_dir), "cluster", _order(), "url", "tier")
    return rows.select("id", "cluster", "tier", "members", F.array_join("urls", " ").alias("urls"))


def digest_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.candidate_pools(_topics(spark, sf_dir), "sector", "headline", _order()).select("id", "sector", "rank", "pool")


def digest_supplemented(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _topics(spark, sf_dir).select("id", "sector", "tier", "score", "url")
    picks = t.filter("tier = 'A' AND score >= 0.97")
    return digest.supplemented(picks, t, "url", "sector", {"s0": 40, "s1": 12, "s2": 400}, _order()).select("id", "sector", "origin")


def digest_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front page, dossiers and notables with one row for each story cluster across them."""
    t = _topics(spark, sf_dir).withColumn("rank", F.struct(-F.col("score"), F.col("id"))).select("id", "cluster", "tier", "rank")
    return digest.one_per_cluster([t.filter(F.col("tier") == x) for x in "ABC"], "cluster", "rank", [8, 12, 400]).select("id", "level")


def digest_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _topics(spark, sf_dir)
    return digest.quota_links(t, "sector", urls.host(F.col("url")), [F.col("seen").desc(), F.col("id").asc()], 6).select("id", "sector", "place")


def digest_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.topics_in_order(_topics(spark, sf_dir), "sector", ["s3", "none", "s1", "s0"], _order(), 2, 2).select("id", "sector", "topic_rank")


def digest_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("seen").desc(), F.col("id").asc()]
    rows = digest.signal_clusters(_topics(spark, sf_dir), "cluster", "score", order, "url", "tier")
    return rows.select("cluster", "id", "members", "mix", F.array_join("links", " ").alias("links"))


def digest_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    watched = table(spark, sf_dir, "source_profiles").select(F.col("source_id").alias("cluster"))
    hits = _topics(spark, sf_dir).filter("tier = 'A'")
    rows = digest.watch_status(watched, hits, "cluster", "url", [F.col("seen").desc(), F.col("id").asc()])
    return rows.select("cluster", "hits", F.array_join("links", " ").alias("links"))


def digest_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _topics(spark, sf_dir)
    return digest.shares(t, {"tier_a": F.col("tier") == "A", "scored": F.col("score") > 0, "sourced": F.col("cluster").isNotNull()})


def digest_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = digest.merged_excerpts(_topics(spark, sf_dir).filter("cluster IS NOT NULL"), "cluster", "headline", _order(), 5, 200, 30)
    return rows.select("cluster", "excerpt", "used")


def digest_uncopied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each document that its first two paragraphs do not hold."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    summary = F.array_join(F.slice("lines", 1, 2), " ")
    return d.select("doc_id", F.size(digest.uncopied(F.col("lines"), summary)).alias("n"))


def digest_alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose discovered title says the same as their own."""
    a = table(spark, sf_dir, "articles").select("id", "url", "title").distinct()
    d = table(spark, sf_dir, "discovered_urls").filter("title IS NOT NULL").groupBy("url").agg(F.min("title").alias("found_title"))
    return a.join(d, "url").select("id", digest.alike_texts(F.col("title"), F.substring("found_title", 1, 60)).alias("alike"))


def digest_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.link_packs(_topics(spark, sf_dir), "cluster", _order(), "url", 2, 12, 20)


def digest_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics counted over partial results, which are the tiers here with their sectors nested."""
    t = _topics(spark, sf_dir).filter("score >= 0.5")
    few = t.withColumn("r", F.row_number().over(Window.partitionBy("tier", "sector").orderBy(F.desc("score"), "id"))).filter("r <= 60")
    sectors = few.groupBy("tier", F.col("sector").alias("code")).agg(F.collect_list("id").alias("sub_topics"))
    partials = sectors.groupBy("tier").agg(F.collect_list(F.struct("code", "sub_topics")).alias("sector_notes"))
    return digest.partial_counts(partials, "sector_notes", "code", "sub_topics")


def digest_tidied(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _topics(spark, sf_dir)
    rules = [(F.col("headline").rlike("(?i)bank|capital"), "s0"), (F.col("headline").rlike("(?i)chip"), "s1")]
    return digest.tidied(t, "sector", F.col("score") < 0.2, rules, "headline", _order(), 25).select("id", "sector", "rank")


def digest_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two filters: one that leaves something and one that would leave nothing and so does not count."""
    t = _topics(spark, sf_dir).select("id", "tier")
    some, none = digest.filtered_unless_empty(t, F.col("tier") == "C"), digest.filtered_unless_empty(t, F.col("tier").isin("A", "B", "C"))
    return some.withColumn("what", F.lit("some")).unionByName(none.withColumn("what", F.lit("none"))).groupBy("what").agg(F.count(F.lit(1)).alias("n"))


def digest_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", digest.token_budget(1000, F.expr("n_chars div 4"), F.lit(100), 700, 50).cast("long").alias("tokens"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("digest_")}

_T = """t0 AS (SELECT id, max(source_id) AS cluster, max(url) AS url, max(title) AS headline, coalesce(max(quality_score), 0.0) AS score, max(extracted_at) AS seen FROM articles GROUP BY id),
t AS (SELECT *, 's' || (length(url) % 4) AS sector, CASE WHEN length(url) % 7 = 0 THEN 'A' WHEN length(url) % 3 = 0 THEN 'B' ELSE 'C' END AS tier FROM t0)"""
_O = "tier, score DESC, id"
_WORDS = "list_distinct(list_filter(regexp_split_to_array({}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"
_X, _Y = "lower(trim(coalesce(title, '')))", "lower(trim(substr(found_title, 1, 60)))"
ORACLE = {
    "digest_merged": f"""WITH {_T}, k AS (SELECT *, coalesce(cluster, '~' || id) AS key FROM t),
f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY {_O}) = 1), b AS (SELECT key, min(tier) AS best, count(*) AS members FROM k GROUP BY key),
u AS (SELECT key, url, tier, score, id FROM k WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key, url ORDER BY {_O}) = 1),
r AS (SELECT key, url, row_number() OVER (PARTITION BY key ORDER BY {_O}) AS p FROM u), l AS (SELECT key, string_agg(url, ' ' ORDER BY p) AS urls FROM r WHERE p <= 3 GROUP BY key)
SELECT id, cluster, best AS tier, members, coalesce(urls, '') AS urls FROM f JOIN b USING (key) LEFT JOIN l USING (key)""",
    "digest_pools": f"""WITH {_T}, k AS (SELECT *, substr(lower(trim(coalesce(headline, ''))), 1, 120) AS h FROM t),
o AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY sector, h ORDER BY {_O}) = 1),
r AS (SELECT id, sector, row_number() OVER (PARTITION BY sector ORDER BY {_O}) AS rank, count(*) OVER (PARTITION BY sector) AS pool FROM o) SELECT * FROM r WHERE rank <= 48""",
    "digest_supplemented": f"""WITH {_T}, p AS (SELECT * FROM t WHERE tier = 'A' AND score >= 0.97), g AS (SELECT * FROM (VALUES ('s0', 40), ('s1', 12), ('s2', 400)) AS v(sector, goal)),
n AS (SELECT sector, count(*) AS have FROM p GROUP BY sector),
o AS (SELECT * FROM t WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM p WHERE url IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY url ORDER BY {_O}) = 1),
r AS (SELECT o.*, row_number() OVER (PARTITION BY o.sector ORDER BY {_O}) AS r, coalesce(goal, 0) - coalesce(have, 0) AS need FROM o LEFT JOIN g ON o.sector = g.sector LEFT JOIN n ON o.sector = n.sector)
SELECT id, sector, 0 AS origin FROM p UNION ALL SELECT id, sector, 1 FROM r WHERE r <= need""",
    "digest_levels": f"""WITH {_T}, l AS (SELECT *, CASE tier WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END AS level FROM t),
o AS (SELECT * FROM l WHERE cluster IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY level, score DESC, id) = 1), k AS (SELECT * FROM o UNION ALL SELECT * FROM l WHERE cluster IS NULL)
SELECT id, level FROM k QUALIFY row_number() OVER (PARTITION BY level ORDER BY score DESC, id) <= CASE level WHEN 0 THEN 8 WHEN 1 THEN 12 ELSE 400 END""",
    "digest_links": f"""WITH {_T}, f AS (SELECT *, regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS host FROM t QUALIFY row_number() OVER (PARTITION BY sector ORDER BY seen DESC, id) <= 24),
s AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY sector, host ORDER BY seen DESC, id) <= 2), r AS (SELECT id, sector, row_number() OVER (PARTITION BY sector ORDER BY seen DESC, id) AS place FROM s) SELECT * FROM r WHERE place <= 6""",
    "digest_topics": f"""WITH {_T}, h AS (SELECT *, list_position(['s3', 'none', 's1', 's0'], sector) AS k FROM t WHERE sector IN ('s3', 'none', 's1', 's0') QUALIFY row_number() OVER (PARTITION BY sector ORDER BY {_O}) <= 2),
d AS (SELECT id, sector, dense_rank() OVER (ORDER BY k) AS topic_rank FROM h) SELECT * FROM d WHERE topic_rank <= 2""",
    "digest_signals": f"""WITH {_T}, lead AS (SELECT * FROM t WHERE cluster IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY score DESC, seen DESC, id) = 1), top AS (SELECT * FROM lead ORDER BY score DESC, cluster LIMIT 10),
own AS (SELECT * FROM t SEMI JOIN top USING (cluster)), c AS (SELECT cluster, tier, count(*) AS n FROM own GROUP BY ALL), m AS (SELECT cluster, sum(n)::BIGINT AS members, string_agg(tier || ':' || n, ', ' ORDER BY n DESC, tier) AS mix FROM c GROUP BY cluster),
f AS (SELECT * FROM own WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cluster, url ORDER BY score DESC, seen DESC, id) = 1), p AS (SELECT cluster, url, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, seen DESC, id) AS p FROM f),
l AS (SELECT cluster, string_agg(url, ' ' ORDER BY p) AS links FROM p WHERE p <= 6 GROUP BY cluster) SELECT cluster, id, members, mix, links FROM top JOIN m USING (cluster) LEFT JOIN l USING (cluster)""",
    "digest_watch": f"""WITH {_T}, h AS (SELECT * FROM t WHERE tier = 'A' AND cluster IS NOT NULL), n AS (SELECT cluster, count(*) AS hits FROM h GROUP BY cluster),
f AS (SELECT * FROM h WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cluster, url ORDER BY seen DESC, id) = 1), p AS (SELECT cluster, url, row_number() OVER (PARTITION BY cluster ORDER BY seen DESC, id) AS p FROM f),
l AS (SELECT cluster, string_agg(url, ' ' ORDER BY p) AS links FROM p WHERE p <= 5 GROUP BY cluster)
SELECT source_id AS cluster, coalesce(hits, 0) AS hits, coalesce(links, '') AS links FROM (SELECT DISTINCT source_id FROM source_profiles) s LEFT JOIN n ON s.source_id = n.cluster LEFT JOIN l ON s.source_id = l.cluster""",
    "digest_shares": f"""WITH {_T} SELECT count(*) AS total, count(*) FILTER (tier = 'A') AS tier_a, round(count(*) FILTER (tier = 'A') / count(*), 4) AS tier_a_share, count(*) FILTER (score > 0) AS scored,
round(count(*) FILTER (score > 0) / count(*), 4) AS scored_share, count(cluster) AS sourced, round(count(cluster) / count(*), 4) AS sourced_share FROM t""",
    "digest_excerpts": f"""WITH RECURSIVE {_T}, g AS (SELECT cluster, trim(headline, ' ') AS x, row_number() OVER (PARTITION BY cluster ORDER BY {_O}) AS p FROM t WHERE cluster IS NOT NULL AND length(trim(headline, ' ')) >= 30 QUALIFY p <= 5),
e AS (SELECT cluster, substr(x, 1, 200) AS excerpt, 1 AS used, 1 AS p FROM g WHERE p = 1
  UNION ALL SELECT e.cluster, e.excerpt || ' ' || g.x, e.used + 1, g.p FROM e JOIN g ON e.cluster = g.cluster AND g.p = e.p + 1 WHERE length(e.excerpt) + 1 + length(g.x) <= 200)
SELECT cluster, excerpt, used FROM e QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY used DESC) = 1""",
    "digest_packs": f"""WITH {_T}, r AS (SELECT * FROM t WHERE url IS NOT NULL AND trim(url) <> '' AND cluster IS NOT NULL), lead AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY {_O}) = 1), top AS (SELECT cluster FROM lead ORDER BY {_O} LIMIT 12),
own AS (SELECT * FROM r SEMI JOIN top USING (cluster) QUALIFY row_number() OVER (PARTITION BY cluster, url ORDER BY {_O}) = 1), l AS (SELECT * FROM own QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY {_O}) <= 2),
o AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY url ORDER BY {_O}) = 1) SELECT cluster, url, row_number() OVER (ORDER BY {_O}) AS place FROM o QUALIFY place <= 20""",
    "digest_partials": f"""WITH {_T}, f AS (SELECT * FROM t WHERE score >= 0.5 QUALIFY row_number() OVER (PARTITION BY tier, sector ORDER BY score DESC, id) <= 60) SELECT sector AS code, count(*) AS topics, count(DISTINCT tier) AS partials FROM f GROUP BY 1""",
    "digest_tidied": f"""WITH {_T}, m AS (SELECT * REPLACE (CASE WHEN regexp_matches(headline, '(?i)bank|capital') THEN 's0' WHEN regexp_matches(headline, '(?i)chip') THEN 's1' ELSE sector END AS sector) FROM t WHERE NOT score < 0.2),
o AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY sector, substr(lower(trim(coalesce(headline, ''))), 1, 120) ORDER BY {_O}) = 1) SELECT id, sector, row_number() OVER (PARTITION BY sector ORDER BY {_O}) AS rank FROM o QUALIFY rank <= 25""",
    "digest_guarded": f"WITH {_T} SELECT 'some' AS what, count(*) FILTER (tier <> 'C') AS n FROM t UNION ALL SELECT 'none', count(*) FROM t",
    "digest_budget": "SELECT doc_id, greatest(0, least(1000 - coalesce(n_chars // 4, 0) - 100 - 50, 700)) AS tokens FROM documents",
    "digest_uncopied": """WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), s AS (SELECT doc_id, ls, lower(trim(array_to_string(ls[:2], ' '), ' ')) AS s FROM d)
SELECT doc_id, CAST(len(list_filter(ls, lambda b: lower(trim(b, ' ')) <> s AND NOT (length(trim(b, ' ')) >= 40 AND contains(s, substr(lower(trim(b, ' ')), 1, 80))))) AS INTEGER) AS n FROM s""",
    "digest_alike": f"""WITH a AS (SELECT DISTINCT id, url, title FROM articles), d AS (SELECT url, min(title) AS found_title FROM discovered_urls WHERE title IS NOT NULL GROUP BY url),
w AS (SELECT id, {_X} AS x, {_Y} AS y FROM a JOIN d USING (url)), v AS (SELECT *, {_WORDS.format("x")} AS wx, {_WORDS.format("y")} AS wy FROM w)
SELECT id, x <> '' AND y <> '' AND (x = y OR (length(x) >= 24 AND contains(y, x)) OR (length(y) >= 24 AND contains(x, y)) OR (least(len(wx), len(wy)) > 0 AND len(list_intersect(wx, wy)) >= 0.82 * least(len(wx), len(wy)))) AS alike FROM v""",
}
