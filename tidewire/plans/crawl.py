"""Crawl queries over the stored tables: frontiers, gates, registries and the life of the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.operators import discovery
from tidewire.operators.ranking import top_n_per_group
from tidewire.runtime import table

NOW = "2025-12-01 00:00:00"
DAYS = ["2025-09-20", "2025-09-19"]


def _now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "discovered_urls")


def _frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _found(spark, sf_dir).filter("discovery_method = 'rss' AND source_id <> ''")
    when = F.when(F.pmod(F.length("url"), F.lit(5)) > 0, F.col("discovered_at"))  # a fifth of the entries names no time
    on_day = F.col("discovered_at") >= F.lit("2025-10-01").cast("timestamp_ntz")
    return discovery.feed_frontier(d, "source_id", "url", when, on_day, 20)


def crawl_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frontier(spark, sf_dir).select("source_id", "url", "entry_time")


def crawl_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.fallback_sources(table(spark, sf_dir, "source_profiles").select("source_id"), _frontier(spark, sf_dir), "source_id")


def crawl_sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _found(spark, sf_dir).join(table(spark, sf_dir, "source_profiles").select("source_id", "domain"), "source_id")
    d = d.withColumn("lastmod", F.when(F.length("url") % 3 > 0, F.col("discovered_at")))
    priority = F.when(F.col("url").contains("/news/"), 0).when(F.col("url").contains("/tin/"), 1).otherwise(2)
    recent = F.col("url").rlike("/2026/0[34]/")
    rows = discovery.sitemap_frontier(d, "source_id", "url", "lastmod", priority, recent, urls.host(F.col("url")).isNotNull() & (F.length("domain") > 0), 20)
    return rows.select("source_id", "url", "place")


def crawl_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts reached from one supplier in up to two steps over suppliers that share parts."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") * 7).alias("a"), F.col("l_partkey").alias("b")).filter("b % 11 = 0")
    seeds = table(spark, sf_dir, "supplier").filter("s_suppkey <= 3").select((F.col("s_suppkey") * 7).alias("node"))
    links = li.select("a", "b").unionByName(li.select(F.col("b").alias("a"), (F.col("b") % 50 * 7).alias("b")))
    return discovery.hops(seeds, links, "node", "a", "b", 2)


def crawl_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").groupBy("id").agg(F.max("url").alias("url"), F.max("extracted_at").alias("extracted_at"), F.max("published_at").alias("published_at"))
    candidate = F.expr("try_cast(CASE WHEN published_at RLIKE '^\\\\d{4}-\\\\d{2}-\\\\d{2}$' THEN published_at END AS date)")
    extracted = F.when(F.length("url") % 2 == 0, F.col("extracted_at").cast("date"))
    inside = lambda c: (c >= F.lit("2025-09-19").cast("date")) & (c <= F.lit("2025-10-20").cast("date"))
    gate = discovery.date_gate(candidate, extracted, urls.names_recent_day(F.col("url"), DAYS), "undated", inside)
    return a.groupBy(gate.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def crawl_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").select("id", "content").distinct()
    return a.filter(discovery.access_gate(F.col("content"), 400, ["access denied", "403 forbidden"], ["captcha", "verify you are human", "enable javascript"])).select("id")


def crawl_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _found(spark, sf_dir).select("url", "title", F.concat_ws(" ", "title", "url", "raw_metadata").alias("summary")).distinct()
    a = table(spark, sf_dir, "articles").select("url", (F.coalesce(F.length("content"), F.lit(0)) > 900).alias("ok"), "title")
    return discovery.summary_articles(d, a.select("url", "ok"), "url", "summary", F.sha2("summary", 256), a.limit(0).select("url"), 100).select("url", "text_hash")


def crawl_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to ten addresses of each source by how much they look like an article's, each page once."""
    u = F.col("url")
    d = _found(spark, sf_dir).filter("source_id <> '' AND url IS NOT NULL").select("source_id", urls.page_key(u).alias("url")).distinct()
    score = F.when(u.rlike(r"/\d{4}/\d{2}/"), 3).otherwise(0) + F.when(u.rlike(r"\d{5}"), 2).otherwise(0) + F.when(F.regexp_count(u, F.lit("-")) >= 5, 2).otherwise(0) - F.when(u.rlike("/(tag|category|page)/"), 5).otherwise(0)
    return top_n_per_group(d.withColumn("score", score), ["source_id"], [F.col("score").desc(), u.asc()], 10)


def crawl_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "source_profiles")
    return discovery.due_profiles(p.select("source_id"), p, "source_id", "profiled_at", F.lit("2025-09-18").cast("timestamp_ntz"), 7)


def crawl_first_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first discovered address of each source that became an article."""
    d = _found(spark, sf_dir).filter("source_id <> ''").select("source_id", "url", "discovered_at").distinct()
    a = table(spark, sf_dir, "articles").select("url").distinct().withColumn("ok", F.lit(True))
    return discovery.first_valid(d.join(a, "url", "left"), "source_id", [F.col("discovered_at").asc(), F.col("url").asc()], F.col("ok")).select("source_id", "url")


def crawl_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles as registry: hits by source, else by domain; failed where errors name the source."""
    p = table(spark, sf_dir, "source_profiles").select("source_id", "domain")
    a = table(spark, sf_dir, "articles").filter("quality_score > 0.9").select("source_id")
    d = _found(spark, sf_dir).filter("discovery_method = 'sitemap'").select(urls.host(F.col("url")).alias("domain"))
    e = table(spark, sf_dir, "crawl_errors").filter("error_type = 'HttpError'").select("source_id")
    return discovery.registry_status(p, [(a, ["source_id"]), (d, ["domain"])], e, "source_id").select("source_id", "hits", "status")


def crawl_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.counts_by(_found(spark, sf_dir), "source_id", "discovery_method", ["rss", "sitemap", "html"])


def crawl_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").select("id", "source_id", F.length("content").alias("size")).distinct()
    return discovery.content_stats(a, "source_id", "size", 800)


def crawl_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    opened = o.select("o_orderkey", F.col("o_orderdate").alias("started_at"), F.col("o_orderpriority").alias("notes"))
    li = table(spark, sf_dir, "lineitem").filter("l_linenumber < 3")
    closed = li.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("finished_at"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("items"), F.when(F.col("l_linenumber") == 1, F.lit(" ")).otherwise(F.concat(F.lit("line "), F.col("l_partkey").cast("string"))).alias("notes"))
    return discovery.ledger(opened, closed, "o_orderkey")


def crawl_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.retained(table(spark, sf_dir, "crawl_errors"), "created_at", _now(), 1, 30).select("id").distinct()


def crawl_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.truncated_counts({n: table(spark, sf_dir, n) for n in ("articles", "crawl_errors", "discovered_urls")})


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("crawl_")}

_HOST = "regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
_F = """f0 AS (SELECT source_id, url, max(CASE WHEN length(url) % 5 > 0 THEN discovered_at END) AS entry_time FROM discovered_urls
  WHERE discovery_method = 'rss' AND source_id <> '' AND url IS NOT NULL AND discovered_at >= TIMESTAMP '2025-10-01' GROUP BY ALL),
f AS (SELECT * FROM f0 QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY entry_time DESC NULLS LAST, url) <= 20)"""
_SCHEME = "lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
_PATH = "regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_KEY = f"(CASE WHEN {_SCHEME} = '' THEN 'https' ELSE {_SCHEME} END || '://' || {_HOST} || CASE WHEN {_PATH} IN ('', '/') THEN '/' ELSE regexp_replace({_PATH}, '/$', '') END)"
_RECENT = " OR ".join(f"contains(lower(url), '{d}') OR contains(lower(url), '{d.replace('-', '/')}')" for d in DAYS)
_MONTH = "regexp_extract(lower(url), '/(\\d{4})/(\\d{1,2})(?:/|$)', 1) || '-' || lpad(regexp_extract(lower(url), '/(\\d{4})/(\\d{1,2})(?:/|$)', 2), 2, '0') = '2025-09'"
ORACLE = {
    "crawl_frontier": f"WITH {_F} SELECT * FROM f",
    "crawl_fallback": f"WITH {_F} SELECT source_id FROM source_profiles WHERE source_id NOT IN (SELECT source_id FROM f)",
    "crawl_sitemap": """WITH d AS (SELECT source_id, url, max(CASE WHEN length(url) % 3 > 0 THEN discovered_at END) AS lastmod FROM discovered_urls JOIN source_profiles USING (source_id) WHERE url IS NOT NULL AND length(domain) > 0 GROUP BY ALL),
r AS (SELECT source_id, url, row_number() OVER (PARTITION BY source_id ORDER BY CASE WHEN contains(url, '/news/') THEN 0 WHEN contains(url, '/tin/') THEN 1 ELSE 2 END,
  CASE WHEN lastmod IS NULL AND regexp_matches(url, '/2026/0[34]/') THEN 0 WHEN lastmod IS NOT NULL THEN 1 ELSE 2 END, lastmod DESC NULLS LAST, url) AS place FROM d) SELECT * FROM r WHERE place <= 20""",
    "crawl_hops": """WITH RECURSIVE li AS (SELECT DISTINCT l_suppkey * 7 AS a, l_partkey AS b FROM lineitem WHERE l_partkey % 11 = 0), e AS (SELECT a, b FROM li UNION SELECT b, b % 50 * 7 FROM li),
h AS (SELECT s_suppkey * 7 AS node, 0 AS depth FROM supplier WHERE s_suppkey <= 3 UNION SELECT b, depth + 1 FROM h JOIN e ON a = node WHERE depth < 2) SELECT node, min(depth) AS depth FROM h GROUP BY node""",
    "crawl_gates": f"""WITH a AS (SELECT id, max(url) AS url, max(extracted_at) AS x, max(published_at) AS p FROM articles GROUP BY id),
c AS (SELECT url, CASE WHEN regexp_matches(p, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast(p AS DATE) END AS d, CASE WHEN length(url) % 2 = 0 THEN x::DATE END AS e FROM a)
SELECT CASE WHEN coalesce(d, e) IS NOT NULL THEN CASE WHEN coalesce(d, e) BETWEEN DATE '2025-09-19' AND DATE '2025-10-20' THEN 'kept' ELSE 'outside' END WHEN {_RECENT} OR {_MONTH} THEN 'kept' ELSE 'undated' END AS verdict, count(*) AS n FROM c GROUP BY 1""",
    "crawl_access": """WITH a AS (SELECT DISTINCT id, lower(coalesce(content, '')) AS t FROM articles) SELECT id FROM a WHERE contains(t, 'access denied') OR contains(t, '403 forbidden')
OR (length(t) < 400 AND (contains(t, 'captcha') OR contains(t, 'verify you are human') OR contains(t, 'enable javascript')))""",
    "crawl_summaries": """WITH d AS (SELECT DISTINCT url, title, concat_ws(' ', title, url, raw_metadata) AS s FROM discovered_urls), f AS (SELECT url FROM articles GROUP BY url HAVING NOT max(coalesce(length(content), 0) > 900))
SELECT min(url) AS url, sha256(s) AS text_hash FROM d SEMI JOIN f USING (url) WHERE length(trim(s, ' ')) >= 100 AND title IS NOT NULL GROUP BY 2""",
    "crawl_likeness": f"""WITH d AS (SELECT DISTINCT source_id, {_KEY} AS url FROM discovered_urls WHERE source_id <> '' AND url IS NOT NULL),
s AS (SELECT source_id, url, CASE WHEN regexp_matches(url, '/\\d{{4}}/\\d{{2}}/') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(url, '\\d{{5}}') THEN 2 ELSE 0 END + CASE WHEN length(url) - length(replace(url, '-', '')) >= 5 THEN 2 ELSE 0 END
 - CASE WHEN regexp_matches(url, '/(tag|category|page)/') THEN 5 ELSE 0 END AS score FROM d) SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY score DESC, url) <= 10""",
    "crawl_due": "SELECT source_id FROM source_profiles WHERE source_id NOT IN (SELECT source_id FROM source_profiles GROUP BY 1 HAVING max(profiled_at) >= TIMESTAMP '2025-09-11')",
    "crawl_first_valid": """WITH d AS (SELECT DISTINCT source_id, url, discovered_at FROM discovered_urls WHERE source_id <> '')
SELECT source_id, url FROM d SEMI JOIN articles USING (url) QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY discovered_at, url) = 1""",
    "crawl_registry": f"""WITH a AS (SELECT source_id, count(*) AS n FROM articles WHERE quality_score > 0.9 GROUP BY 1), d AS (SELECT {_HOST} AS domain, count(*) AS n FROM discovered_urls WHERE discovery_method = 'sitemap' GROUP BY 1),
h AS (SELECT p.source_id, coalesce(a.n, d.n, 0) AS hits FROM source_profiles p LEFT JOIN a ON p.source_id = a.source_id LEFT JOIN d ON p.domain = d.domain)
SELECT source_id, hits, CASE WHEN hits > 0 THEN 'success' WHEN source_id IN (SELECT source_id FROM crawl_errors WHERE error_type = 'HttpError' AND source_id IS NOT NULL) THEN 'failed' ELSE 'zero_hit' END AS status FROM h""",
    "crawl_methods": "SELECT source_id, count(*) FILTER (discovery_method = 'rss') AS rss, count(*) FILTER (discovery_method = 'sitemap') AS sitemap, count(*) FILTER (discovery_method = 'html') AS html, count(*) AS total FROM discovered_urls GROUP BY 1",
    "crawl_content": """WITH a AS (SELECT DISTINCT id, source_id, length(content) AS size FROM articles), s AS (SELECT source_id, count(*) AS n, round(avg(size) FILTER (size > 0), 4) AS mean, median(size) FILTER (size > 0) AS median, round(count(*) FILTER (size >= 800) / count(*), 4) AS full_share FROM a GROUP BY 1)
SELECT *, CASE WHEN full_share >= 0.8 THEN 'full' WHEN full_share >= 0.3 THEN 'partial' ELSE 'poor' END AS rating FROM s""",
    "crawl_ledger": """WITH c AS (SELECT l_orderkey, l_shipdate, l_partkey * 10 + l_linenumber AS items, CASE WHEN l_linenumber = 1 THEN ' ' ELSE 'line ' || l_partkey END AS note FROM lineitem WHERE l_linenumber < 3 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, items DESC) = 1)
SELECT o_orderkey, o_orderdate AS started_at, l_shipdate AS finished_at, items, coalesce(nullif(trim(note), ''), o_orderpriority) AS notes FROM orders LEFT JOIN c ON o_orderkey = l_orderkey""",
    "crawl_retained": f"SELECT DISTINCT id FROM crawl_errors WHERE created_at IS NULL OR created_at >= TIMESTAMP '{NOW}' - INTERVAL 30 DAYS",
    "crawl_truncated": " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}" for n in ("articles", "crawl_errors", "discovered_urls")),
}
