"""Queries that validate and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.operators import clusters, quality
from tidewire.runtime import table


def _arts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "articles").select("id", "source_id", "url", "title", "content_length", "language", "quality_score").distinct()


def check_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _arts(spark, sf_dir)
    rules = [
        quality.Rule("url", F.col("url").rlike("^https?://"), strict=True),
        quality.Rule("title", F.length(F.trim("title")) > 0, strict=True),
        quality.Rule("length", F.col("content_length") >= 200),
        quality.Rule("language", F.col("language").rlike("^[a-z]{2}$")),
    ]
    own = quality.violations(a, "id", rules)
    repeats = quality.repeated_values(a, "id", F.lower(F.trim("title")), "repeated title")
    known = table(spark, sf_dir, "discovered_urls").select(urls.page_key(F.col("url")))
    return own.union(repeats).union(quality.unknown_values(a, "id", urls.page_key(F.col("url")), known, "undiscovered"))


def check_window_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles")
    counts = a.agg(F.count_if(F.col("content_length") >= 3000).alias("long"), F.count_if(F.col("quality_score") >= 9).alias("good"))
    return quality.window_gate(counts, ["long", "good"], 50)


def merge_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one customer and status as a story, its lines' parts as urls."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 3 > 0, F.concat_ws("-", F.col("o_custkey").cast("string"), "o_orderstatus")).alias("cluster"), F.round("o_totalprice", 2).alias("price"))
    o = o.withColumn("urls", F.array(F.concat(F.lit("u"), (F.col("o_orderkey") % 50).cast("string")), F.concat(F.lit("u"), (F.col("o_orderkey") % 7).cast("string"))))
    out = clusters.merged(o, "cluster", "o_orderkey", [F.col("price").desc(), F.col("o_orderkey").asc()], ["price"], "urls", cap=5)
    return out.withColumn("urls", F.array_join("urls", "|"))


def merge_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").select("id", "source_id", "quality_score").distinct()
    return clusters.best_of_cluster(a, F.col("source_id"), "id", [F.col("quality_score").desc_nulls_last(), F.col("id").asc()])


def merge_label_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each source profile status by the ways a source can be read; a source may have many."""
    p = table(spark, sf_dir, "source_profiles")
    ways = F.filter(F.array(F.when(F.col("has_rss"), "rss"), F.when(F.col("has_sitemap"), "sitemap"), F.when(F.col("html_extract_ok"), "html")), lambda x: x.isNotNull())
    return clusters.label_matrix(p, "status", ways, ["rss", "sitemap", "html"])


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("check_", "merge_"))}

_KEY = "(lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') || CASE WHEN regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) IN ('', '/') THEN '/' ELSE regexp_replace(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/$', '') END)"
ORACLE = {
    "check_articles": f"""WITH a AS (SELECT DISTINCT id, source_id, url, title, content_length, language, quality_score FROM articles),
t AS (SELECT DISTINCT id, lower(trim(title, ' ')) AS v FROM a WHERE title IS NOT NULL), m AS (SELECT v FROM t GROUP BY v HAVING count(*) > 1), k AS (SELECT DISTINCT {_KEY} AS v FROM discovered_urls)
SELECT id, 'url' AS rule FROM a WHERE NOT coalesce(regexp_matches(url, '^https?://'), false) UNION ALL SELECT id, 'title' FROM a WHERE NOT coalesce(length(trim(title, ' ')) > 0, false)
UNION ALL SELECT id, 'length' FROM a WHERE content_length < 200 UNION ALL SELECT id, 'language' FROM a WHERE NOT regexp_matches(language, '^[a-z]{{2}}$')
UNION ALL SELECT id, 'repeated title' FROM t SEMI JOIN m USING (v) UNION ALL SELECT id, 'undiscovered' FROM (SELECT DISTINCT id, {_KEY} AS v FROM a WHERE url IS NOT NULL) ANTI JOIN k USING (v)""",
    "check_window_gate": "WITH c AS (SELECT greatest(count(*) FILTER (content_length >= 3000), count(*) FILTER (quality_score >= 9)) AS most FROM articles) SELECT most >= 50 AS passed, most FROM c",
    "merge_clusters": """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN o_custkey || '-' || o_orderstatus ELSE 'alone' || o_orderkey END AS c, round(o_totalprice, 2) AS price FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY price DESC, o_orderkey) AS n FROM o),
u AS (SELECT c, n * 2 AS p, 'u' || o_orderkey % 50 AS url FROM r UNION ALL SELECT c, n * 2 + 1, 'u' || o_orderkey % 7 FROM r), f AS (SELECT c, url, min(p) AS p FROM u GROUP BY 1, 2),
l AS (SELECT c, array_to_string(list_slice(list(url ORDER BY p), 1, 5), '|') AS urls FROM f GROUP BY 1)
SELECT min(o_orderkey) FILTER (n = 1) AS o_orderkey, count(*) AS members, max(price) AS price, any_value(urls) AS urls FROM r JOIN l USING (c) GROUP BY c""",
    "merge_best": "WITH a AS (SELECT DISTINCT id, source_id, quality_score FROM articles) SELECT id, source_id, quality_score FROM a QUALIFY source_id IS NULL OR row_number() OVER (PARTITION BY source_id ORDER BY quality_score DESC NULLS LAST, id) = 1",
    "merge_label_matrix": """SELECT status, count(*) FILTER (has_rss) AS rss, count(*) FILTER (has_sitemap) AS sitemap, count(*) FILTER (html_extract_ok) AS html FROM source_profiles GROUP BY 1
HAVING count(*) FILTER (has_rss OR has_sitemap OR html_extract_ok) > 0""",
}
