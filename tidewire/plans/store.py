"""Queries over the crawl store: articles, discovered URLs, errors and source profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import pages, urls
from tidewire.operators import store
from tidewire.operators.ranking import top_n_per_group
from tidewire.runtime import table

START, END = "2025-09-18 17:00:00", "2025-09-20 17:00:00"  # two local days in Asia/Ho_Chi_Minh
STATUSES = ("active", "active_candidate", "blocked", "dead", "inactive", "manual_review")


def _rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A store table, exact copies and later copies of an id counted once."""
    df = table(spark, sf_dir, name)
    return top_n_per_group(df, ["id"], [F.col("extracted_at" if name == "articles" else "discovered_at").desc_nulls_last()], 1)


def _frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "crawl_errors").filter(F.col("url").isNotNull())


def _within(df: DataFrame, column: str) -> DataFrame:
    return df.filter((F.col(column) >= F.lit(START).cast("timestamp_ntz")) & (F.col(column) < F.lit(END).cast("timestamp_ntz")))


def store_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = table(spark, sf_dir, "articles").select("id", "source_id", "extracted_at").groupBy("id").agg(F.max("source_id").alias("source_id"), F.max("extracted_at").alias("extracted_at"))
    return store.source_health(
        table(spark, sf_dir, "source_profiles"), arts, table(spark, sf_dir, "crawl_errors"), _frontier(spark, sf_dir), table(spark, sf_dir, "discovered_urls")
    )


def store_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = store.intake(
        {
            "discovered": _within(table(spark, sf_dir, "discovered_urls"), "discovered_at"),
            "extracted": _within(table(spark, sf_dir, "articles"), "extracted_at"),
            "failed": _within(_frontier(spark, sf_dir), "created_at"),
        }
    )
    return out.withColumn("remaining", F.greatest(F.lit(0), F.col("discovered") - F.col("extracted")))


def store_review_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "source_profiles")
    any_ = F.col("best_strategy").isin("manual_review", "metadata_only") | (F.col("html_status_code") >= 400) | F.col("error_message").isNotNull()
    wide = any_ | F.col("captcha_detected") | F.col("login_detected") | F.col("paywall_detected")
    return p.filter(wide).select("source_id", F.coalesce(any_, F.lit(False)).alias("strict"))


def store_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "crawl_errors")
    return e.groupBy("source_id", "error_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("url").alias("urls"))


def store_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles")
    return a.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("content_hash").alias("texts"),
        F.round(F.coalesce(F.avg("content_length"), F.lit(0.0)), 4).alias("mean_length"),
        F.coalesce(F.min("content_length"), F.lit(0)).alias("least"),
        F.coalesce(F.max("content_length"), F.lit(0)).alias("most"),
        F.count_if(F.length(F.trim("content")) > 200).alias("with_body"),
    )


def store_error_types_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "crawl_errors")
    return e.rollup("stage", "error_type").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"))


def store_top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.top_labels(table(spark, sf_dir, "crawl_errors").filter(F.col("source_id").isNotNull()), "source_id", "error_type")


def store_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "source_profiles").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return store.with_zero_rows(counts, "status", spark.createDataFrame([(s,) for s in STATUSES], "status string"))


def store_active_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health rows of the sources that were active in the window (semi join) and are not skipped (anti join)."""
    active = _within(table(spark, sf_dir, "articles"), "extracted_at").select("source_id").union(_within(table(spark, sf_dir, "discovered_urls"), "discovered_at").select("source_id")).distinct()
    errors = table(spark, sf_dir, "crawl_errors").groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).filter("n >= 100")
    health = store_source_health(spark, sf_dir)
    return health.join(active, "source_id", "left_semi").join(errors, "source_id", "left_anti").select("source_id", "articles", "errors")


def store_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lane each profiled source is crawled by."""
    p = table(spark, sf_dir, "source_profiles")
    lane = (
        F.when((F.col("best_strategy") == "rss") & (F.col("rss_valid_count") > 0), "rss")
        .when((F.col("best_strategy") == "sitemap") & F.col("has_sitemap"), "sitemap")
        .when(F.col("html_extract_ok") & F.coalesce("robots_can_fetch_homepage", F.lit(True)), "html")
        .otherwise("none")
    )
    feeds = F.coalesce(F.size(F.from_json("rss_urls", "array<string>")), F.lit(0))
    return p.select("source_id", lane.alias("lane"), F.when(feeds < 0, 0).otherwise(feeds).alias("feeds"))


def store_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles beside their counts and the first error labels."""
    p = table(spark, sf_dir, "source_profiles").select("source_id", "status")
    arts = table(spark, sf_dir, "articles").groupBy("source_id").agg(F.count_distinct("id").alias("articles"))
    labels = store_top_errors(spark, sf_dir)
    return p.join(arts, "source_id", "left").join(labels, "source_id", "left").select("source_id", "status", F.coalesce("articles", F.lit(0)).alias("articles"), "labels")


def store_allowed_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles below the allowed domains: two labels of every fifth profile's domain."""
    p = table(spark, sf_dir, "source_profiles").select("source_id", "domain")
    allowed = p.filter(F.col("domain").endswith("co.example") | F.col("domain").endswith(".test")).select(F.when(F.col("domain").endswith(".test"), F.col("domain")).otherwise("co.example").alias("allowed"))
    return store.suffix_join(p, "domain", allowed)


def store_method_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.overlap_counts(table(spark, sf_dir, "discovered_urls").select("discovery_method", "url"), "discovery_method", "url")


def store_existing_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many discovered pages each method found that are extracted already."""
    d = table(spark, sf_dir, "discovered_urls").select("discovery_method", urls.page_key(F.col("url")).alias("k")).distinct()
    a = table(spark, sf_dir, "articles").select(urls.page_key(F.col("url")).alias("k"))
    return d.join(a, "k", "left_semi").groupBy("discovery_method").agg(F.count(F.lit(1)).alias("n"))


def store_alias_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.alias_index(table(spark, sf_dir, "articles").select("id", "url").distinct(), [F.col("id").asc()])


def store_url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    d = table(spark, sf_dir, "discovered_urls").select("id", "url").distinct()
    return d.select(
        "id",
        urls.host(u).alias("host"),
        urls.page_key(u).alias("page_key"),
        urls.page_query_key(u).alias("page_query_key"),
        urls.squeezed_key(u).alias("squeezed_key"),
        urls.loose_key(u).alias("loose_key"),
        urls.source_id(urls.host(u)).alias("made_source_id"),
        urls.names_recent_day(u, ["2025-09-20", "2025-09-19"]).alias("recent"),
    )


def store_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many articles each cleaning step drops: the first reason counts, repeats of a page and text come last.

    Each text is reduced to its key and its flags where it is read; only those move.
    """
    text = F.trim(F.coalesce("content", F.lit("")))
    a = table(spark, sf_dir, "articles").select(
        "id",
        urls.page_key(F.col("url")).alias("k"),
        pages.text_key(text).alias("h"),
        pages.listing_page(F.col("url"), F.col("title")).alias("listing"),
        pages.listing_content(text).alias("list_text"),
        (F.length(text) < 250).alias("short"),
    )
    a = a.distinct()
    first = a.groupBy("k", "h").agg(F.min("id").alias("first_id"))
    rules = [("listing page", F.col("listing")), ("listing content", F.col("list_text")), ("short", F.col("short")), ("repeat", F.col("id") != F.col("first_id"))]
    return store.drop_reasons(a.join(first, ["k", "h"]), rules).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def store_text_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", pages.token_estimate(F.col("text")).alias("tokens"), F.sha2(F.col("text"), 256).alias("digest"), F.substring(F.sha1(F.col("text")), 1, 16).alias("short_digest"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("store_")}

_IN = f">= TIMESTAMP '{START}'", f"< TIMESTAMP '{END}'"
_HEALTH = """arts AS (SELECT id, max(source_id) AS source_id, max(extracted_at) AS extracted_at FROM articles GROUP BY id),
front AS (SELECT source_id, url FROM crawl_errors WHERE url IS NOT NULL),
ids AS (SELECT source_id FROM source_profiles UNION SELECT source_id FROM arts WHERE source_id <> '' UNION SELECT source_id FROM crawl_errors WHERE source_id <> '' UNION SELECT source_id FROM front WHERE source_id <> ''),
seen AS (SELECT source_id, count(DISTINCT url) AS urls_seen FROM (SELECT * FROM front UNION SELECT source_id, url FROM discovered_urls) GROUP BY source_id),
a AS (SELECT source_id, count(*) AS articles, max(extracted_at) AS last_success_at FROM arts GROUP BY source_id),
e AS (SELECT source_id, count(*) AS errors, max(created_at) AS last_error_at FROM crawl_errors GROUP BY source_id),
l AS (SELECT source_id, error_type AS last_error_type FROM crawl_errors QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY created_at DESC NULLS LAST, id DESC) = 1),
health AS (SELECT source_id, coalesce(urls_seen, 0) AS urls_seen, coalesce(articles, 0) AS articles, coalesce(errors, 0) AS errors, last_success_at, last_error_at, last_error_type,
  CASE WHEN coalesce(articles, 0) + coalesce(errors, 0) > 0 THEN round(coalesce(articles, 0)::DOUBLE / (coalesce(articles, 0) + coalesce(errors, 0)), 6) ELSE 0.0 END AS success_rate
  FROM ids LEFT JOIN seen USING (source_id) LEFT JOIN a USING (source_id) LEFT JOIN e USING (source_id) LEFT JOIN l USING (source_id))"""


def _count(name: str, source: str, when: str, extra: str = "") -> str:
    return f"SELECT coalesce(nullif(trim(source_id), ''), '(unknown)') AS source_id, '{name}' AS what, count(*) AS n FROM {source} WHERE {when} {_IN[0]} AND {when} {_IN[1]} {extra} GROUP BY 1"


_HOST = "regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
_SCHEME = "lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
_PATH0 = "regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_PATH = f"CASE WHEN {_PATH0} IN ('', '/') THEN '/' ELSE regexp_replace({_PATH0}, '/$', '') END"
_QUERY = "regexp_extract(trim(url), '^[^?#]*\\?([^#]*)', 1)"
_KEY = f"(CASE WHEN {_SCHEME} = '' THEN 'https' ELSE {_SCHEME} END || '://' || {_HOST} || {_PATH})"
_WITH_QUERY = f"CASE WHEN {_QUERY} <> '' THEN '?' || {_QUERY} ELSE '' END"
_LOOSE = "regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '#.*$', ''), '/+$', ''), '^http://', 'https://')"

_PARTS = {
    "path": "(CASE WHEN regexp_matches(lower(url), '^[a-z][a-z0-9+.-]*://') THEN trim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') ELSE '' END)",
    "query": "regexp_extract(lower(coalesce(url, '')), '^[^?#]*\\?([^#]*)', 1)",
}
_PARTS["page"] = f"({_PARTS['path']} || '?' || {_PARTS['query']})"
_SHAPED = " OR ".join(f"(regexp_matches({_PARTS[p]}, '{look}')" + (f" AND NOT regexp_matches({_PARTS[p]}, '{unless}'))" if unless else ")") for p, look, unless in pages.LISTING_SHAPES)
_NAMED = "lower(trim(coalesce(title, ''))) IN (" + ", ".join(f"'{t}'" for t in pages.LISTING_TITLES) + ") OR " + " OR ".join(f"contains(lower(coalesce(url, '')), '{x}')" for x in pages.LISTING_PATHS)
_DATES = f"len(regexp_extract_all(t, '{pages.DATE_IN_TEXT}'))"

ORACLE = {
    "store_drop_reasons": f"""WITH r AS (SELECT DISTINCT id, url, title, trim(coalesce(content, ''), ' ') AS t FROM articles),
f AS (SELECT DISTINCT id, {_KEY} AS k, substr(sha256(regexp_replace(lower(trim(t, ' ')), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), 1, 16) AS h, ({_NAMED} OR {_SHAPED}) AS listing,
  ({_DATES} >= 8 OR (len(list_filter(regexp_split_to_array(t, '\\r\\n|\\r|\\n'), lambda x: trim(x, ' ') <> '')) >= 25 AND {_DATES} >= 4)) AS list_text, length(t) < 250 AS short FROM r),
m AS (SELECT *, min(id) OVER (PARTITION BY k, h) AS first_id FROM f)
SELECT CASE WHEN listing THEN 'listing page' WHEN list_text THEN 'listing content' WHEN short THEN 'short' WHEN id <> first_id THEN 'repeat' ELSE 'kept' END AS reason, count(*) AS n FROM m GROUP BY 1""",
    "store_source_health": f"WITH {_HEALTH} SELECT * FROM health",
    "store_intake": f"""WITH c AS ({_count("discovered", "discovered_urls", "discovered_at")} UNION ALL {_count("extracted", "articles", "extracted_at")}
  UNION ALL {_count("failed", "crawl_errors", "created_at", "AND url IS NOT NULL")}),
s AS (SELECT source_id, coalesce(sum(n) FILTER (what = 'discovered'), 0)::BIGINT AS discovered, coalesce(sum(n) FILTER (what = 'extracted'), 0)::BIGINT AS extracted,
  coalesce(sum(n) FILTER (what = 'failed'), 0)::BIGINT AS failed FROM c GROUP BY 1)
SELECT *, greatest(0, discovered - extracted) AS remaining FROM s""",
    "store_review_sources": """SELECT source_id, coalesce(best_strategy IN ('manual_review','metadata_only') OR html_status_code >= 400 OR error_message IS NOT NULL, false) AS strict
FROM source_profiles WHERE best_strategy IN ('manual_review','metadata_only') OR captcha_detected OR login_detected OR paywall_detected OR html_status_code >= 400 OR error_message IS NOT NULL""",
    "store_error_counts": "SELECT source_id, error_type, count(*) AS n, count(DISTINCT url) AS urls FROM crawl_errors GROUP BY 1, 2",
    "store_totals": """SELECT count(*) AS rows, count(DISTINCT content_hash) AS texts, round(coalesce(avg(content_length), 0), 4) AS mean_length, coalesce(min(content_length), 0) AS least,
  coalesce(max(content_length), 0) AS most, count(*) FILTER (length(trim(content, ' ')) > 200) AS with_body FROM articles""",
    "store_error_types_rollup": "SELECT stage, error_type, CAST(grouping(stage, error_type) AS BIGINT) AS level, count(*) AS n FROM crawl_errors GROUP BY ROLLUP (stage, error_type)",
    "store_top_errors": """WITH c AS (SELECT source_id, error_type, count(*) AS n FROM crawl_errors WHERE source_id IS NOT NULL AND error_type IS NOT NULL GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n DESC, error_type) AS r FROM c)
SELECT source_id, string_agg(error_type || ':' || n, ', ' ORDER BY r) AS labels FROM t WHERE r <= 4 GROUP BY 1""",
    "store_status_counts": f"""SELECT status, count(p.source_id) AS n FROM (SELECT unnest([{", ".join(f"'{s}'" for s in STATUSES)}]) AS status) LEFT JOIN source_profiles p USING (status) GROUP BY 1""",
    "store_active_health": f"""WITH {_HEALTH}, act AS (SELECT source_id FROM articles WHERE extracted_at {_IN[0]} AND extracted_at {_IN[1]} UNION SELECT source_id FROM discovered_urls WHERE discovered_at {_IN[0]} AND discovered_at {_IN[1]}),
many AS (SELECT source_id FROM crawl_errors GROUP BY 1 HAVING count(*) >= 100)
SELECT source_id, articles, errors FROM health SEMI JOIN act USING (source_id) ANTI JOIN many USING (source_id)""",
    "store_lanes": """SELECT source_id, CASE WHEN best_strategy = 'rss' AND rss_valid_count > 0 THEN 'rss' WHEN best_strategy = 'sitemap' AND has_sitemap THEN 'sitemap'
  WHEN html_extract_ok AND coalesce(robots_can_fetch_homepage, true) THEN 'html' ELSE 'none' END AS lane,
  CAST(CASE WHEN json_valid(rss_urls) THEN coalesce(json_array_length(rss_urls), 0) ELSE 0 END AS INTEGER) AS feeds FROM source_profiles""",
    "store_coverage": """WITH a AS (SELECT source_id, count(DISTINCT id) AS articles FROM articles GROUP BY 1), c AS (SELECT source_id, error_type, count(*) AS n FROM crawl_errors WHERE source_id IS NOT NULL AND error_type IS NOT NULL GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY n DESC, error_type) AS r FROM c), l AS (SELECT source_id, string_agg(error_type || ':' || n, ', ' ORDER BY r) AS labels FROM t WHERE r <= 4 GROUP BY 1)
SELECT source_id, status, coalesce(articles, 0) AS articles, labels FROM source_profiles LEFT JOIN a USING (source_id) LEFT JOIN l USING (source_id)""",
    "store_allowed_domains": """WITH al AS (SELECT DISTINCT CASE WHEN domain LIKE '%.test' THEN domain ELSE 'co.example' END AS allowed FROM source_profiles WHERE domain LIKE '%co.example' OR domain LIKE '%.test')
SELECT source_id, domain, max_by(allowed, length(allowed)) AS matched_domain FROM source_profiles JOIN al ON domain = allowed OR domain LIKE '%.' || allowed GROUP BY 1, 2""",
    "store_method_overlap": """WITH s AS (SELECT DISTINCT discovery_method AS m, url FROM discovered_urls WHERE discovery_method IS NOT NULL AND url IS NOT NULL)
SELECT x.m AS a, y.m AS b, count(*) AS n FROM s x JOIN s y USING (url) WHERE x.m < y.m GROUP BY 1, 2""",
    "store_existing_overlap": f"""WITH d AS (SELECT DISTINCT discovery_method, {_KEY} AS k FROM discovered_urls), a AS (SELECT {_KEY} AS k FROM articles)
SELECT discovery_method, count(*) AS n FROM d SEMI JOIN a USING (k) GROUP BY 1""",
    "store_alias_index": f"""WITH k AS (SELECT id, unnest([{_KEY}, {_KEY} || {_WITH_QUERY}, {_LOOSE}]) AS key FROM articles WHERE url IS NOT NULL) SELECT key, min(id) AS id FROM k GROUP BY 1""",
    "store_url_keys": f"""WITH d AS (SELECT DISTINCT id, url FROM discovered_urls)
SELECT id, {_HOST} AS host, {_KEY} AS page_key, {_KEY} || {_WITH_QUERY} AS page_query_key,
  CASE WHEN {_SCHEME} = '' THEN '' ELSE {_SCHEME} || '://' || {_HOST} || regexp_replace({_PATH}, '/{{2,}}', '/', 'g') || {_WITH_QUERY} END AS squeezed_key, {_LOOSE} AS loose_key,
  regexp_replace({_HOST}, '[^a-z0-9]+', '_', 'g') AS made_source_id,
  contains(lower(url), '2025-09-20') OR contains(lower(url), '2025/09/20') OR contains(lower(url), '2025-09-19') OR contains(lower(url), '2025/09/19')
  OR regexp_extract(lower(url), '/(\\d{{4}})/(\\d{{1,2}})(?:/|$)', 1) || '-' || lpad(regexp_extract(lower(url), '/(\\d{{4}})/(\\d{{1,2}})(?:/|$)', 2), 2, '0') = '2025-09' AS recent FROM d""",
    "store_text_cuts": "SELECT doc_id, CAST(greatest(1, length(text) // 4) AS BIGINT) AS tokens, sha256(text) AS digest, substr(sha1(text), 1, 16) AS short_digest FROM documents",
}
