"""Small rollups, orders and checks of daily reports, over events and the crawl store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.functions.rules import first_label
from tidewire.operators import quality
from tidewire.operators.ranking import top_n_per_group
from tidewire.runtime import table

#: Story buckets by what a title holds, the first that fits.
BUCKETS = (("energy", "(?i)power|gas|solar|battery"), ("money", "(?i)bank|capital|bond|dividend"), ("chips", "(?i)chip|cloud|data centre"))


def pulse_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type: the sum of at most six axes, each held to -1..1, and its label."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", ((F.col("value") - 50) / 25).alias("axis"))
    six = top_n_per_group(e, ["event_type"], [F.col("event_id").asc()], 6)
    total = F.round(F.sum(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("axis")))), 6).alias("total")
    out = six.groupBy("event_type").agg(total)
    return out.withColumn("label", F.when(F.col("total") >= 2, "on").when(F.col("total") <= -2, "off").otherwise("mixed"))


def pulse_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that two independent methods found, or an official one and one more."""
    d = table(spark, sf_dir, "discovered_urls").filter("url IS NOT NULL").groupBy("url").agg(
        F.count_distinct(F.when(F.col("discovery_method") != "sitemap", F.concat_ws("|", "source_id", "discovery_method"))).alias("independent"), F.max(F.coalesce(F.col("discovery_method") == "sitemap", F.lit(False))).alias("official")
    )
    return d.select("url", ((F.col("independent") >= 2) | (F.col("official") & (F.col("independent") >= 1))).alias("hot"))


def pulse_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by stage and type with the totals of each stage and of all, in one rollup."""
    e = table(spark, sf_dir, "crawl_errors").filter("stage IS NOT NULL AND error_type IS NOT NULL")
    out = e.rollup("stage", "error_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.coalesce("stage", F.lit("(all)")).alias("stage"), F.coalesce("error_type", F.lit("(all)")).alias("error_type"), "n")


def pulse_top_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "crawl_errors").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    return e.orderBy(F.desc("n"), F.col("source_id").asc_nulls_last()).limit(10)


def pulse_adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of stages with a prefix, by what follows it."""
    e = table(spark, sf_dir, "crawl_errors").filter(F.col("stage").startswith("ex"))
    return e.groupBy(F.expr("substring(stage, 3)").alias("adapter")).agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("newest"))


def pulse_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 220 first articles by four keys, all descending, with their place from 0."""
    a = table(spark, sf_dir, "articles").groupBy("id").agg(F.max("quality_score").alias("q"), F.max("content_length").alias("n"), F.max("extracted_at").alias("x"))
    keys = [F.col("q").desc_nulls_last(), F.col("n").desc_nulls_last(), F.col("x").desc(), F.col("id").desc()]
    top = a.orderBy(*keys).limit(220)  # bounded, so the place may be taken in one window
    return top.select("id", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*keys)) - 1).alias("place"))


def pulse_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four hosts for each title word count, the better tier first, one address a host."""
    a = table(spark, sf_dir, "articles").filter("title IS NOT NULL AND url IS NOT NULL").select(F.size(F.split("title", " ")).alias("k"), "url", urls.host(F.col("url")).alias("host")).distinct()
    tier = F.when(F.col("host").endswith("co.example"), 0).when(F.col("host").endswith(".test"), 1).otherwise(2)
    once = top_n_per_group(a.withColumn("tier", tier), ["k", "host"], [F.col("url").asc()], 1)
    return top_n_per_group(once, ["k"], [F.col("tier").asc(), F.col("host").asc()], 4)


def pulse_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of diagnostics: rows, rows with a body in three windows, the newest extraction and whether it is stale."""
    a, at = table(spark, sf_dir, "articles"), F.lit("2026-05-01 00:00:00").cast("timestamp_ntz")
    body = F.coalesce("content_length", F.lit(0)) >= 200
    within = lambda h: F.count_if(body & (F.col("extracted_at") >= at - F.expr(f"INTERVAL {h} HOURS"))).alias(f"h{h}")
    stale = (F.max("extracted_at").isNull() | (F.max("extracted_at") < at - F.expr("INTERVAL 6 HOURS"))).alias("stale")
    return a.agg(F.count(F.lit(1)).alias("rows"), within(48), within(168), within(8760), F.max("extracted_at").alias("newest"), stale)


def pulse_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling store of seven days: per address the last row wins, 500 at most by method and title."""
    at = F.lit("2025-10-15 00:00:00").cast("timestamp_ntz")
    d = table(spark, sf_dir, "discovered_urls").filter((F.col("discovered_at") >= at - F.expr("INTERVAL 7 DAYS")) & (F.col("discovered_at") < at) & F.col("url").isNotNull())
    last = top_n_per_group(d.select("id", "url", "discovery_method", "title", "discovered_at").distinct(), ["url"], [F.col("discovered_at").desc(), F.col("id").desc()], 1)
    return last.orderBy(F.col("discovery_method").asc_nulls_first(), F.col("title").asc_nulls_first(), "url").limit(500).select("url", "id")


def pulse_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent languages and their counts as one line."""
    c = table(spark, sf_dir, "documents").groupBy(F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    top = c.orderBy(F.desc("n"), "lang").limit(3)
    item = F.struct((-F.col("n")).alias("k"), F.col("lang").alias("l"))
    return top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.concat(x["l"], F.lit(" "), (-x["k"]).cast("string"))), ", ").alias("line"))


def pulse_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").select("id", "title").distinct()
    bucket = first_label([(F.col("title").rlike(p), name) for name, p in BUCKETS], "other")
    return a.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def pulse_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with which article: rules of one row, repeated titles, unknown sources; and sources with too little."""
    a = table(spark, sf_dir, "articles").groupBy("id").agg(*[F.max(c).alias(c) for c in ("source_id", "url", "title", "content", "quality_score")])
    rules = [
        quality.Rule("address", F.col("url").rlike("^https?://"), strict=True),
        quality.Rule("title", F.length(F.trim("title")).between(10, 120), strict=True),
        quality.Rule("body", F.length("content") >= 200, strict=True),
        quality.Rule("score", F.col("quality_score").between(0, 1)),
    ]
    out = quality.violations(a, "id", rules)
    out = out.unionByName(quality.repeated_values(a, "id", F.lower("title"), "title repeated"))
    out = out.unionByName(quality.unknown_values(a, "id", F.col("source_id"), table(spark, sf_dir, "source_profiles").select("source_id"), "unknown source"))
    thin = quality.thin_groups(a.filter(F.length("content") >= 200), "source_id", table(spark, sf_dir, "source_profiles").select("source_id"), 3)
    return out.unionByName(thin.select(F.col("source_id").alias("id"), F.lit("thin source").alias("rule"))).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("pulse_")}

_HOST = "regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
_WHEN = " ".join(f"WHEN regexp_matches(title, '{p}') THEN '{name}'" for name, p in BUCKETS)
ORACLE = {
    "pulse_regime": """WITH s AS (SELECT event_type, (value - 50) / 25 AS axis FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 6), t AS (SELECT event_type, round(sum(greatest(-1.0, least(1.0, axis))), 6) AS total FROM s GROUP BY 1)
SELECT *, CASE WHEN total >= 2 THEN 'on' WHEN total <= -2 THEN 'off' ELSE 'mixed' END AS label FROM t""",
    "pulse_hot": """WITH d AS (SELECT url, count(DISTINCT CASE WHEN discovery_method <> 'sitemap' THEN concat_ws('|', source_id, discovery_method) END) AS i, bool_or(coalesce(discovery_method = 'sitemap', false)) AS o FROM discovered_urls WHERE url IS NOT NULL GROUP BY url)
SELECT url, i >= 2 OR (o AND i >= 1) AS hot FROM d""",
    "pulse_totals": "SELECT coalesce(stage, '(all)') AS stage, coalesce(error_type, '(all)') AS error_type, count(*) AS n FROM crawl_errors WHERE stage IS NOT NULL AND error_type IS NOT NULL GROUP BY ROLLUP (stage, error_type)",
    "pulse_top_types": "SELECT source_id, count(*) AS n FROM crawl_errors GROUP BY 1 ORDER BY n DESC, source_id NULLS LAST LIMIT 10",
    "pulse_adapters": "SELECT substr(stage, 3) AS adapter, count(*) AS n, max(created_at) AS newest FROM crawl_errors WHERE stage LIKE 'ex%' GROUP BY 1",
    "pulse_order": """WITH a AS (SELECT id, max(quality_score) AS q, max(content_length) AS n, max(extracted_at) AS x FROM articles GROUP BY id)
SELECT id, row_number() OVER (ORDER BY q DESC NULLS LAST, n DESC NULLS LAST, x DESC, id DESC) - 1 AS place FROM a QUALIFY place < 220""",
    "pulse_sources": f"""WITH a AS (SELECT DISTINCT len(string_split(title, ' '))::INTEGER AS k, url, {_HOST} AS host FROM articles WHERE title IS NOT NULL AND url IS NOT NULL),
o AS (SELECT *, CASE WHEN host LIKE '%co.example' THEN 0 WHEN host LIKE '%.test' THEN 1 ELSE 2 END AS tier FROM a QUALIFY row_number() OVER (PARTITION BY k, host ORDER BY url) = 1) SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY k ORDER BY tier, host) <= 4""",
    "pulse_window": """WITH a AS (SELECT *, TIMESTAMP '2026-05-01' AS at_, coalesce(content_length, 0) >= 200 AS b FROM articles) SELECT count(*) AS rows, count(*) FILTER (b AND extracted_at >= at_ - INTERVAL 48 HOURS) AS h48,
count(*) FILTER (b AND extracted_at >= at_ - INTERVAL 168 HOURS) AS h168, count(*) FILTER (b AND extracted_at >= at_ - INTERVAL 8760 HOURS) AS h8760, max(extracted_at) AS newest, coalesce(max(extracted_at) < TIMESTAMP '2026-04-30 18:00:00', true) AS stale FROM a""",
    "pulse_rolling": """WITH d AS (SELECT DISTINCT id, url, discovery_method, title, discovered_at FROM discovered_urls WHERE url IS NOT NULL AND discovered_at >= TIMESTAMP '2025-10-08' AND discovered_at < TIMESTAMP '2025-10-15'),
l AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY url ORDER BY discovered_at DESC, id DESC) = 1) SELECT url, id FROM l ORDER BY discovery_method NULLS FIRST, title NULLS FIRST, url LIMIT 500""",
    "pulse_mix": "WITH c AS (SELECT coalesce(lang, '?') AS lang, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, lang LIMIT 3) SELECT string_agg(lang || ' ' || n, ', ' ORDER BY n DESC, lang) AS line FROM c",
    "pulse_buckets": f"WITH a AS (SELECT DISTINCT id, title FROM articles) SELECT CASE {_WHEN} ELSE 'other' END AS bucket, count(*) AS n FROM a GROUP BY 1",
    "pulse_checks": """WITH a AS (SELECT id, max(source_id) AS source_id, max(url) AS url, max(title) AS title, max(content) AS content, max(quality_score) AS q FROM articles GROUP BY id),
v AS (SELECT id, 'address' AS rule FROM a WHERE NOT coalesce(regexp_matches(url, '^https?://'), false) UNION ALL SELECT id, 'title' FROM a WHERE NOT coalesce(length(trim(title, ' ')) BETWEEN 10 AND 120, false)
 UNION ALL SELECT id, 'body' FROM a WHERE NOT coalesce(length(content) >= 200, false) UNION ALL SELECT id, 'score' FROM a WHERE NOT coalesce(q BETWEEN 0 AND 1, true)
 UNION ALL SELECT id, 'title repeated' FROM a WHERE lower(title) IN (SELECT lower(title) FROM a WHERE title IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
 UNION ALL SELECT id, 'unknown source' FROM a WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM source_profiles)
 UNION ALL SELECT source_id, 'thin source' FROM source_profiles WHERE coalesce((SELECT count(*) FROM a WHERE a.source_id = source_profiles.source_id AND length(content) >= 200), 0) < 3)
SELECT rule, count(*) AS n FROM v GROUP BY 1""",
}
