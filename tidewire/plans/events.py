"""Queries over hot events: the star-schema tables, seen as events (orders), mentions (lineitem) and knowledge (part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.arrays import clean_entities
from tidewire.functions.rules import bins, first_label, flags, hint_text, signals, weighted
from tidewire.operators import events as ev
from tidewire.runtime import staged, table

SINCE = "1998-12-01 00:00:00"
ENTITIES = "MACHINERY|SITE1[0-9]"
BLOCKED = r"(m3\.example|m7\.example)"
SIGNALS = {"is_ring": r"\bRING\b|BOLT", "is_widget": r"WIDGET", "is_economy": r"ECONOMY|PROMO"}

VIEWS = """hot_events AS (SELECT o_orderkey AS event_id, c_name AS actor1, c_mktsegment AS actor2,
  CAST(o_orderkey % 20 + 1 AS VARCHAR) AS root_code, CAST(floor(o_totalprice / 4000) AS BIGINT) AS num_articles,
  (o_orderkey * 37) % 2001 - 1000 AS tone100, 'https://site' || CAST(o_orderkey % 97 AS VARCHAR) || '.example/e/' || CAST(o_orderkey AS VARCHAR) AS source_url,
  o_orderdate AS added FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1998-12-01 00:00:00'),
mentions AS (SELECT l_orderkey AS event_id, 'https://m' || CAST(l_partkey % 50 AS VARCHAR) || '.example/p/' || CAST(l_partkey AS VARCHAR) AS url,
  'supplier ' || CAST(l_suppkey AS VARCHAR) AS source_name, l_shipdate AS mention_time FROM lineitem),
knowledge AS (SELECT 'https://m' || CAST(p_partkey % 50 AS VARCHAR) || '.example/p/' || CAST(p_partkey AS VARCHAR) AS document,
  upper(p_type || ';' || p_name) AS themes, p_brand || ',' || CAST(p_size AS VARCHAR) || ';' || p_brand AS orgs FROM part)"""


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(SINCE).cast("timestamp_ntz"))
    joined = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        key.alias("event_id"),
        F.col("c_name").alias("actor1"),
        F.col("c_mktsegment").alias("actor2"),
        (key % 20 + 1).cast("string").alias("root_code"),
        F.floor(F.col("o_totalprice") / 4000).alias("num_articles"),
        ((key * 37) % 2001 - 1000).alias("tone100"),
        F.concat(F.lit("https://site"), (key % 97).cast("string"), F.lit(".example/e/"), key.cast("string")).alias("source_url"),
        F.col("o_orderdate").alias("added"),
    )


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        F.concat(F.lit("https://m"), (part % 50).cast("string"), F.lit(".example/p/"), part.cast("string")).alias("url"),
        F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("source_name"),
        F.col("l_shipdate").alias("mention_time"),
    )


def knowledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("https://m"), (part % 50).cast("string"), F.lit(".example/p/"), part.cast("string")).alias("document"),
        F.upper(F.concat("p_type", F.lit(";"), "p_name")).alias("themes"),
        F.concat("p_brand", F.lit(","), F.col("p_size").cast("string"), F.lit(";"), "p_brand").alias("orgs"),
    )


def _pools() -> list[ev.Pool]:
    n, strong = F.col("num_articles"), F.abs("tone100") >= 400
    named = hint_text(F.col("actor1"), F.col("actor2"), F.col("source_url")).rlike(ENTITIES)
    return [
        ev.Pool("extreme", (n >= 40) & strong, 1, 75),
        ev.Pool("entity", (n >= 30) & named, 2, 65),
        ev.Pool("coverage", n >= 70, 3, 65),
    ]


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top events, staged: at most 180 rows that the later steps join several times."""
    return staged(ev.top_events(hot_events(spark, sf_dir), _pools(), 180), "top_events")


def events_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir).select("event_id", "pool", "num_articles", "tone100", "source_url")


def events_with_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _top(spark, sf_dir)
    rows = ev.event_sources(top, ev.latest_mentions(mentions(spark, sf_dir), top, BLOCKED))
    return rows.select("event_id", "num_articles", "source_count", F.array_join("source_urls", "|").alias("source_urls"), F.array_join("mention_sources", "|").alias("mention_sources"))


def events_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _top(spark, sf_dir)
    return ev.event_documents(top, ev.latest_mentions(mentions(spark, sf_dir), top, BLOCKED)).select("event_id", "url", "is_primary")


def events_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = _top(spark, sf_dir)
    docs = ev.event_documents(top, ev.latest_mentions(mentions(spark, sf_dir), top, BLOCKED))
    known = ev.knowledge_of_events(docs, knowledge(spark, sf_dir), ["themes", "orgs"])
    base = top.join(known, "event_id", "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("themes", "orgs")})
    base = base.withColumns(signals(F.upper("themes"), SIGNALS))
    names = [(F.col(s), s[3:]) for s in SIGNALS]
    score = weighted([(F.col("is_ring"), 3), (F.col("is_widget"), 2), (F.col("is_economy"), 1), (F.abs("tone100") >= 800, -2)])
    return base.select(
        "event_id",
        "themes",
        F.regexp_replace("orgs", r",?\d+", "").alias("orgs"),
        F.array_join(clean_entities(F.col("orgs"), 3), "|").alias("top_orgs"),
        first_label(names, "other").alias("primary_label"),
        F.array_join(flags(names), "|").alias("flags"),
        score.alias("score"),
        bins(F.col("tone100"), [(-500, "very negative"), (-100, "negative"), (100, "neutral"), (500, "positive")], "very positive").alias("mood"),
    ).filter("score >= 1")


def events_limited_then_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = hot_events(spark, sf_dir).withColumn("source_url", F.concat(F.lit("https://m"), (F.col("event_id") % 50).cast("string"), F.lit(".example/p/"), F.col("event_id").cast("string")))
    twice = knowledge(spark, sf_dir)
    twice = twice.unionByName(twice.filter("length(themes) > 20"))
    order = [F.col("num_articles").desc(), F.abs("tone100").desc(), F.col("event_id").asc(), F.col("themes").asc_nulls_last()]
    return ev.limited_then_distinct(own, twice, order, 80).select("event_id", "num_articles", "themes")


QUERIES = {
    "events_top": events_top,
    "events_with_sources": events_with_sources,
    "events_documents": events_documents,
    "events_classified": events_classified,
    "events_limited_then_distinct": events_limited_then_distinct,
}

_TOP = f"""WITH {VIEWS},
pooled AS (SELECT *, CASE WHEN num_articles >= 40 AND abs(tone100) >= 400 THEN 'extreme'
  WHEN num_articles >= 30 AND regexp_matches(upper(coalesce(actor1,'') || ' ' || coalesce(actor2,'') || ' ' || coalesce(source_url,'')), '{ENTITIES}') THEN 'entity'
  WHEN num_articles >= 70 THEN 'coverage' END AS pool FROM hot_events WHERE source_url LIKE 'http%'),
prio AS (SELECT *, CASE pool WHEN 'extreme' THEN 1 WHEN 'entity' THEN 2 ELSE 3 END AS p FROM pooled WHERE pool IS NOT NULL),
one AS (SELECT * FROM prio QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY p, num_articles DESC, abs(tone100) DESC) = 1),
quota AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY pool ORDER BY num_articles DESC, abs(tone100) DESC, event_id) <= CASE pool WHEN 'extreme' THEN 75 ELSE 65 END),
top AS (SELECT * FROM quota ORDER BY p, num_articles DESC, abs(tone100) DESC, event_id LIMIT 180)"""
_MENTIONS = rf"""{_TOP}, near AS (SELECT m.* FROM mentions m SEMI JOIN top USING (event_id) WHERE NOT regexp_matches(lower(url), '{BLOCKED}')),
latest AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY event_id, url ORDER BY mention_time DESC, source_name) = 1)"""
_DOCS = f"""{_MENTIONS}, alldocs AS (SELECT event_id, source_url AS url, added AS doc_time, 1 AS is_primary FROM top UNION SELECT event_id, url, mention_time, 0 FROM latest),
docs AS (SELECT * FROM alldocs QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY is_primary DESC, doc_time DESC, url) <= 12)"""

ORACLE = {
    "events_top": f"{_TOP} SELECT event_id, pool, num_articles, tone100, source_url FROM top",
    "events_with_sources": f"""{_MENTIONS},
agg AS (SELECT event_id, array_to_string(list_slice(list(url ORDER BY mention_time DESC, url), 1, 20), '|') AS urls,
  array_to_string(list_slice(list_sort(list_distinct(list(source_name))), 1, 10), '|') AS names, count(DISTINCT url) AS n FROM latest GROUP BY event_id)
SELECT event_id, num_articles, coalesce(n, 1) AS source_count, coalesce(urls, source_url) AS source_urls, coalesce(names, '') AS mention_sources FROM top LEFT JOIN agg USING (event_id)""",
    "events_documents": f"{_DOCS} SELECT event_id, url, is_primary FROM docs",
    "events_classified": rf"""{_DOCS},
known AS (SELECT event_id, array_to_string(list_slice(list_sort(list_distinct(list(themes))), 1, 50), ';') AS themes, array_to_string(list_slice(list_sort(list_distinct(list(orgs))), 1, 50), ';') AS orgs
  FROM docs JOIN knowledge ON url = document GROUP BY event_id),
base AS (SELECT top.*, coalesce(themes, '') AS th, coalesce(orgs, '') AS og FROM top LEFT JOIN known USING (event_id)),
sig AS (SELECT *, regexp_matches(th, '{SIGNALS["is_ring"]}') AS r, regexp_matches(th, '{SIGNALS["is_widget"]}') AS w, regexp_matches(th, '{SIGNALS["is_economy"]}') AS e,
  regexp_replace(og, ',?\d+', '', 'g') AS o2 FROM base),
scored AS (SELECT *, CASE WHEN r THEN 3 ELSE 0 END + CASE WHEN w THEN 2 ELSE 0 END + CASE WHEN e THEN 1 ELSE 0 END - CASE WHEN abs(tone100) >= 800 THEN 2 ELSE 0 END AS score,
  list_filter(string_split(o2, ';'), lambda x: x <> '') AS parts FROM sig)
SELECT event_id, th AS themes, o2 AS orgs,
  array_to_string(list_slice(list_filter(parts, lambda x, i: list_position(parts, x) = i), 1, 3), '|') AS top_orgs,
  CASE WHEN r THEN 'ring' WHEN w THEN 'widget' WHEN e THEN 'economy' ELSE 'other' END AS primary_label,
  array_to_string(list_filter([CASE WHEN r THEN 'ring' END, CASE WHEN w THEN 'widget' END, CASE WHEN e THEN 'economy' END], lambda x: x IS NOT NULL), '|') AS flags, score,
  CASE WHEN tone100 <= -500 THEN 'very negative' WHEN tone100 <= -100 THEN 'negative' WHEN tone100 <= 100 THEN 'neutral' WHEN tone100 <= 500 THEN 'positive' ELSE 'very positive' END AS mood
FROM scored WHERE score >= 1""",
    "events_limited_then_distinct": f"""WITH {VIEWS},
own AS (SELECT * REPLACE ('https://m' || CAST(event_id % 50 AS VARCHAR) || '.example/p/' || CAST(event_id AS VARCHAR) AS source_url) FROM hot_events),
twice AS (SELECT * FROM knowledge UNION ALL SELECT * FROM knowledge WHERE length(themes) > 20),
lim AS (SELECT event_id, num_articles, tone100, themes FROM own LEFT JOIN twice ON source_url = document ORDER BY num_articles DESC, abs(tone100) DESC, event_id, themes NULLS LAST LIMIT 80)
SELECT DISTINCT event_id, num_articles, themes FROM lim""",
}
