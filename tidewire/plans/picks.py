"""Queries that select, chunk and replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import urls
from tidewire.operators import selection, state
from tidewire.operators.ranking import distributed_rank
from tidewire.runtime import table

AS_OF = "2025-11-01 00:00:00"
RUNGS = (48, 72, 96, 168)


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").select("id", "source_id", "url", "quality_score", "content_length", "extracted_at", "content_hash")
    return a.groupBy("id").agg(*[F.max(c).alias(c) for c in a.columns if c != "id"])


def pick_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = [F.col("extracted_at").desc(), F.col("id").asc()]
    return selection.round_robin(_articles(spark, sf_dir).filter("source_id IS NOT NULL"), "source_id", newest, 150).select("id", "source_id")


def pick_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return selection.batches(o, [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()], 100)


def pick_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("size"))
    return selection.chunks_by_size(d, [F.col("doc_id").asc()], "size", 20_000)


def pick_per_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _articles(spark, sf_dir)
    return selection.capped_per_key(a, urls.host(F.col("url")), [F.col("extracted_at").desc(), F.col("id").asc()], 3).select("id")


def pick_must_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _articles(spark, sf_dir).filter("source_id IS NOT NULL").withColumn("category", F.concat(F.lit("c"), (F.length("url") % 5).cast("string")))
    order = [F.col("quality_score").desc_nulls_last(), F.col("extracted_at").desc(), F.col("id").asc()]
    return selection.greedy_pick(a, order, 30, "category", {"source_id": 2}, ["c3", "c1"]).select("id", "category", "source_id", "pick")


def pick_rebalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    order = [F.col("value").desc(), F.col("event_id").asc()]
    return selection.rebalanced(e, "event_type", ["purchase", "signup"], {"error": 2, "view": 2}, order, 40)


def pick_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(), F.col("l_linenumber").asc(), F.col("l_partkey").asc()]
    ranked = distributed_rank(li, ["l_returnflag"], order, "place")
    return ranked.select("l_returnflag", "l_extendedprice", "place")


def state_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"))
    new = c.filter("c_custkey % 3 = 0").select((F.col("c_custkey") + 60).alias("c_custkey"), F.concat(F.lit("new "), "c_name").alias("c_name"), F.lit("web").alias("channel"), F.col("c_custkey").alias("seq"))
    old = c.withColumn("seq", F.lit(0).cast("long"))
    return state.upserted(old, new, "c_custkey", ["seq"]).select("c_custkey", "c_name", "c_acctbal", "channel")


def log_of(e: DataFrame) -> DataFrame:
    """Events as transitions of a crawl frontier, with the user as the URL."""
    action = F.when(F.col("event_type").isin("signup", "view"), "upsert").when(F.col("event_type") == "purchase", "crawled").when(F.col("event_type") == "error", "failed").otherwise("skipped")
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url_hash"),
        F.concat(F.lit("https://site.example/"), F.col("user_id").cast("string")).alias("url"),
        (F.col("user_id") % 7).cast("string").alias("source_id"),
        action.alias("action"),
        F.when(action.isin("failed", "skipped"), F.concat(F.lit("E"), (F.col("event_id") % 5).cast("string"))).alias("error_type"),
        F.when((action == "crawled") & (F.col("event_id") % 2 == 0), F.concat(F.lit("h"), F.col("event_id").cast("string"))).alias("content_hash"),
        F.when((action == "upsert") & (F.col("event_id") % 3 == 0), F.col("ts")).alias("next_crawl_at"),
        "ts",
        F.col("event_id").alias("seq"),
    )


def state_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.replayed_frontier(log_of(table(spark, sf_dir, "events")))


def state_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _articles(spark, sf_dir)
    again = a.filter("content_length > 3000").select("content_hash")
    return state.touched(a, again, F.lit(AS_OF).cast("timestamp_ntz")).select("id", "extracted_at")


def state_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "source_profiles").filter("status = 'active'").select("source_id")
    return state.kept_by_ids(table(spark, sf_dir, "crawl_errors").select("id", "source_id"), "source_id", p)


def state_kept_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "source_profiles").filter("status = 'nothing'").select("source_id")
    return state.kept_by_ids(table(spark, sf_dir, "crawl_errors").select("id", "source_id"), "source_id", p)


def state_purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three local days, by the day of discovery in Asia/Ho_Chi_Minh."""
    d = table(spark, sf_dir, "discovered_urls").select("id", "discovered_at").distinct()
    day = F.date_format(F.col("discovered_at") + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd")
    return state.purged_by_day(d.withColumn("day", day), F.col("day"), ["2025-09-18", "2025-09-19", "2025-09-20"])


def state_window_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles").filter(F.coalesce("content_length", F.lit(0)) >= 200)
    at = F.lit(AS_OF).cast("timestamp_ntz")
    counts = a.filter(F.col("extracted_at") < at).agg(*[F.count_if(F.col("extracted_at") >= at - F.expr(f"INTERVAL {h} HOURS")).alias(f"h{h}") for h in RUNGS])
    return state.window_ladder(counts, RUNGS, 20)


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith(("pick_", "state_"))}

_ARTS = """arts AS (SELECT id, max(source_id) AS source_id, max(url) AS url, max(quality_score) AS quality_score, max(content_length) AS content_length,
  max(extracted_at) AS extracted_at, max(content_hash) AS content_hash FROM articles GROUP BY id)"""
_LOG = """log AS (SELECT 'u' || user_id AS url_hash, 'https://site.example/' || user_id AS url, CAST(user_id % 7 AS VARCHAR) AS source_id,
  CASE WHEN event_type IN ('signup','view') THEN 'upsert' WHEN event_type = 'purchase' THEN 'crawled' WHEN event_type = 'error' THEN 'failed' ELSE 'skipped' END AS action, event_id, ts FROM events),
l2 AS (SELECT *, CASE WHEN action IN ('failed','skipped') THEN 'E' || event_id % 5 END AS error_type, CASE WHEN action = 'crawled' AND event_id % 2 = 0 THEN 'h' || event_id END AS content_hash,
  CASE WHEN action = 'upsert' AND event_id % 3 = 0 THEN ts END AS next_crawl_at, row_number() OVER (PARTITION BY url_hash ORDER BY ts, event_id) AS n FROM log),
f AS (SELECT url_hash, min(n) AS n0 FROM l2 WHERE action = 'upsert' GROUP BY 1), r AS (SELECT l2.* FROM l2 JOIN f USING (url_hash) WHERE n >= n0)"""
ORACLE = {
    "pick_chunks": """WITH RECURSIVE o AS (SELECT doc_id, n_chars AS size, row_number() OVER (ORDER BY doc_id) AS r FROM documents),
c AS (SELECT doc_id, size, r, 0::BIGINT AS chunk, size AS held FROM o WHERE r = 1
  UNION ALL SELECT o.doc_id, o.size, o.r, chunk + CASE WHEN held + o.size > 20000 THEN 1 ELSE 0 END, CASE WHEN held + o.size > 20000 THEN o.size ELSE held + o.size END FROM c JOIN o ON o.r = c.r + 1)
SELECT doc_id, size, chunk FROM c""",
    "pick_round_robin": f"""WITH {_ARTS}, s AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY extracted_at DESC, id) AS t, count(*) OVER (PARTITION BY source_id) AS n FROM arts WHERE source_id IS NOT NULL)
SELECT id, source_id FROM s ORDER BY t, n DESC, source_id, id LIMIT 150""",
    "pick_batches": "SELECT o_orderkey, o_orderdate, CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 100 AS BIGINT) AS batch FROM orders",
    "pick_per_host": f"""WITH {_ARTS} SELECT id FROM arts QUALIFY row_number() OVER (PARTITION BY regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\\.', '') ORDER BY extracted_at DESC, id) <= 3""",
    "pick_rebalanced": """WITH a AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events),
s AS (SELECT *, CASE WHEN event_type IN ('purchase','signup') AND r = 1 THEN 0 WHEN event_type IN ('error','view') AND r > 2 THEN 2 ELSE 1 END AS seg FROM a),
p AS (SELECT *, row_number() OVER (ORDER BY seg, CASE WHEN seg = 0 AND event_type = 'signup' THEN 1 ELSE 0 END, value DESC, event_id) AS place FROM s)
SELECT event_id, event_type, value, place FROM p WHERE place <= 40""",
    "pick_ranks": "SELECT l_returnflag, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS place FROM lineitem",
    "state_upserted": """WITH n AS (SELECT c_custkey + 60 AS c_custkey, 'new ' || c_name AS c_name, 'web' AS channel FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(n.c_custkey, c.c_custkey) AS c_custkey, coalesce(n.c_name, c.c_name) AS c_name, CASE WHEN n.c_custkey IS NULL THEN round(c.c_acctbal, 2) END AS c_acctbal, n.channel FROM customer c FULL JOIN n USING (c_custkey)""",
    "state_frontier": f"""WITH {_LOG},
g AS (SELECT url_hash, arg_max(url, n) FILTER (action = 'upsert') AS url, arg_max(source_id, n) FILTER (action = 'upsert') AS source_id,
  arg_max(CASE WHEN action = 'upsert' THEN 'pending' ELSE action END, n) AS status, count(*) FILTER (action IN ('failed','skipped')) AS retry_count,
  arg_max(error_type, n) FILTER (action IN ('failed','skipped')) AS e, max(n) FILTER (action IN ('failed','skipped')) AS bad, max(n) FILTER (action = 'crawled') AS cr,
  min(ts) AS first_seen_at, max(ts) AS last_seen_at, max(ts) FILTER (action = 'crawled') AS last_crawled_at,
  arg_max(next_crawl_at, n) FILTER (next_crawl_at IS NOT NULL) AS nx, max(n) FILTER (next_crawl_at IS NOT NULL) AS np, arg_max(content_hash, n) FILTER (content_hash IS NOT NULL) AS content_hash FROM r GROUP BY 1)
SELECT url_hash, url, source_id, status, retry_count, CASE WHEN bad IS NOT NULL AND (cr IS NULL OR bad > cr) THEN e END AS last_error_type, first_seen_at, last_seen_at, last_crawled_at,
  CASE WHEN bad IS NULL OR np > bad THEN nx END AS next_crawl_at, content_hash FROM g""",
    "state_touched": f"""WITH {_ARTS}, h AS (SELECT DISTINCT content_hash FROM arts WHERE content_length > 3000)
SELECT id, CASE WHEN content_hash IN (FROM h) THEN TIMESTAMP '{AS_OF}' ELSE extracted_at END AS extracted_at FROM arts""",
    "state_kept": "SELECT id, source_id FROM crawl_errors WHERE source_id IN (SELECT source_id FROM source_profiles WHERE status = 'active')",
    "state_kept_all": "SELECT id, source_id FROM crawl_errors",
    "state_purged": "SELECT DISTINCT id, discovered_at, strftime(discovered_at + INTERVAL 7 HOURS, '%Y-%m-%d') AS day FROM discovered_urls WHERE strftime(discovered_at + INTERVAL 7 HOURS, '%Y-%m-%d') IN ('2025-09-18', '2025-09-19', '2025-09-20')",
    "state_window_ladder": "WITH c AS (SELECT "
    + ", ".join(f"count(*) FILTER (extracted_at >= TIMESTAMP '{AS_OF}' - INTERVAL {h} HOURS) AS h{h}" for h in RUNGS)
    + f" FROM articles WHERE coalesce(content_length, 0) >= 200 AND extracted_at < TIMESTAMP '{AS_OF}') SELECT CASE "
    + " ".join(f"WHEN h{h} >= 20 THEN {h}" for h in RUNGS)
    + " END AS hours, CASE "
    + " ".join(f"WHEN h{h} >= 20 THEN h{h}" for h in RUNGS)
    + " END AS n FROM c",
}
