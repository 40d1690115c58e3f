"""Queries that run a stream over the events table to its end and return what it left."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.plans.picks import ORACLE as BATCH
from tidewire.plans.picks import log_of
from tidewire.runtime import shared_dir, table
from tidewire.streaming import flows


#: A stream arrives in so many files, one a micro-batch; rows of every fiftieth event arrive two files late.
FILES = 4


def _run(stream: DataFrame, write, mode: str, place: str) -> None:  # noqa: ANN001
    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def _events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The events as a stream of FILES files, each a stretch of the time but for delayed rows, and a place of its own."""
    place = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    e = table(spark, sf_dir, "events").withColumn("ts", F.to_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z"))))
    lo, hi = (F.unix_micros(F.lit(x)) for x in e.agg(F.min("ts"), F.max("ts")).first())
    part = F.floor((F.unix_micros("ts") - lo) * FILES / (hi - lo + 1))
    delayed = F.when(F.col("event_id") % 50 == 0, 2).otherwise(0)
    e = e.withColumn("_file", F.least(part + delayed, F.lit(FILES - 1)))
    for k in range(FILES):  # one after the other, so that their times of writing tell their order
        e.filter(F.col("_file") == k).drop("_file").coalesce(1).write.mode("append").parquet(f"{place}/in.parquet")
    schema = e.drop("_file").schema
    return flows.table_stream(spark, place, "in", schema, files_per_trigger=1), place


def _day(at: str) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(at) / 86400).cast("int")).cast("string")  # whatever the session's zone


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts by event type; a window's last update counts, and rows behind the watermark are dropped."""
    events, place = _events(spark, sf_dir)
    _run(flows.windowed_counts(events, "ts", ["event_type"], "1 day", "48 hours"), lambda b, n: b.write.mode("overwrite").parquet(f"{place}/out/batch={n}"), "update", place)
    return spark.read.parquet(f"{place}/out").groupBy(_day("start").alias("day"), "event_type").agg(F.max("n").alias("n"))


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side table of rows that arrived more than 48 hours behind the newest time of the batches before."""
    events, place = _events(spark, sf_dir)
    _run(events.select("event_id", "ts"), flows.late_sink(f"{place}/out", "ts", "48 hours"), "append", place)
    return spark.read.parquet(f"{place}/out/late").select("event_id")


def stream_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, place = _events(spark, sf_dir)
    _run(flows.unseen(events, "ts", ["user_id", "event_type"], "60 days").select("user_id", "event_type"), lambda b, n: b.write.mode("overwrite").parquet(f"{place}/out/batch={n}"), "append", place)
    return spark.read.parquet(f"{place}/out").select("user_id", "event_type")


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, place = _events(spark, sf_dir)
    rows = events.select("user_id", "event_id", "event_type", "ts")
    _run(rows, flows.upsert_sink(f"{place}/out", "user_id", ["ts", "event_id"]), "append", place)
    return flows.upserted_table(spark, f"{place}/out", rows.schema).select("user_id", "event_id", "event_type")


def stream_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL states by the transitions as they arrive; transitions of one URL that arrive late are applied when they come."""
    events, place = _events(spark, sf_dir)
    _run(flows.frontier_states(log_of(events.filter("event_id % 50 <> 0"))), lambda b, n: b.write.mode("overwrite").parquet(f"{place}/out/batch={n}"), "update", place)
    newest = F.max_by(F.struct("url", "source_id", "status", "retry_count", "last_error_type", "content_hash"), "version").alias("r")
    return spark.read.parquet(f"{place}/out").groupBy("url_hash").agg(newest).select("url_hash", "r.*")


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("stream_")}
#: The stream leaves the same states as the batch replay.
_FRONTIER = BATCH["state_frontier"]
_DELIVERED = f"""WITH s AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
e AS (SELECT *, least(CAST(floor((epoch_us(ts) - lo) * {FILES} / (hi - lo + 1)) AS INTEGER) + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END, {FILES - 1}) AS f FROM events, s),
t AS (SELECT f, max(ts) AS top FROM e GROUP BY f),
d AS (SELECT e.*, (SELECT max(top) FROM t WHERE t.f < e.f) - INTERVAL 48 HOURS AS horizon, (SELECT max(top) FROM t WHERE t.f < e.f - 1) - INTERVAL 48 HOURS AS closed FROM e)"""

ORACLE = {
    "stream_frontier": f"SELECT url_hash, url, source_id, status, retry_count, last_error_type, content_hash FROM ({_FRONTIER.replace('FROM events', 'FROM (SELECT * FROM events WHERE event_id % 50 <> 0)')})",
    "stream_windows": f"{_DELIVERED} SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM d WHERE closed IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > closed GROUP BY 1, 2",
    "stream_late": f"{_DELIVERED} SELECT event_id FROM d WHERE ts < horizon",
    "stream_unseen": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_latest": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
}
