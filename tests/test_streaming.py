"""Streams over several micro-batches: restart, late rows, and sinks that write to a file system by its own calls."""

import datetime as dt

from pyspark.sql import functions as F

from tidewire.runtime import listed
from tidewire.streaming import flows

ROWS = "k long, v string, ts timestamp"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def batch(spark, rows, path):
    at = [(k, v, T0 + dt.timedelta(hours=h)) for k, v, h in rows]
    spark.createDataFrame(at, ROWS).coalesce(1).write.mode("append").parquet(path)


def drain(spark, stream, write, place):
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{place}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_upsert_over_batches_and_restart(spark, tmp_path):
    place = f"file://{tmp_path}"  # a URI, as on a cluster
    source = f"{place}/in.parquet"
    batch(spark, [(1, "a", 0), (2, "b", 0)], source)
    batch(spark, [(1, "c", 1)], source)
    batch(spark, [(3, "d", 2), (2, "old", -5)], source)
    schema = spark.read.parquet(source).schema
    stream = flows.table_stream(spark, place, "in", schema, files_per_trigger=1)
    sink = flows.upsert_sink(f"{place}/out", "k", ["ts"], buckets=4)
    drain(spark, stream, sink, place)
    assert len(listed(spark, f"{place}/out")) == 3
    want = {1: "c", 2: "old", 3: "d"}  # a later batch replaces, whatever its time
    assert {r.k: r.v for r in flows.upserted_table(spark, f"{place}/out", schema).collect()} == want
    # started again: nothing new, then one more batch
    drain(spark, flows.table_stream(spark, place, "in", schema, files_per_trigger=1), sink, place)
    assert len(listed(spark, f"{place}/out")) == 3
    batch(spark, [(1, "e", 9), (4, "f", 9)], source)
    drain(spark, flows.table_stream(spark, place, "in", schema, files_per_trigger=1), sink, place)
    want |= {1: "e", 4: "f"}
    assert {r.k: r.v for r in flows.upserted_table(spark, f"{place}/out", schema).collect()} == want
    # a batch that is run again leaves the same table
    sink(spark.createDataFrame([(1, "e", T0), (4, "f", T0)], ROWS), 3)
    assert {r.k: r.v for r in flows.upserted_table(spark, f"{place}/out", schema).collect()} == want
    flows.drop_superseded(spark, f"{place}/out", keep=1)
    assert {r.k: r.v for r in flows.upserted_table(spark, f"{place}/out", schema).collect()} == want


def test_late_rows_go_aside(spark, tmp_path):
    place = f"file://{tmp_path}"
    source = f"{place}/in.parquet"
    batch(spark, [(1, "a", 0), (2, "b", 100)], source)
    batch(spark, [(3, "late", 40), (4, "in time", 60), (5, "new", 130)], source)
    batch(spark, [(6, "late", 60), (7, "in time", 90), (8, "none", 0)], source)
    schema = spark.read.parquet(source).schema
    stream = flows.table_stream(spark, place, "in", schema, files_per_trigger=1).withColumn("ts", F.when(F.col("v") != "none", F.col("ts")))
    drain(spark, stream, flows.late_sink(f"{place}/out", "ts", "48 hours"), place)
    read = lambda name: {r.k for r in spark.read.parquet(f"{place}/out/{name}").collect()}
    assert read("good") == {1, 2, 4, 5, 7} and read("late") == {3, 6, 8}


def test_state_over_batches(spark, tmp_path):
    place = f"file://{tmp_path}"
    cols = "url_hash string, url string, source_id string, action string, error_type string, content_hash string, next_crawl_at timestamp, ts timestamp, seq long"
    steps = [[("u", "upsert", None), ("w", "failed", "E")], [("u", "failed", "E1"), ("u", "failed", "E2")], [("u", "crawled", None), ("w", "upsert", None)]]
    for n, part in enumerate(steps):
        rows = [(h, h, "s", a, e, None, None, T0 + dt.timedelta(hours=n), i) for i, (h, a, e) in enumerate(part)]
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(f"{place}/in.parquet")
    stream = flows.table_stream(spark, place, "in", spark.read.parquet(f"{place}/in.parquet").schema, files_per_trigger=1)
    q = flows.frontier_states(stream).writeStream.outputMode("update").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{place}/out/n={n}"))
    q.option("checkpointLocation", f"{place}/cp").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{place}/out").orderBy("n").collect()
    assert [(r.url_hash, r.status, r.retry_count, r.version) for r in rows if r.url_hash == "u"] == [("u", "pending", 0, 1), ("u", "failed", 2, 3), ("u", "crawled", 2, 4)]
    assert [(r.status, r.retry_count) for r in rows if r.url_hash == "w"] == [("pending", 0)]  # what came before its first upsert is ignored
