import time

import pytest
from pyspark.sql import functions as F

from tidewire import jobs
from tidewire.runtime import table
from tidewire.sources import files


def test_bounds(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey")
    size = jobs.bounded(df, lambda d: d.count(), dry_run=True)["bytes"]
    assert size > 0 and jobs.bounded(df, lambda d: d.count(), most_bytes=size, seconds=60) == {"bytes": size, "result": df.count(), "ended": True}
    with pytest.raises(jobs.TooMuch):
        jobs.bounded(df, lambda d: d.count(), most_bytes=1)
    with pytest.raises(ZeroDivisionError):
        jobs.bounded(df, lambda d: 1 / 0)


def test_time_runs_out(spark):
    slow = spark.range(4).mapInPandas(lambda bs: (time.sleep(60) or b for b in bs), "id long")
    began = time.monotonic()
    assert jobs.bounded(slow, lambda d: d.count(), seconds=2)["ended"] is False
    assert time.monotonic() - began < 50


def test_tiers_copies_blobs(spark, tmp_path):
    rows = ["https://none.example", "# Tier: A", "https://a.example", "", "# note", "https://b.example", "## tier b", "https://c.example"]
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(rows)] + [("g", 0, "https://d.example")], "file string, line_no int, line string")
    got = {(r.url[8], r.tier) for r in files.tiers(lines).collect()}
    assert got == {("n", None), ("a", "a"), ("b", "a"), ("c", "b"), ("d", None)}
    spark.range(7).write.parquet(f"{tmp_path}/t")
    assert files.packed_copy(spark, f"{tmp_path}/t", f"{tmp_path}/p") == 7
    assert files.restored_copy(spark, f"{tmp_path}/p", f"{tmp_path}/r") and not files.restored_copy(spark, f"{tmp_path}/p", f"{tmp_path}/r")
    blobs = spark.createDataFrame([("s", "a", 1), ("s", "a", 2), ("t", "a", 1), ("s", None, 1)], "source_id string, body string, n int").withColumn("fetched_at", F.timestamp_seconds("n"))
    assert files.store_blobs(blobs, f"{tmp_path}/b").count() == 2
    files.store_blobs(blobs, f"{tmp_path}/b")
    assert spark.read.parquet(f"{tmp_path}/b").count() == 2
