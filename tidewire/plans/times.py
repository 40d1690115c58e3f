"""Queries over publication times (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import freshness
from tidewire.operators.clocks import agreement, candidate_zones, estimated_zones, instants, written
from tidewire.runtime import staged, table

#: Sources without a declared clock are tried with every history of offsets of these years.
YEARS = (2025, 2026)
RECORDS = {"articles": "extracted_at", "discovered_urls": "discovered_at"}


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    clocks, parts = table(spark, sf_dir, "source_clocks"), None
    for name, seen in RECORDS.items():
        own = table(spark, sf_dir, name).withColumn("record_table", F.lit(name))
        own = written(own, clocks, "published_at", seen, ["record_table", "id"])
        parts = own if parts is None else parts.unionByName(own)
    return parts


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instants(_written(spark, sf_dir), candidate_zones(*YEARS), ["record_table", "id"], lane="record_table")


def p5_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clock each source seems to write by while its declared one is hidden, and how many of its times that leaves right."""
    parts = staged(_written(spark, sf_dir), "written_times")
    clocks = table(spark, sf_dir, "source_clocks").groupBy("source_id").agg(F.min("zone_name").alias("declared_zone"))
    found = estimated_zones(parts.select("source_id", "t", "seen", F.col("record_table").alias("lane")), candidate_zones(*YEARS))
    pairs = staged(found.join(clocks, "source_id", "left"), "zones")
    right = agreement(parts.select("source_id", "t"), pairs.select("source_id", "zone_name", "declared_zone"))
    return pairs.join(right, "source_id", "left").select("source_id", "zone_name", "declared_zone", "agreeing", "compared", "violations")


def times_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = table(spark, sf_dir, "articles").select("id", "url", "published_at", "content_length", "extracted_at")
    return freshness.recent(arts, "2025-09-20", "Asia/Ho_Chi_Minh", 2).select("id").distinct()


def times_fresh_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = table(spark, sf_dir, "articles").select("id", "published_at", "extracted_at")
    return freshness.fresh_by_day(arts, "2025-09-20", "Asia/Ho_Chi_Minh", 2, "2025-09-20T17:00:00", 48).select("id").distinct()


QUERIES = {"p5_found": p5_found, "p5_zones": p5_zones, "times_recent": times_recent, "times_fresh_by_day": times_fresh_by_day}
ORACLE: dict[str, str] = {}
