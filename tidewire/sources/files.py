"""Files and stored tables in and out."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.functions import urls


def table_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table with the given schema, or an empty frame of it where there is no table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON documents, one a file; broken ones give a row of nulls."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def domain_list(spark: SparkSession, path: str) -> DataFrame:
    """(domain) of a list file: blank lines and # comments are skipped, URLs give their host."""
    lines = spark.read.text(path).select(F.trim("value").alias("v")).filter((F.col("v") != "") & ~F.col("v").startswith("#"))
    host = F.when(F.col("v").contains("://"), urls.host(F.col("v"))).otherwise(F.regexp_replace(F.lower("v"), r"^www\.|/.*$", ""))
    return lines.select(host.alias("domain")).distinct()


def catalog(lines: DataFrame) -> DataFrame:
    """(line_no, name, url) of a catalog: '# 3. Name' names the next URL only; an unnamed URL takes its host.

    ``lines`` has (line_no, line) of one catalog file. The last comment since the previous URL is a window over the line
    numbers in which each URL closes a group.
    """
    text = F.trim("line")
    is_note = text.startswith("#")
    rows = lines.filter(text != "").select("line_no", text.alias("t"), is_note.alias("note"))
    order = Window.partitionBy(F.lit(0)).orderBy("line_no")
    closed = F.sum(F.when(~F.col("note"), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("g", F.coalesce(closed, F.lit(0)))
    named = F.when(F.col("t").rlike(r"^#+\s*\d+\.\s"), F.regexp_replace("t", r"^#+\s*\d+\.\s*", ""))
    w = Window.partitionBy("g").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("name", F.last(named, ignorenulls=True).over(w)).filter(~F.col("note"))
    return rows.select("line_no", F.coalesce(F.nullif("name", F.lit("")), urls.host(F.col("t"))).alias("name"), F.col("t").alias("url"))


def tiers(lines: DataFrame, header: str = r"^#+\s*tier[:\s]+(\w+)", file_col: str = "file") -> DataFrame:
    """(file, tier, url) of seed files in which header comments name the tier of the URLs below them; none before the first.

    ``lines`` has (file, line_no, line); each file is read in its own window.
    """
    text = F.trim("line")
    named = F.nullif(F.regexp_extract(F.lower(text), header, 1), F.lit(""))
    w = Window.partitionBy(file_col).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.filter(text != "").select(file_col, text.alias("t"), F.last(named, ignorenulls=True).over(w).alias("tier"))
    return rows.filter(~F.col("t").startswith("#")).select(file_col, "tier", F.col("t").alias("url"))


def packed_copy(spark: SparkSession, source: str, target: str) -> int:
    """A gzip-packed copy of a Parquet table, which reads like any other; tells its rows."""
    df = spark.read.parquet(source)
    df.write.mode("overwrite").option("compression", "gzip").parquet(target)
    return spark.read.schema(df.schema).parquet(target).count()


def restored_copy(spark: SparkSession, packed: str, target: str) -> bool:
    """Put a packed copy in the place of a table, unless rows are there already; tells whether it did."""
    df = spark.read.parquet(packed)
    if not table_or_empty(spark, target, df.schema).isEmpty():
        return False
    df.write.mode("overwrite").parquet(target)
    return True


def store_blobs(blobs: DataFrame, path: str) -> DataFrame:
    """Write raw bodies (source_id, fetched_at, body), partitioned by source and named by content; returns (source_id, blob, bytes).

    A body that is stored for its source already is not written again, so a retried batch adds nothing.
    """
    spark = blobs.sparkSession
    rows = blobs.filter(F.col("body").isNotNull()).withColumn("blob", F.sha2(F.col("body").cast("binary"), 256))
    once = rows.groupBy("source_id", "blob").agg(F.max_by("body", "fetched_at").alias("body"), F.max("fetched_at").alias("fetched_at"))
    known = table_or_empty(spark, path, "blob string, body string, fetched_at timestamp, source_id string").select("source_id", "blob")
    once.join(known, ["source_id", "blob"], "left_anti").select("blob", F.col("body").cast("string").alias("body"), "fetched_at", "source_id").write.mode("append").partitionBy("source_id").parquet(path)
    return once.select("source_id", "blob", F.octet_length("body").alias("bytes"))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    df.select(*(columns or df.columns)).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_text(df: DataFrame, template: str, columns: list[str], path: str) -> None:
    """One line for each row by a printf template over the columns."""
    df.select(F.format_string(template, *columns).alias("value")).write.mode("overwrite").text(path)


def write_unless_empty(df: DataFrame, path: str) -> bool:
    """Overwrite a table, but keep the old one where the new one has no row; tells whether it wrote."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def publish_json(payload: dict, path: str, mirrors: list[str] | None = None) -> None:
    """A small document, written beside its place and renamed into it, so that a reader never sees half of one."""
    for p in [path, *(mirrors or [])]:
        Path(p).parent.mkdir(parents=True, exist_ok=True)
        part = f"{p}.part"
        Path(part).write_text(json.dumps(payload, ensure_ascii=False, indent=1), encoding="utf-8")
        os.replace(part, p)


def fresh_entries(cache: DataFrame, at: str, seconds: int) -> DataFrame:
    """The newest entry of each cached key (sha-256 of its url) that is no older than its time to live."""
    alive = cache.filter(F.col("cached_at") >= F.lit(at).cast("timestamp_ntz") - F.expr(f"INTERVAL {seconds} SECONDS"))
    return alive.groupBy(F.sha2("url", 256).alias("key")).agg(F.max_by("body", F.struct("cached_at", "body")).alias("body"), F.max("cached_at").alias("cached_at"))
