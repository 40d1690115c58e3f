"""Structured Streaming twins of the batch operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tidewire.operators.state import upserted
from tidewire.runtime import exists, is_folder, listed, removed

STATE = "url string, source_id string, status string, retry_count long, last_error_type string, first_seen_at timestamp, last_seen_at timestamp, last_crawled_at timestamp, next_crawl_at timestamp, content_hash string, version long"
FRONTIER = f"url_hash string, {STATE}"
_FIELDS = [f.split()[0] for f in STATE.split(", ")]


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table (one file or a folder of files) as a stream of its files."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = f"{sf_dir}/{name}.parquet"
    return reader.parquet(path) if is_folder(spark, path) else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def windowed_counts(stream: DataFrame, at: str, keys: list[str], width: str, lateness: str) -> DataFrame:
    """Rows per key and tumbling window; rows later than ``lateness`` behind the newest are dropped by the watermark."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def unseen(stream: DataFrame, at: str, keys: list[str], lateness: str) -> DataFrame:
    """Rows whose keys were not seen within ``lateness``; the state forgets keys as the watermark passes them."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)


def split_late(batch: DataFrame, at: str, newest: str, lateness: str) -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows) of a micro-batch, against a horizon of ``lateness`` before ``newest``; null times are late."""
    horizon = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
    good = F.coalesce(F.col(at) >= horizon, F.lit(False))
    return batch.filter(good), batch.filter(~good)


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Applies a URL's transitions, in (ts, seq) order inside a micro-batch, to its state; emits the new state."""
    row = dict(zip(_FIELDS, state.get, strict=True)) if state.exists else None
    steps = pd.concat(list(batches)).sort_values(["ts", "seq"])
    for s in steps.to_dict("records"):
        s = {k: None if v is None or v is pd.NaT or v != v else v for k, v in s.items()}
        if s["action"] == "upsert":
            if row is None:
                row = dict.fromkeys(_FIELDS) | {"retry_count": 0, "first_seen_at": s["ts"], "version": 0}
            row |= {"url": s["url"], "source_id": s["source_id"], "status": "pending"}
            row |= {k: s[k] for k in ("next_crawl_at", "content_hash") if s[k] is not None}
        elif row is None:
            continue
        elif s["action"] == "crawled":
            row |= {"status": "crawled", "last_crawled_at": s["ts"], "last_error_type": None}
            if s["content_hash"] is not None:
                row["content_hash"] = s["content_hash"]
        else:
            row |= {"status": s["action"], "retry_count": row["retry_count"] + 1, "last_error_type": s["error_type"], "next_crawl_at": None}
        row["last_seen_at"] = s["ts"]
        row["version"] += 1
    if row is not None:
        state.update(tuple(row[f] for f in _FIELDS))
        yield pd.DataFrame([{"url_hash": key[0]} | row])


def frontier_states(log: DataFrame) -> DataFrame:
    """A stream of URL states out of a stream of transitions (see state.replayed_frontier), keyed by ``url_hash``.

    State is one row for each URL. Each micro-batch emits the URLs it changed; the highest version of a URL is its state.
    """
    return log.groupBy("url_hash").applyInPandasWithState(_fold, FRONTIER, STATE, "update", GroupStateTimeout.NoTimeout)


#: The upsert table is split by its keys' hashes into so many buckets; a batch rewrites those it touches.
BUCKETS = 64


def upsert_sink(path: str, key: str, order: list[str], buckets: int = BUCKETS):  # noqa: ANN201
    """A foreachBatch function that keeps the newest row of each key in a bucketed table of numbered versions.

    A batch writes new versions of the buckets its keys fall in, out of the newest ones before it, into the folder of its
    own number; other buckets stay as they are. A batch that is run again after a failure writes the same folder anew, so
    the table comes out the same. Folders are listed through the storage's own file system.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marked = batch.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = {r["_bucket"] for r in marked.select("_bucket").distinct().collect()}  # at most as many as buckets
        before = [p for b, p in newest_buckets(spark, path, number).items() if b in touched]
        old = spark.read.schema(batch.schema).parquet(*before) if before else spark.createDataFrame([], batch.schema)
        new = upserted(old, batch, key, order).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        new.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/n={number:08d}")

    return write


def newest_buckets(spark: SparkSession, path: str, below: int | None = None) -> dict[int, str]:
    """The newest completely written folder of each bucket, of batches before number ``below`` where that is given."""
    out: dict[int, str] = {}
    for version in listed(spark, path):
        if version.startswith("n=") and (below is None or int(version[2:]) < below) and exists(spark, f"{path}/{version}/_SUCCESS"):
            out |= {int(b[8:]): f"{path}/{version}/{b}" for b in listed(spark, f"{path}/{version}") if b.startswith("_bucket=")}
    return out


def upserted_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What an upsert sink has left: the newest version of each bucket; empty before the first batch."""
    parts = list(newest_buckets(spark, path).values())
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def drop_superseded(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove bucket versions that later ones replace, but for those of the ``keep`` newest batches; tells how many."""
    versions = [v for v in listed(spark, path) if v.startswith("n=")]
    live = set(newest_buckets(spark, path).values())
    old = [f"{path}/{v}/{b}" for v in versions[: max(0, len(versions) - keep)] for b in listed(spark, f"{path}/{v}") if b.startswith("_bucket=")]
    return sum(removed(spark, p) for p in old if p not in live)


def late_sink(path: str, at: str, lateness: str):  # noqa: ANN201
    """A foreachBatch function that splits each micro-batch by the newest time of the batches before it.

    Rows in time go to ``path``/good, late ones and those without a time to ``path``/late, by batch number; the newest time
    seen goes to ``path``/newest as one row, so a restart finds it, and a batch that is run again gives the same folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = [v for v in listed(spark, f"{path}/newest") if v < f"n={number:08d}" and exists(spark, f"{path}/newest/{v}/_SUCCESS")]
        newest = spark.read.parquet(*[f"{path}/newest/{v}" for v in done]).agg(F.max("at").cast("string")).first()[0] if done else None
        good, late = (batch, batch.filter(F.col(at).isNull())) if newest is None else split_late(batch, at, newest, lateness)
        for name, rows in (("good", good.filter(F.col(at).isNotNull())), ("late", late), ("newest", batch.agg(F.max(at).alias("at")))):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/n={number:08d}")

    return write
