"""Session helper, table access, staging tables and size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it was counted and holds at most this many bytes by estimate.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

_staged_paths: list[str] = []
_own_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def session(app: str = "tidewire", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own session."""
    return (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else the context's checkpoint directory.

    Only a local session without either gets a folder of its own; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _own_dirs:
        _own_dirs[key] = tempfile.TemporaryDirectory(prefix="tidewire-")
        atexit.register(_own_dirs[key].cleanup)
    return _own_dirs[key].name


def _hadoop(spark: SparkSession, path: str):  # noqa: ANN202
    """(file system, path) of the storage a path names: local disk, HDFS or an object store alike."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none where there is no folder."""
    fs, where = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def removed(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.delete(where, True)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs a file read instead of the whole chain, and lets
    later plans prune columns. Results that are still lazy read it, so it stays until ``drop_staged`` is called, once they
    were written or collected; a local session removes its own folder at exit.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged_paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Remove the tables that this driver has staged so far; to be called when no result that reads them is open. Tells how many."""
    n = sum(removed(spark, p) for p in _staged_paths)
    _staged_paths.clear()
    return n


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the counted rows times ``row_bytes`` stay within ``limit``.

    Beyond the limit the plain frame is returned and the join shuffles. ``df`` should be a staged or
    otherwise cheap frame, because counting runs it.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until no column of ``df`` has it (case aside), for columns added in between."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, so that whatever they are called nothing joined on can clash; ``row.*`` unpacks."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
