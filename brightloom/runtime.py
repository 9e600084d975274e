"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPREAD_BYTES = 16 * 1024 * 1024  # of files that one task takes of a spread table

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "brightloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the defaults above. Cluster sizing (executors, shuffle
    partitions, checkpoint folder) stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Local sessions without the setting get a temporary folder; a cluster
    without it is an error, since a machine-local path dies with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
        if configured:
            return configured
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="brightloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and go on from the written rows.
    Unlike a checkpoint the table is columnar, and Spark knows its size. The write's shuffle
    files go when it ends, not with some later collection of the driver's garbage; a session
    that has a setting for this keeps it."""
    path = scratch_path(df.sparkSession, "table")
    written(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, path: str, by: list[str] = ()) -> None:
    """Write a table, in a folder for each value of the columns `by`, without leaving shuffle files."""
    spark = df.sparkSession
    unset = spark.conf.get(TIDY, None) is None
    if unset:
        spark.conf.set(TIDY, "true")
    try:
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    finally:
        if unset:
            spark.conf.unset(TIDY)


def forget_path(spark: SparkSession, path: str) -> None:
    """Delete a table of this session's, or a folder of one, that no later plan reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    base = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark)).toUri().getPath()
    if not at.toUri().getPath().startswith(f"{base}/table-"):
        raise ValueError(f"{path} is no scratch table")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def give_back() -> None:
    """Return a worker's free memory: workers are kept for later tasks, beside those that run."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other systems' allocators
        pass


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def spread(self, name: str, key: str, also: DataFrame | None = None) -> DataFrame:
        """The table for heavy work per row, hash-spread by its row key over every core and
        in parts that don't grow with it. Files alone come in splits of any size, and a
        sum by row key and something else needs no other shuffle then. `also`: a table to join
        by the key before, so that rows it lacks are not moved."""
        cores = self.spark.sparkContext.defaultParallelism
        size = (self.spark.read.format("binaryFile").load(self.path(name))
                .agg(F.sum("length")).first()[0])
        table = getattr(self, name)
        if also is not None:
            from .operators.relations import sized_join

            table = sized_join(table, also, [key])
        return table.repartition(max(cores, -(-size // SPREAD_BYTES)), key)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))
