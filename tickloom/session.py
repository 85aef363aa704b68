"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STAGED = threading.local()  # ``folders`` written inside the innermost open `dropped_stages` of a thread
_LOCAL: dict[str, str] = {}  # folders chosen in local mode, by application


def build_session(app: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume (UTC, adaptive execution)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Deduplication state outgrows executor memory long before its watermark passes.
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is chosen only in local mode, where driver and executors are one
    process; on a cluster a missing setting is an error, because a machine-local folder
    would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL[application]


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes and actions inside delete their shuffle files as they end, which else lie there until the driver collects garbage.

    For plans that run once: a second action on the same DataFrame would compute its shuffles again.
    """
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a durable cut in the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    if getattr(_STAGED, "folders", None) is not None:
        _STAGED.folders.append(path)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def dropped_stages(spark: SparkSession) -> Iterator[None]:
    """For jobs whose results lie elsewhere at the end: what they `stage` inside is deleted then, also if they fail."""
    outer = getattr(_STAGED, "folders", None)
    _STAGED.folders = folders = []
    try:
        yield
    finally:
        _STAGED.folders = outer
        for path in folders:
            file_system(spark, path).delete(hadoop_path(spark, path), True)


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system that ``path`` lies in."""
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))
