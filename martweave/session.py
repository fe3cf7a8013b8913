"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CLUSTER_PARTITIONS = 20_000
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_local_scratch: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def build_session(
    app_name: str = "martweave", master: str | None = None, cluster_partitions: int = CLUSTER_PARTITIONS, **conf: str
) -> SparkSession:
    """Session with the settings the operators assume.

    Adaptive execution joins small shuffle partitions and splits hot ones, so on a cluster
    shuffles start with ``cluster_partitions`` unless the session says otherwise. Stream state goes to disk instead of the heap.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    # Under spark-submit only the running session knows its master.
    if not session.sparkContext.master.startswith("local") and session.conf.get(_INITIAL_PARTITIONS, None) is None:
        session.conf.set(_INITIAL_PARTITIONS, str(cluster_partitions))
    return session


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local-mode session without the setting gets one temporary folder; on a cluster the
    setting is required, because a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="martweave-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the scratch root."""
    path = f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    opened = _scope.get()
    if opened is not None:
        opened.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove on exit the scratch paths taken inside, in this thread.

    Frames are lazy: whatever is made from scratch data must have been written by then.
    """
    opened: list[str] = []
    token = _scope.set(opened)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in opened:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a directory through the file system Spark reads it with; whether there was one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at ``path``, asked of the file system Spark reads it with."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system names it, or None if Spark keeps it in another store."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(folder).toUri().getPath() if system.getUri().getScheme() == "file" else None


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session like ``spark`` but for these settings. It shares the application, and ``spark`` keeps its own settings."""
    session = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file to ``target``, which must not exist; whether that was so."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), place, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def parked(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the scratch folder once and read back.

    For rows that several jobs must see alike, or that cost more to compute than to store. Cuts
    the lineage, and unlike a cache survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
