"""Session settings and durable cut points for iterative jobs."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "studyloom", master: str | None = None,
                  **settings: str) -> SparkSession:
    """Session with the settings every job here relies on; cluster sizing stays with the caller."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a new one only for a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="spark-studyloom-")
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


# Folders below the checkpoint folder and catalog tables to give up, per session.
_WRITTEN: dict[str, list[str]] = {}
_TABLES: dict[str, list[str]] = {}


def own(spark: SparkSession, path: str, table: str | None = None) -> str:
    """Have `release` delete a folder, and drop a catalog table, that only this session uses."""
    session = spark.sparkContext.applicationId
    if session not in _WRITTEN:
        _WRITTEN[session] = []
        atexit.register(_release_at_exit, spark)
    _WRITTEN[session].append(path)
    if table is not None:
        _TABLES.setdefault(session, []).append(table)
    return path


def release(spark: SparkSession) -> int:
    """Delete what `durable` has written in this session and what it owns; the number of folders.

    Runs by itself when the driver ends; a long-lived session calls it once its results are
    written. Data frames that still read such a table cannot be used afterwards.
    """
    for name in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {name}")
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def _release_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:  # not stopped
        with contextlib.suppress(Exception):
            release(spark)


# Removes the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffle_files_removed(spark: SparkSession):
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def durable(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared checkpoint folder and read it back.

    Used where later steps read a result more than once. It is computed once, a
    lost executor never forces the earlier steps to run again, and later steps see
    its real size and read only the columns they use. The shuffle files behind it go as soon as
    it is written.
    """
    spark = df.sparkSession
    path = own(spark, f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}")
    with _shuffle_files_removed(spark):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
