"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writers: list = [0, "false"]
_scope = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the context's checkpoint folder; a folder of our own only where Spark is one process."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='aerolith-')}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found.rstrip("/")


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What this thread writes to scratch paths meanwhile is deleted at the end: for work that leaves its results
    elsewhere, such as a stream's batches, so that a session of any length holds one batch's tables at a time."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        for path in paths:
            delete_path(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends, or by freed()."""
    path = f"{shared_dir(spark)}/aerolith/{re.sub(r'[^a-z0-9]+', '-', label.lower())}-{uuid.uuid4().hex}"
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


@contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that are run meanwhile remove their shuffle files when they are done. The setting is the session's, so
    it goes back to what it was when the last of several writers is through; a query that it meets beside them only
    loses files that nothing reads again."""
    with _lock:
        if not _writers[0]:
            _writers[1] = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        _writers[0] += 1
    try:
        yield
    finally:
        with _lock:
            _writers[0] -= 1
            if not _writers[0]:
                spark.conf.set(CLEANUP, _writers[1])


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """df, computed once and cut from its lineage: a Parquet table in the shared folder. A codec is named where most bytes
    are digests as text, of which Spark's usual one leaves all."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _shuffle_files_removed(spark):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def deleted(df: DataFrame) -> None:
    """Delete the files of a table that written() made and nothing needs any more."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if "/aerolith/" in folder:
            delete_path(df.sparkSession, folder)
