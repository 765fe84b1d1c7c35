"""Intermediate tables in the shared folder the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own_folders: dict[str, str] = {}
_marked_folders: set[str] = set()
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when the driver ends.

    Where the setting is absent, a local session gets a temporary folder that is
    removed at exit. A cluster session without it is refused, as executors do
    not see the driver's disk.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/tidemark-{app}"
        if folder not in _marked_folders:
            _delete_at_exit(spark, folder)
            _marked_folders.add(folder)
        return folder
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if app not in _own_folders:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folders[app] = folder
    return _own_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that nobody else uses."""
    path = f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    opened = _scope.get()
    if opened is not None:
        opened.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete at the end what was put into scratch paths within; nothing read
    from them may be used later."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            delete_path(spark, path)


@contextmanager
def recorded_scratch():
    """The list that scratch paths made within are added to; deleting them is up to the
    caller."""
    paths: list[str] = []
    outer = _scope.get()
    token = _scope.set(paths)
    try:
        yield paths
    finally:
        _scope.reset(token)
        if outer is not None:
            outer.extend(paths)


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write `df` once; return it as a table read, and its number of rows.

    Later passes read the columns they need from the table. Losing an executor
    costs a re-read, not the work that made `df`.
    """
    path = scratch_path(df.sparkSession, name)
    rows = write_counted(df, lambda counted: counted.write.parquet(path, compression="lz4"))
    return df.sparkSession.read.schema(df.schema).parquet(path), rows


def write_counted(df: DataFrame, write) -> int:
    """Run `write(df)` and return the rows that went through, without a second pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Let the file system delete the folder when the driver's JVM ends."""
    target, files = hadoop_path(spark, folder)
    files.mkdirs(target)
    files.deleteOnExit(target)


def delete_path(spark: SparkSession, path: str) -> None:
    target, files = hadoop_path(spark, path)
    files.delete(target, True)


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, as Spark's own writers see them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
