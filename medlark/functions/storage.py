"""Shared-folder helpers: scratch paths and written intermediate tables."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, object] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach: ``spark.checkpoint.dir``, else that of the warehouse.

    Never a machine's own temporary folder: a warehouse on a local disk will do for a local master only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors reach in spark.checkpoint.dir")
    return warehouse.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder; ``release`` or the end of the program removes it."""
    folder = f"{shared_folder(spark)}/medlark-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        if not _FOLDERS:
            atexit.register(_release_all)
        _FOLDERS[folder] = spark.sparkContext._jvm
    return f"{folder}/{uuid.uuid4().hex}/{name}"


def _remove(folder: str, jvm) -> None:
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)


def discard(spark: SparkSession, path: str) -> None:
    """Remove one stored table that nothing reads any more."""
    _remove(path, spark.sparkContext._jvm)


def release(spark: SparkSession) -> None:
    """Remove all that was stored for this application; results must be written or fetched by then."""
    folder = f"{shared_folder(spark)}/medlark-{spark.sparkContext.applicationId}"
    jvm = _FOLDERS.pop(folder, None)
    if jvm is not None:
        _remove(folder, jvm)


def _release_all() -> None:
    while _FOLDERS:
        folder, jvm = _FOLDERS.popitem()
        try:
            _remove(folder, jvm)
        except Exception:  # noqa: BLE001 - the JVM may be gone; the folder's name says whose it was
            pass


def cut_lineage(df: DataFrame, options: dict[str, int] | None = None) -> DataFrame:
    """Write to the shared folder and read back.

    What follows starts from the written table, so it survives the loss of
    executors and reads only the columns it needs. ``options`` are those of
    the Parquet writer.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
