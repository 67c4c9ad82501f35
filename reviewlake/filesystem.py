"""Metadata operations on the file system Spark itself uses (local, HDFS or object store).

Only paths pass through here, never data.
"""

from __future__ import annotations

from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str) -> tuple[Any, Any]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return bool(fs.exists(hadoop_path))


def delete(spark: SparkSession, path: str) -> bool:
    """Delete recursively; FALSE if there was nothing to delete."""
    fs, hadoop_path = _resolve(spark, path)
    return bool(fs.delete(hadoop_path, True))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; an existing target is an error, as a folder would be moved into it."""
    fs, source_path = _resolve(spark, source)
    target_path = _resolve(spark, target)[1]
    if fs.exists(target_path):
        raise FileExistsError(target)
    if not fs.exists(target_path.getParent()):
        fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def prune(spark: SparkSession, path: str) -> bool:
    """Delete a folder, and folders in it, that hold no data file; TRUE if it is gone.

    Marks that writers leave (names beginning with ``_`` or ``.``) are no data. Only empty folders are
    deleted, so what arrives meanwhile stays.
    """
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return False
    held = list(fs.listStatus(hadoop_path))
    kept = [s for s in held if (not prune(spark, s.getPath().toString()) if s.isDirectory()
                                else not s.getPath().getName().startswith(("_", ".")))]
    if kept:
        return False
    for status in held:
        if status.isFile():
            fs.delete(status.getPath(), False)
    try:
        return bool(fs.delete(hadoop_path, False))  # refuses a folder that has been filled meanwhile
    except Py4JJavaError:
        return False


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty if it does not exist."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def file_lengths(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and lengths of the files directly below a folder."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    return {s.getPath().getName(): int(s.getLen()) for s in fs.listStatus(hadoop_path) if s.isFile()}


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _resolve(spark, path)
    return int(fs.getContentSummary(hadoop_path).getLength())
