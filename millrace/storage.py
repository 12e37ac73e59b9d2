"""Folder operations on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _locate(spark, path)
    return files.exists(location)


def make_dir(spark: SparkSession, path: str) -> None:
    files, location = _locate(spark, path)
    files.mkdirs(location)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all it holds; false when there was none."""
    files, location = _locate(spark, path)
    return files.delete(location, True)


def folders_with(spark: SparkSession, path: str, file: str) -> list[str]:
    """Names of the folders directly under ``path`` that hold ``file``, by one listing."""
    files, location = _locate(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(location, f"*/{file}")
    return [entry.getPath().getParent().getName() for entry in files.globStatus(pattern) or []]


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    files, location = _locate(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(location) if entry.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``."""
    files, location = _locate(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(location) if entry.isFile()]


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` with the store it belongs to."""
    files, location = _locate(spark, path)
    return files.makeQualified(location).toString()


def path_in_store(spark: SparkSession, path: str) -> str:
    """``path`` without the store, from its root."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def move(spark: SparkSession, path: str, to: str, modified: int, length: int) -> bool:
    """Move a file that was last changed at ``modified`` (milliseconds) and has ``length`` bytes.

    False when it is not there, or another one under its name. If an earlier move was broken off where moving
    is copying and deleting, this one completes it.
    """
    files, source = _locate(spark, path)
    others, target = _locate(spark, to)
    if not files.exists(source):
        return False
    found = files.getFileStatus(source)
    if (found.getModificationTime(), found.getLen()) != (modified, length):
        return False
    others.delete(target, False)
    others.mkdirs(target.getParent())
    if files.getUri().equals(others.getUri()):
        return files.rename(source, target)
    util = spark._jvm.org.apache.hadoop.fs.FileUtil
    return util.copy(files, source, others, target, True, True, spark._jsc.hadoopConfiguration())
