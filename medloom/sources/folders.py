"""Folders of a shared file system, by Hadoop's own interface (any store Spark can write to)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, without hidden ones; none if it is not there."""
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to this folder has come to its end."""
    files, path = _file_system(spark, os.path.join(folder, "_SUCCESS"))
    return files.exists(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def make_folder(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.mkdirs(path)
