"""Folders of tables, on whatever storage holds them."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Entry:
    """A file or folder and when it was written, in seconds since 1970."""

    path: str
    name: str
    written: float


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder; nothing if there is no such folder."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    found = files.listStatus(where)
    return [Entry(posixpath.join(path, s.getPath().getName()), s.getPath().getName(), s.getModificationTime() / 1000) for s in found]


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
