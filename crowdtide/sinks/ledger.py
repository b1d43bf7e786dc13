"""Small tables of what has been done: marks, commits, versions. Rows are added, and the newest of a key decides.

A ledger is a folder of generations. Rows are added to the newest one, each time in one file. ``merge`` starts
another that begins with all rows that still decide something, in one file. Readers take the newest
generation and the one before it, in which a writer may still have been at work: rows read twice change
nothing. Older generations are read by nobody who begins now, so they can be removed after a while.
"""

from __future__ import annotations

import posixpath
import time
import uuid
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crowdtide.sinks.files import entries, exists, remove

_FIRST = "g=0"
_ARROW = {
    "string": pa.string(),
    "long": pa.int64(),
    "integer": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "timestamp_ntz": pa.timestamp("us"),
}


def stamped_name() -> str:
    """A name that sorts after earlier ones and tells when it was made."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def stamp_of(name: str) -> float | None:
    """Seconds since 1970 of a stamped name; None for any other."""
    digits = name.partition("-")[0]
    return int(digits) / 1e9 if len(digits) == 20 and digits.isdigit() else None


def generations(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole generations, oldest first."""
    names = sorted(e.name for e in entries(spark, path) if e.name.startswith("g="))
    return [n for n in names if exists(spark, posixpath.join(path, n, "_SUCCESS"))]


def add(spark: SparkSession, path: str, schema: T.StructType, rows: Iterable[tuple]) -> None:
    """A few rows more, all or none of them."""
    fields = [pa.field(f.name, _ARROW[f.dataType.typeName()]) for f in schema]
    columns = zip(*rows, strict=True)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))
    name = (generations(spark, path) or [_FIRST])[-1]
    # A table that is handed over as Arrow is planned as a constant: a third of the time of Python rows.
    spark.createDataFrame(table, schema).coalesce(1).write.mode("append").parquet(posixpath.join(path, name))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that can decide something, some of them twice; none if nothing was ever added."""
    folders = [posixpath.join(path, name) for name in generations(spark, path)[-2:]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge(spark: SparkSession, path: str, schema: T.StructType, deciding: Callable[[DataFrame], DataFrame], before: float) -> list[str]:
    """Starts a generation with the ``deciding`` rows, and removes those that readers since ``before`` don't use.

    Returns the folders removed. A writer that began with the generation before the last one must have ended,
    so merge a ledger no more often than the longest job takes.
    """
    known = generations(spark, path)
    if not known:
        return []
    rows = deciding(read(spark, path, schema)).select(*schema.fieldNames())
    rows.coalesce(1).write.parquet(posixpath.join(path, f"g={stamped_name()}"))
    names = generations(spark, path)
    gone = []
    for old, second in zip(names[:-2], names[2:], strict=True):
        if stamp_of(second.removeprefix("g=")) < before:
            gone.append(posixpath.join(path, old))
    for folder in gone:
        remove(spark, folder)
    return gone
