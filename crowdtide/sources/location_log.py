"""The location log as its readers see it: a base in buckets, and the batches committed after it.

A batch's rows lie under its number and the attempt that wrote them. A commit, one small row written last,
names the attempt that counts; the newest of a batch does. So readers see whole batches only, and each once,
whatever failed or was run again. The base holds what earlier batches came to, one folder per bucket and
version; a compaction names the buckets it renewed and the batch up to which the base goes, in one file.
"""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.sinks import ledger
from crowdtide.sinks.files import read_or_empty

# What became of a signal: it is in the log, it came too late, or it cannot be used.
LOCATED, LATE, NO_USER, NO_TIME = "located", "late", "no_msisdn", "no_time"


def rows_path(path: str) -> str:
    return posixpath.join(path, "rows")


def commits_path(path: str) -> str:
    return posixpath.join(path, "commits")


def base_path(path: str) -> str:
    return posixpath.join(path, "base")


def versions_path(path: str) -> str:
    return posixpath.join(path, "versions")


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed batch, with its counts: that of the attempt that counts."""
    every = ledger.read(spark, commits_path(path), S.BATCH_COMMITS)
    others = [F.col(c) for c in S.BATCH_COMMITS.fieldNames() if c != "batch_id"]
    newest = F.max_by(F.struct(*others), "attempt").alias("newest")
    return every.groupBy("batch_id").agg(newest).select("batch_id", "newest.*")


def committed_rows(spark: SparkSession, path: str, *outcomes: str) -> DataFrame:
    """Rows of the committed attempts; only the folders of these outcomes are read."""
    rows = read_or_empty(spark, rows_path(path), S.SIGNAL_ROWS).where(F.col("outcome").isin(*outcomes))
    return rows.join(read_commits(spark, path).select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")


@dataclass(frozen=True)
class Base:
    """The base of one moment: the last batch in it, the number of buckets, and the version of each that has rows."""

    upto: int
    buckets: int | None
    versions: dict[int, str]
    newest: dict[int, str]

    def folders(self, path: str, buckets: set[int] | None = None) -> list[str]:
        chosen = [(b, v) for b, v in sorted(self.versions.items()) if buckets is None or b in buckets]
        return [posixpath.join(base_path(path), f"bucket={b}", f"version={v}") for b, v in chosen]


def read_base(spark: SparkSession, path: str) -> Base:
    """What the newest compactions left; one row per bucket reaches the driver."""
    every = ledger.read(spark, versions_path(path), S.BASE_VERSIONS)
    latest = F.max_by(F.struct("version", "newest", "has_rows"), F.struct("upto", "version")).alias("latest")
    found = every.groupBy("bucket").agg(latest, F.max("upto").alias("upto"), F.max("buckets").alias("buckets")).collect()
    live = [r for r in found if r["bucket"] is not None and r["latest"]["has_rows"]]
    return Base(
        max((r["upto"] for r in found), default=-1),
        max((r["buckets"] for r in found), default=None),
        {r["bucket"]: r["latest"]["version"] for r in live},
        {r["bucket"]: r["latest"]["newest"] for r in live},
    )


def base_rows(spark: SparkSession, path: str, base: Base, buckets: set[int] | None = None) -> DataFrame:
    """Rows of the base, or of some of its buckets; no other folder is listed or read."""
    folders = base.folders(path, buckets)
    if not folders:
        return spark.createDataFrame([], S.BASE_ROWS)
    return spark.read.schema(S.BASE_ROWS).option("basePath", base_path(path)).parquet(*folders)


def read_location_log(spark: SparkSession, path: str) -> DataFrame:
    """The located signals that count; those of the base have batch number -1."""
    base = read_base(spark, path)
    columns = S.LOCATION_LOG.fieldNames()
    deltas = committed_rows(spark, path, LOCATED).where(F.col("batch_id") > base.upto)
    deltas = deltas.withColumnRenamed("value", "signal").select(*columns)
    if not base.versions:
        return deltas
    old = base_rows(spark, path, base).withColumn("batch_id", F.lit(-1).cast("long"))
    return old.select(*columns).unionByName(deltas)


def read_rejected_signals(spark: SparkSession, path: str) -> DataFrame:
    """(value, reject_reason, signals, ingest_time, batch_id): lines that cannot be located, each with how often it came."""
    rows = committed_rows(spark, path, NO_USER, NO_TIME)
    return rows.select("value", F.col("outcome").alias("reject_reason"), "signals", "ingest_time", "batch_id")


def read_late_signals(spark: SparkSession, path: str) -> DataFrame:
    """Signals that came after the watermark had passed them, with by how much and how often each line came."""
    rows = committed_rows(spark, path, LATE)
    return rows.select("msisdn", "cell_id", "event_time", "value", "signals", "lag_seconds", "ingest_time", "batch_id")
