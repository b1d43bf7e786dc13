"""Writing the location log: batches, commits, and a base that costs what changed."""

from __future__ import annotations

import time
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.functions import ntz
from crowdtide.operators.signals import LOG_ORDER
from crowdtide.sinks import ledger
from crowdtide.sinks.files import entries, remove
from crowdtide.sources import location_log as log

#: What is kept of a user's newest signal.
PER_USER = ("cell_id", "event_time", "event_no", "seq", "signal")
#: Buckets of the base. It cannot be changed once a log has a base.
BUCKETS = 64


def write_attempt(rows: DataFrame, path: str) -> None:
    """Rows of one attempt at a batch; they count once the attempt is committed."""
    columns = S.SIGNAL_ROWS.fieldNames()
    rows.select(*columns).write.mode("append").partitionBy("outcome", "batch_id", "attempt").parquet(log.rows_path(path))


def commit_batch(spark: SparkSession, path: str, **commit: Any) -> None:
    """Makes an attempt the one that counts for its batch. One file, written last."""
    row = [tuple(commit.get(name) for name in S.BATCH_COMMITS.fieldNames())]
    ledger.add(spark, log.commits_path(path), S.BATCH_COMMITS, row)


def watermark_before(spark: SparkSession, path: str, batch_id: int, delay: timedelta) -> datetime | None:
    """The newest signal of the batches before this one, less the delay: the same whenever the batch is run."""
    earlier = log.read_commits(spark, path).where(F.col("batch_id") < batch_id)
    newest = earlier.agg(F.max("newest_event").alias("t")).first()["t"]
    return newest - delay if newest is not None else None


def compact_log(
    spark: SparkSession, path: str, as_of: datetime, ttl: timedelta, below: int | None = None, buckets: int = BUCKETS
) -> set[int]:
    """Takes the committed batches below number ``below`` into the base and returns the buckets that were renewed.

    Newest per user and hour of writing stays, expired rows go. Only buckets that a batch has users of are
    read and written again, under a new version; a bucket whose newest row has expired is given up unread. The
    rest keep their files. The new state counts from one commit on; readers that began before go on with the
    files of the old one, which ``vacuum_log`` removes later. One compaction runs at a time.
    """
    base = log.read_base(spark, path)
    if base.buckets not in (None, buckets):
        raise ValueError(f"this base has {base.buckets} buckets, not {buckets}")
    done = log.read_commits(spark, path).where(F.col("batch_id") > base.upto)
    if below is not None:
        done = done.where(F.col("batch_id") < below)
    upto = done.agg(F.max("batch_id").alias("b")).first()["b"]
    if upto is None:
        return set()
    fresh = F.col("ingest_time") > ntz(as_of - ttl)
    inside = (F.col("batch_id") > base.upto) & (F.col("batch_id") <= upto)
    deltas = log.committed_rows(spark, path, log.LOCATED).where(inside & fresh).withColumnRenamed("value", "signal")
    deltas = deltas.withColumn("bucket", F.pmod(F.xxhash64("msisdn"), F.lit(buckets)).cast("int"))
    touched = {r["bucket"] for r in deltas.select("bucket").distinct().collect()}
    version = ledger.stamped_name()
    if touched:
        _renew(spark, path, deltas, log.base_rows(spark, path, base, touched).where(fresh), version)
    written = {}
    if touched:
        own = spark.read.schema(S.BASE_ROWS).parquet(log.base_path(path)).where(F.col("version") == version)
        written = {r["bucket"]: r["t"] for r in own.groupBy("bucket").agg(F.max("ingest_time").alias("t")).collect()}
    limit = (as_of - ttl).isoformat(sep=" ")
    expired = {b for b, newest in base.newest.items() if b not in touched and newest <= limit}
    at = time.time()
    rows = [(b, version, upto, buckets, _text(written.get(b)), b in written, at) for b in sorted(touched | expired)]
    rows.append((None, version, upto, buckets, None, False, at))
    ledger.add(spark, log.versions_path(path), S.BASE_VERSIONS, rows)
    return touched


def _text(moment: datetime | None) -> str | None:
    return None if moment is None else moment.isoformat(sep=" ")


def _renew(spark: SparkSession, path: str, deltas: DataFrame, old: DataFrame, version: str) -> None:
    # Late signals renew a user's time, and readers look at the time of writing first: one row per hour of it stays.
    newest = F.max_by(F.struct(*PER_USER, "ingest_time"), F.struct(*LOG_ORDER, "ingest_time")).alias("newest")
    columns = ["bucket", "msisdn", "ingest_hour", "ingest_time", *PER_USER]
    both = old.select(*columns).unionByName(deltas.select(*columns))
    merged = both.groupBy("bucket", "msisdn", "ingest_hour").agg(newest).select("bucket", "msisdn", "ingest_hour", "newest.*")
    rows = merged.withColumn("version", F.lit(version)).select(*S.BASE_ROWS.fieldNames())
    # A bucket's rows come together, or every task would write a file for every bucket.
    rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket", "version").parquet(log.base_path(path))


def vacuum_log(spark: SparkSession, path: str, keep_for: timedelta, now: float | None = None) -> list[str]:
    """Removes what no reader that began within ``keep_for`` can need, and returns the folders.

    That is, of what stopped counting before then: located rows of batches that the base holds, attempts
    that were replaced or never committed, and versions of buckets that were renewed. Late and unusable
    signals stay. Commits and versions are merged into one file each. ``now`` is in seconds since 1970.
    """
    limit = (time.time() if now is None else now) - keep_for.total_seconds()
    counting = F.struct("upto", "version")
    versions = ledger.read(spark, log.versions_path(path), S.BASE_VERSIONS)
    current = versions.groupBy("bucket").agg(F.max_by(F.struct("version", "at"), counting).alias("v")).select("bucket", "v.*")
    # Only what was so at the limit already: later compactions may have readers before them.
    settled = versions.where(F.col("at") < limit)
    upto = settled.agg(F.max("upto").alias("b")).first()["b"]
    since = {r["bucket"]: r["t"] for r in settled.groupBy("bucket").agg(F.max("version").alias("t")).collect()}
    newest = {r["bucket"]: r["version"] for r in current.collect()}
    attempts = {r["batch_id"]: r["attempt"] for r in log.read_commits(spark, path).select("batch_id", "attempt").collect()}
    gone = []
    for outcome in entries(spark, log.rows_path(path)):
        for batch in entries(spark, outcome.path) if "=" in outcome.name else []:
            number = int(batch.name.partition("=")[2])
            held = outcome.name == f"outcome={log.LOCATED}" and upto is not None and number <= upto
            for attempt in entries(spark, batch.path):
                name = attempt.name.partition("=")[2]
                replaced = name != attempts.get(number)
                if held or (replaced and max(attempt.written, ledger.stamp_of(attempts.get(number, name))) < limit):
                    gone.append(attempt.path)
    for folder in entries(spark, log.base_path(path)):
        bucket = int(folder.name.partition("=")[2]) if "=" in folder.name else None
        for version in entries(spark, folder.path) if bucket is not None else []:
            name = version.name.partition("=")[2]
            unused = name < since.get(bucket, "") or (name not in (newest.get(bucket), since.get(bucket)) and version.written < limit)
            if unused and name != newest.get(bucket):
                gone.append(version.path)
    for folder in gone:
        remove(spark, folder)
    latest = lambda df: df.groupBy("bucket").agg(F.max_by(F.struct(*df.columns), counting).alias("v")).select("v.*")
    merged = ledger.merge(spark, log.versions_path(path), S.BASE_VERSIONS, latest, limit)
    one = lambda df: df.groupBy("batch_id").agg(F.max_by(F.struct(*df.columns), "attempt").alias("v")).select("v.*")
    return gone + merged + ledger.merge(spark, log.commits_path(path), S.BATCH_COMMITS, one, limit)
