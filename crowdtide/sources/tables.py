"""The tables that jobs write and read back. All are partitioned Parquet with a stated schema."""

from __future__ import annotations

import posixpath
from collections.abc import Collection, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.functions import is_blank, ntz
from crowdtide.operators.signals import LOG_ORDER, latest_per_user
from crowdtide.sinks import ledger
from crowdtide.sinks.files import entries
from crowdtide.sources.location_log import read_location_log

#: What a mark can be about.
STATS, PROFILES, CURRENT_PROFILES, REJECTED = "stats", "profiles", "current", "rejected"


def time_text(moment: datetime) -> str:
    return moment.strftime("%Y%m%d%H%M%S")


def read_snapshot(spark: SparkSession, path: str, times: Sequence[datetime]) -> DataFrame:
    """Snapshots of the given times; only their partitions are listed and read."""
    wanted = [time_text(t) for t in times]
    return spark.read.schema(S.SNAPSHOT).parquet(path).where(F.col("stat_time").isin(wanted))


def read_snapshot_range(spark: SparkSession, path: str, begin: datetime, end: datetime) -> DataFrame:
    """Snapshots from ``begin`` to ``end``, both included."""
    inside = F.col("stat_time").between(time_text(begin), time_text(end))
    return spark.read.schema(S.SNAPSHOT).parquet(path).where(inside)


def read_latest_locations(
    spark: SparkSession,
    path: str,
    as_of: datetime,
    ttl: timedelta = timedelta(seconds=S.TTL_SECONDS),
    by: str = "ingest_time",
) -> DataFrame:
    """(msisdn, cell_id) of every user written within ``ttl`` before ``as_of``; blank cells are skipped.

    ``by`` is the clock the time-to-live runs on. With ``ingest_time``, which is one value per batch, files
    of batches out of reach are skipped by their statistics.
    """
    log = read_location_log(spark, path)
    live = log.where((F.col(by) > ntz(as_of - ttl)) & (F.col(by) <= ntz(as_of)))
    return latest_per_user(live, order_by=LOG_ORDER).where(~is_blank(F.col("cell_id")))


def stored_times(spark: SparkSession, path: str, wanted: Sequence[datetime]) -> set[str]:
    """Which of the wanted times have a snapshot, from the names of the folders alone."""
    there = {e.name.removeprefix("stat_time=") for e in entries(spark, path)}
    return there & {time_text(t) for t in wanted}


def fingerprints(spark: SparkSession, path: str, times: Collection[str]) -> dict[str, str]:
    """What the stored snapshots of these times hold, in a few bytes each."""
    known = ledger.read(spark, fingerprints_path(path), S.FINGERPRINTS).where(F.col("stat_time").isin(sorted(times)))
    newest = known.groupBy("stat_time").agg(F.max_by("fingerprint", "written_at").alias("fingerprint"))
    return {r["stat_time"]: r["fingerprint"] for r in newest.collect()}  # no more than were asked for


def fingerprints_path(snapshots: str) -> str:
    return posixpath.join(snapshots, "_fingerprints")


def read_marks(spark: SparkSession, marks: str) -> DataFrame:
    """Marks as they were added; the newest of a key decides."""
    return ledger.read(spark, marks, S.MARKS)


def finished(spark: SparkSession, marks: str, kind: str) -> DataFrame:
    """(stat_time, movement, run, source): the run that counts for each key, and what it was made from."""
    of_kind = read_marks(spark, marks).where(F.col("kind") == kind)
    newest = F.max_by(F.struct("run", "source"), F.struct("marked_at", "run")).alias("newest")
    return of_kind.groupBy("stat_time", "movement").agg(newest).select("stat_time", "movement", "newest.*")


def _of_runs(table: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys are among the finished ones, which are all partition columns.

    The finished keys, one per published time, are looked up now and tested against the names of the
    folders: no file of another run is read, so none of those can be missed when it is removed.
    """
    names = [r["name"] for r in done.select(F.concat_ws("/", *keys).alias("name")).distinct().collect()]
    if not names:
        return table.where(F.lit(False)).drop("run")
    listed = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in sorted(names))
    return table.where(F.expr(f"concat_ws('/', {', '.join(keys)}) IN ({listed})")).drop("run")


def read_stats(spark: SparkSession, path: str, marks: str, stat_time: datetime | None = None) -> DataFrame:
    """Statistics of the runs that count."""
    done = finished(spark, marks, STATS)
    if stat_time is not None:
        done = done.where(F.col("stat_time") == time_text(stat_time))
    return _of_runs(spark.read.schema(S.AREA_STATS).parquet(path), done, "stat_time", "run")


def read_profiles(spark: SparkSession, path: str, marks: str) -> DataFrame:
    """Profiles of the runs that count."""
    done = finished(spark, marks, PROFILES)
    return _of_runs(spark.read.schema(S.PROFILE).parquet(path), done, "stat_time", "movement", "run")


def read_current_profiles(spark: SparkSession, path: str, marks: str) -> DataFrame:
    return _of_runs(spark.read.schema(S.CURRENT_PROFILE).parquet(path), finished(spark, marks, CURRENT_PROFILES), "run")


def read_rejected(spark: SparkSession, path: str, marks: str) -> DataFrame:
    return _of_runs(spark.read.schema(S.REJECTED).parquet(path), finished(spark, marks, REJECTED), "stat_time", "run")
