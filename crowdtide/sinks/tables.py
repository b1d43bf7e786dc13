"""Writing tables. Each run writes rows of its own, and a mark says which run's rows count.

A table of results has its run as last partition. The rows of a time, and of a kind of movement, are those
of the run that was marked last for it; readers see no others. So a run that is repeated with fewer rows,
or none, leaves nothing of the earlier one visible, a run that fails changes nothing, and a reader never
sees half of one.
"""

from __future__ import annotations

import posixpath
import time
from collections.abc import Iterable, Mapping
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.operators.profile import profiles
from crowdtide.sinks import ledger
from crowdtide.sinks.files import exists, remove
from crowdtide.sinks.places import Paths
from crowdtide.sources.delimited import parse_stats, read_lines, rejected_stats
from crowdtide.sources import tables as stored
from crowdtide.sources.tables import time_text


def new_run() -> str:
    return ledger.stamped_name()


def _replace_partitions(
    df: DataFrame, path: str, *keys: str, fmt: str = "parquet", even: bool = True, **options: str
) -> None:
    """Replace the partitions that ``df`` has rows for.

    ``even`` rebalances first: a large partition is cut over many files and small ones are joined.
    """
    rows = df.hint("rebalance", *keys) if even else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*keys)
        .format(fmt)
        .save(path)
    )


def write_snapshot(snapshot: DataFrame, path: str, many_times: bool = False) -> None:
    """A snapshot of one time is written as it lies, without another shuffle.

    With ``many_times`` rows are first brought together by time, or every task would write a file
    for every time. The fingerprint of each time is kept beside the snapshots: of one time it is made while
    its rows are written, of several the written rows are read again.
    """
    seen = Observation()
    rows = snapshot.select(*S.SNAPSHOT.fieldNames())
    rows = rows.hint("rebalance", "stat_time") if many_times else rows
    rows = rows.observe(seen, F.collect_set("stat_time").alias("times"), fingerprint().alias("fingerprint"))
    _replace_partitions(rows, path, "stat_time", even=False)
    found, spark, now = seen.get, snapshot.sparkSession, ledger.stamped_name()
    prints = {t: found["fingerprint"] for t in found["times"]}
    if len(prints) > 1:
        written = spark.read.schema(S.SNAPSHOT).parquet(path).where(F.col("stat_time").isin(sorted(prints)))
        prints = {r["stat_time"]: r["f"] for r in written.groupBy("stat_time").agg(fingerprint().alias("f")).collect()}
    if prints:
        ledger.add(spark, stored.fingerprints_path(path), S.FINGERPRINTS, [(t, f, now) for t, f in sorted(prints.items())])


def fingerprint() -> Column:
    """An aggregate that tells whether two snapshots hold the same rows, in whatever order."""
    row = F.xxhash64("user_hash", "cell_id", "prefix7")
    numbers = F.count("*"), F.bit_xor(row), F.sum(F.pmod(row, F.lit(1 << 31)))
    return F.concat_ws(":", *[n.cast("string") for n in numbers])


def write_stats(stats: DataFrame, path: str, run: str, fmt: str = "parquet") -> None:
    """Counts under ``stat_time``, ``level`` and ``run``; as CSV a line is ``area,label,value,count,branch``."""
    if "branch" not in stats.columns:
        stats = stats.withColumn("branch", F.lit(None).cast("string"))
    rows = stats.withColumn("run", F.lit(run)).select(*S.AREA_STATS.fieldNames())
    _replace_partitions(rows, path, "stat_time", "level", "run", fmt=fmt, **(S.STATS_CSV if fmt == "csv" else {}))


def write_profiles(rows: DataFrame, path: str, run: str) -> None:
    """Profile history, keyed by area, label and time, with one partition per kind of movement and run."""
    kept = rows.withColumn("run", F.lit(run)).select(*S.PROFILE.fieldNames())
    _replace_partitions(kept, path, "stat_time", "movement", "run")


def write_current_profiles(rows: DataFrame, path: str, run: str) -> None:
    """Profiles keyed by area and label only; once marked, this run takes the place of the last one."""
    kept = rows.withColumn("run", F.lit(run)).select(*S.CURRENT_PROFILE.fieldNames())
    _replace_partitions(kept, path, "run")


def write_rejected(rows: DataFrame, path: str, stat_time: datetime, run: str) -> None:
    """Lines that could not be used, with the reason."""
    stamped = rows.select("line", "reject_reason").withColumns({"stat_time": F.lit(time_text(stat_time)), "run": F.lit(run)})
    _replace_partitions(stamped, path, "stat_time", "run")


def mark_complete(
    spark: SparkSession,
    path: str,
    kind: str,
    run: str,
    keys: Iterable[tuple[str, str]],
    at: datetime | None = None,
    sources: Mapping[tuple[str, str], str] | None = None,
) -> None:
    """Makes ``run`` the one that counts for each (stat_time, movement) that it was asked for, rows or not.

    Written last, in one small file. Marks are only added; the newest of a key decides. ``sources`` says
    for each key what snapshots it was made from.
    """
    when = (at or datetime.now(UTC)).strftime(_MARKED)
    rows = [(S.ROWKEY_JOINER.join((S.COMPLETE_MARK, t)), kind, t, m, run, when, (sources or {}).get((t, m))) for t, m in keys]
    if rows:
        ledger.add(spark, path, S.MARKS, rows)


_MARKED = "%Y%m%d%H%M%S%f"


def _with_end(marks: DataFrame) -> DataFrame:
    """Marks with the time from which another counted, or null."""
    of_key = Window.partitionBy("kind", "stat_time", "movement").orderBy("marked_at", "run")
    return marks.distinct().withColumn("until", F.lead("marked_at").over(of_key))


def vacuum(spark: SparkSession, paths: Paths, keep_for: timedelta, now: datetime | None = None) -> list[str]:
    """Removes results that no reader who began within ``keep_for`` can need, and returns their folders.

    That is rows of runs whose place another run has taken before then, and rows that are not marked, of
    runs that began before then: these have failed. A job must not take that long. Marks are merged into one
    file: those that count and those that did within the time. What readers see is the same before and after.
    """
    limit = (now or datetime.now(UTC)) - keep_for
    marks = _with_end(stored.read_marks(spark, paths.marks))
    gone = []
    for kind, path, schema, keys in (
        (stored.STATS, paths.stats, S.AREA_STATS, ("stat_time", "level", "run")),
        (stored.PROFILES, paths.profiles, S.PROFILE, ("stat_time", "movement", "run")),
        (stored.CURRENT_PROFILES, paths.current_profiles, S.CURRENT_PROFILE, ("run",)),
        (stored.REJECTED, paths.rejected, S.REJECTED, ("stat_time", "run")),
    ):
        if not exists(spark, path):
            continue
        marked = [k for k in keys if k != "level"]
        # Only names of folders are looked at; a row for each is all that moves.
        there = spark.read.schema(schema).parquet(path).select(*keys).distinct().where(F.col("run").isNotNull())
        ends = marks.where(F.col("kind") == kind).groupBy(*marked)
        ends = ends.agg(F.max(F.coalesce("until", F.lit("9"))).alias("until"))  # "9": still counts
        for r in there.join(ends, marked, "left").where(F.col("until").isNull() | (F.col("until") < limit.strftime(_MARKED))).collect():
            began = ledger.stamp_of(r["run"])
            if r["until"] is not None or (began is not None and began < limit.timestamp()):
                gone.append(posixpath.join(path, *[f"{k}={r[k]}" for k in keys]))
    for folder in gone:
        remove(spark, folder)
    count = lambda df: _with_end(df).where(F.col("until").isNull() | (F.col("until") >= limit.strftime(_MARKED)))
    return gone + ledger.merge(spark, paths.marks, S.MARKS, count, limit.timestamp())


def rebuild_profiles(
    spark: SparkSession,
    stats_path: str,
    stat_time: datetime,
    movement: str = "current",
    run: str = "",
    rejected_path: str | None = None,
) -> DataFrame:
    """Profiles from saved ``area,label,value,count[,branch]`` text, chosen by branch as when first published.

    Lines that cannot be used are written to ``rejected_path``, by default ``_rejected`` in the folder of the
    statistics, which readers of these pass over.
    """
    lines = read_lines(spark, stats_path)
    write_rejected(rejected_stats(lines), rejected_path or posixpath.join(stats_path, "_rejected"), stat_time, run)
    return profiles(parse_stats(lines), by=()).withColumns(
        {"stat_time": F.lit(time_text(stat_time)), "movement": F.lit(movement), "run": F.lit(run)}
    )


def export_dimension(bridge: DataFrame, path: str, sep: str = ",") -> None:
    """A bridge as delimited text; a missing ratio is written as 0.0."""
    bridge.withColumn("ratio", F.coalesce("ratio", F.lit(0.0))).write.mode("overwrite").csv(path, sep=sep)


def write_bucketed_labels(labels: DataFrame, table: str, path: str, buckets: int) -> None:
    """Parsed labels bucketed by user, so that each run joins them without moving them again."""
    (
        labels.write.mode("overwrite")
        .bucketBy(buckets, "user_hash")
        .sortBy("user_hash")
        .option("path", path)
        .saveAsTable(table)
    )



def write_bucketed_snapshot(snapshot: DataFrame, table: str, path: str, buckets: int) -> None:
    """Snapshots in folders by time, each in buckets by user: one file a bucket and time.

    Labels in as many buckets join them without moving either. The times written replace their own.
    """
    spark = snapshot.sparkSession
    rows = snapshot.select(*S.SNAPSHOT.fieldNames()).repartition(buckets, "user_hash")
    if spark.catalog.tableExists(table):
        rows.write.insertInto(table, overwrite=True)
        return
    (
        rows.write.mode("overwrite")
        .partitionBy("stat_time")
        .bucketBy(buckets, "user_hash")
        .sortBy("user_hash")
        .option("path", path)
        .option("partitionOverwriteMode", "dynamic")  # kept with the table, for the times written later
        .saveAsTable(table)
    )


def open_bucketed_snapshot(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """The table of bucketed snapshots that another session wrote to ``path``, with so many buckets."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.SNAPSHOT)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (stat_time) "
            f"CLUSTERED BY (user_hash) SORTED BY (user_hash) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        spark.catalog.recoverPartitions(table)
    return spark.table(table)
