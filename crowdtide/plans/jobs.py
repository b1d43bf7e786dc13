"""Whole jobs: snapshot statistics, backfill, real-time profiles, backup and movement.

A job writes its snapshot, then its statistics, and reads them back, so no expensive step is repeated and
a lost executor costs one task. Results count once the job's run is marked, which it does last.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.operators.counts import LabelSpec, area_counts
from crowdtide.operators.movement import CURRENT, LAGS, lags_for, look_back, movement_counts
from crowdtide.operators.profile import profiles
from crowdtide.operators.rollup import Bridges, area_stats
from crowdtide.operators.snapshot import accepted, build_snapshot, rejected, split_location_lines
from crowdtide.operators.timeline import STEP
from crowdtide.plans.lineage import scratch_folder
from crowdtide.sinks import tables as sinks
from crowdtide.sinks.places import Paths
from crowdtide.sources.tables import (
    CURRENT_PROFILES,
    PROFILES,
    REJECTED,
    STATS,
    finished,
    fingerprints,
    read_snapshot,
    stored_times,
    time_text,
)

Labels = Sequence[tuple[LabelSpec, DataFrame]]

OUT_STATS = "stats"
OUT_PROFILES = "profiles"
BOTH = frozenset({OUT_STATS, OUT_PROFILES})

# How the three output settings are written in a job's configuration.
OUTPUTS = {
    "hdfs": frozenset({OUT_STATS}),
    "hbase": frozenset({OUT_PROFILES}),
    "both": BOTH,
}


@dataclass(frozen=True)
class Inputs:
    bridges: Bridges
    prefix_region: DataFrame
    labels: Labels


def steps(begin: datetime, end: datetime, step: timedelta = STEP) -> list[datetime]:
    """Every time of the schedule from ``begin`` to ``end``."""
    return [begin + i * step for i in range((end - begin) // step + 1)]


Sources = Mapping[tuple[str, str], str]


def made_from(spark: SparkSession, path: str, times: Sequence[datetime], lags: Callable[[datetime], Mapping[str, timedelta]]) -> Sources:
    """For each time with a snapshot and each kind of result due at it: the fingerprints of what it is made from.

    A kind is left out if the snapshot of its time has no fingerprint. A look-back without a snapshot counts
    as one that holds nothing. Current results made beside comparisons are of districts alone and say so by a ``|``.
    """
    reach = {time_text(look_back(t, lag)) for t in times for lag in lags(t).values()} | {time_text(t) for t in times}
    known, found = fingerprints(spark, path, reach), {}
    for t in times:
        own = known.get(time_text(t))
        if own is not None:
            found[time_text(t), CURRENT] = f"{own}|" if lags(t) else own
            for kind, lag in lags(t).items():
                found[time_text(t), kind] = f"{own}|{known.get(time_text(look_back(t, lag)), '')}"
    return found


def _changed(spark: SparkSession, paths: Paths, kinds: Collection[str], times: Sequence[datetime], sources: Sources) -> list[datetime]:
    """The times of which some result is missing, or was made from other snapshots than are there now."""
    texts = [time_text(t) for t in times]
    made = None
    for kind in kinds:
        marks = finished(spark, paths.marks, kind).where(F.col("stat_time").isin(texts)).collect()  # no more than were asked for
        of_kind = {((r["stat_time"], r["movement"]), r["source"]) for r in marks if r["source"] is not None}
        made = of_kind if made is None else made & of_kind
    # Current results of all areas stand for those of districts too, though counts of a district may differ; the reverse is not so.
    whole = {(key, f"{source}|") for key, source in made or () if key[1] == CURRENT}
    made = whole.union(made or ())
    stale = {key[0] for key, source in sources.items() if (key, source) not in made}
    stale |= set(texts) - {t for t, _ in sources}
    return [t for t in times if time_text(t) in stale]


def _none(stat_time: datetime) -> Mapping[str, timedelta]:
    return {}


def _write(
    spark: SparkSession,
    snapshots: DataFrame,
    inputs: Inputs,
    paths: Paths,
    times: Sequence[str],
    outputs: Collection[str],
    sources: Sources,
) -> None:
    """Count, roll up and publish; every time asked for is marked, also one without rows."""
    run = sinks.new_run()
    stats = area_stats(area_counts(snapshots, inputs.prefix_region, inputs.labels), inputs.bridges)
    # What is computed once is the table that is published.
    sinks.write_stats(stats, paths.stats, run)
    keys = [(t, CURRENT) for t in times]
    if OUT_PROFILES in outputs:
        kept = spark.read.schema(S.AREA_STATS).parquet(paths.stats).where(F.col("run") == run)
        sinks.write_profiles(profiles(kept).withColumn("movement", F.lit(CURRENT)), paths.profiles, run)
        sinks.mark_complete(spark, paths.marks, PROFILES, run, keys, sources=sources)
    if OUT_STATS in outputs:
        sinks.mark_complete(spark, paths.marks, STATS, run, keys, sources=sources)


def run_snapshot(
    spark: SparkSession,
    locations: DataFrame,
    inputs: Inputs,
    paths: Paths,
    stat_time: datetime,
    outputs: Collection[str] = BOTH,
) -> None:
    """Freeze the latest locations, then count, roll up and publish them."""
    sinks.write_snapshot(build_snapshot(locations, stat_time), paths.snapshots)
    snapshot = read_snapshot(spark, paths.snapshots, [stat_time])
    sources = made_from(spark, paths.snapshots, [stat_time], _none)
    _write(spark, snapshot, inputs, paths, [time_text(stat_time)], outputs, sources)


def run_snapshot_lines(
    spark: SparkSession,
    lines: DataFrame,
    inputs: Inputs,
    paths: Paths,
    stat_time: datetime,
    outputs: Collection[str] = BOTH,
) -> None:
    """``run_snapshot`` over ``msisdn,cell`` text; lines that cannot be used are kept with their reason."""
    run, folder = sinks.new_run(), scratch_folder(spark, "lines")
    # Split once: what is accepted is kept by its columns, what is rejected by its text, in folders of their own.
    rows, fits = split_location_lines(lines), F.col("reject_reason").isNull()
    rows.select(F.when(~fits, F.col("line")).alias("line"), "msisdn", "cell_id", "reject_reason", fits.alias("fits")).write.partitionBy("fits").parquet(folder)
    rows = spark.read.schema("line string, msisdn string, cell_id string, reject_reason string, fits boolean").parquet(folder)
    sinks.write_rejected(rejected(rows.where(~F.col("fits"))), paths.rejected, stat_time, run)
    run_snapshot(spark, accepted(rows.where("fits")), inputs, paths, stat_time, outputs)
    sinks.mark_complete(spark, paths.marks, REJECTED, run, [(time_text(stat_time), CURRENT)])


def run_history(
    spark: SparkSession,
    inputs: Inputs,
    paths: Paths,
    begin: datetime,
    end: datetime,
    outputs: Collection[str] = BOTH,
    changed_only: bool = False,
) -> list[str]:
    """Statistics for every stored snapshot of the schedule, as one job keyed by time.

    With ``changed_only``, only times whose snapshot is not the one that the results were made from are read
    and computed. Returns the times of the schedule that have no snapshot; results of earlier runs stand for
    those.
    """
    wanted = steps(begin, end)
    there = stored_times(spark, paths.snapshots, wanted)
    due = [t for t in wanted if time_text(t) in there]
    sources = made_from(spark, paths.snapshots, due, _none)
    if changed_only:
        kinds = [k for k, out in ((STATS, OUT_STATS), (PROFILES, OUT_PROFILES)) if out in outputs]
        due = _changed(spark, paths, kinds, due, sources)
    if due or not changed_only:
        _write(spark, read_snapshot(spark, paths.snapshots, due), inputs, paths, [time_text(t) for t in due], outputs, sources)
    return [t for t in map(time_text, wanted) if t not in there]


def run_realtime(
    spark: SparkSession, locations: DataFrame, inputs: Inputs, paths: Paths, run_time: datetime, outputs: Collection[str] = BOTH
) -> None:
    """As ``run_snapshot`` but without keeping the snapshot; profiles replace those of the last run."""
    run = sinks.new_run()
    counted = area_counts(build_snapshot(locations, run_time), inputs.prefix_region, inputs.labels)
    sinks.write_stats(area_stats(counted, inputs.bridges), paths.stats, run)
    if OUT_PROFILES in outputs:
        kept = spark.read.schema(S.AREA_STATS).parquet(paths.stats).where(F.col("run") == run)
        sinks.write_current_profiles(profiles(kept), paths.current_profiles, run)
        sinks.mark_complete(spark, paths.marks, CURRENT_PROFILES, run, [("", CURRENT)])
    if OUT_STATS in outputs:
        sinks.mark_complete(spark, paths.marks, STATS, run, [(time_text(run_time), CURRENT)])


def run_backup(locations: DataFrame, paths: Paths, stat_time: datetime) -> None:
    """Keep a snapshot under the backup root and compute nothing from it."""
    sinks.write_snapshot(build_snapshot(locations, stat_time), paths.backups)


def run_movement(
    spark: SparkSession, inputs: Inputs, paths: Paths, begin: datetime, end: datetime | None = None, changed_only: bool = False
) -> list[str]:
    """Movement profiles for one time or for every time of the schedule in a range, as one job.

    Every kind of movement that is due at a stored time is marked, also without rows. With ``changed_only``,
    only times are computed whose own snapshot or one they look back at is not the one that their profiles
    were made from; these snapshots alone are read. Returns the times without a snapshot.
    """
    wanted = steps(begin, end or begin)
    there = stored_times(spark, paths.snapshots, wanted)
    absent = [t for t in map(time_text, wanted) if t not in there]
    due = [t for t in wanted if time_text(t) in there]
    sources = made_from(spark, paths.snapshots, due, lags_for)
    if changed_only:
        due = _changed(spark, paths, [PROFILES], due, sources)
        if not due:
            return absent
    lags = lags_for(begin) if len(wanted) == 1 else LAGS
    reach = {look_back(t, lag) for t in due for lag in lags.values()} | set(due)
    snapshots = read_snapshot(spark, paths.snapshots, sorted(reach))
    counted = movement_counts(snapshots, lags, inputs.bridges.cell_district, inputs.prefix_region, inputs.labels)
    stats = counted.where(F.col("stat_time").isin([time_text(t) for t in due]))
    run = sinks.new_run()
    sinks.write_profiles(profiles(stats, by=("stat_time", "movement")), paths.profiles, run)
    keys = [(time_text(t), kind) for t in due for kind in (CURRENT, *lags_for(t))]
    sinks.mark_complete(spark, paths.marks, PROFILES, run, keys, sources=sources)
    return absent
