"""Results by run: what vacuum removes, and what is computed anew when a snapshot was repaired."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from crowdtide import schemas as S
from crowdtide.plans import jobs
from crowdtide.sinks import ledger
from crowdtide.sinks import tables as sinks
from crowdtide.sources import tables as sources
from crowdtide.workload import tables as w

T = w.AS_OF
QUARTER, HOUR, DAY = timedelta(minutes=15), timedelta(hours=1), timedelta(days=1)


@pytest.fixture
def paths(tmp_path):
    return jobs.Paths(*[str(tmp_path / n) for n in ("snapshots", "backups", "stats", "profiles", "current", "marks", "rejected")])


@pytest.fixture
def inputs(spark):
    return jobs.Inputs(w.bridges(spark, SMALL), w.prefix_region(spark, SMALL), w.labels(spark, SMALL))


def people(spark, stat_time, *users, cell="43020$10000"):
    return spark.createDataFrame([(u, cell, "1860000", sources.time_text(stat_time)) for u in users], S.SNAPSHOT)


def store(spark, paths, stat_time, *users, **more):
    sinks.write_snapshot(people(spark, stat_time, *users, **more), paths.snapshots)


def runs(tmp_path, table):
    return sorted({p.name.removeprefix("run=") for p in (tmp_path / table).glob("**/run=*")})


def test_vacuum_removes_what_no_mark_names_and_readers_see_the_same(spark, inputs, paths, tmp_path):
    for users in ("ab", "abc", "abcd"):
        store(spark, paths, T, *users)
        jobs.run_history(spark, inputs, paths, T, T)
        jobs.run_movement(spark, inputs, paths, T)
    # A run that failed before its mark, and one that somebody else named.
    failed = sinks.new_run()
    sinks.write_stats(sources.read_stats(spark, paths.stats, paths.marks), paths.stats, failed)
    sinks.write_stats(sources.read_stats(spark, paths.stats, paths.marks), paths.stats, "by-hand")
    assert len(runs(tmp_path, "stats")) == 5 and len(runs(tmp_path, "profiles")) == 6

    def seen():
        return [
            rows(sources.read_stats(spark, paths.stats, paths.marks)),
            rows(sources.read_profiles(spark, paths.profiles, paths.marks)),
            rows(sources.finished(spark, paths.marks, sources.PROFILES)),
        ]

    before = seen()
    assert sinks.vacuum(spark, paths, HOUR) == [] and len(runs(tmp_path, "stats")) == 5
    readers = sources.read_stats(spark, paths.stats, paths.marks), sources.read_profiles(spark, paths.profiles, paths.marks)
    later = datetime.now(UTC) + 2 * HOUR
    gone = sinks.vacuum(spark, paths, HOUR, now=later)
    assert len([g for g in gone if g.startswith(paths.stats)]) > 0 and any(failed in g for g in gone)
    assert runs(tmp_path, "stats")[1:] == ["by-hand"] and len(runs(tmp_path, "stats")) == 2
    # History and movement of one time: the profiles of its current people are those of the last job.
    assert len(runs(tmp_path, "profiles")) == 1
    assert [rows(r) for r in readers] == before[:2] and seen() == before
    sinks.vacuum(spark, paths, HOUR, now=later + HOUR)
    assert seen() == before
    marks = ledger.read(spark, paths.marks, S.MARKS)
    assert marks.distinct().count() == marks.select("kind", "stat_time", "movement").distinct().count()


def test_vacuum_of_nothing(spark, paths):
    assert sinks.vacuum(spark, paths, HOUR) == []


def test_fingerprints_tell_different_snapshots_apart(spark, paths):
    store(spark, paths, T, "a", "b", "c")
    first = sources.fingerprints(spark, paths.snapshots, [sources.time_text(T)])
    sinks.write_snapshot(people(spark, T, "c", "a", "b").repartition(5), paths.snapshots)
    assert sources.fingerprints(spark, paths.snapshots, [sources.time_text(T)]) == first
    seen = [first]
    for change in (("a", "b"), ("a", "b", "d"), ("a", "b", "c", "c"), ("a", "a", "c", "c")):
        store(spark, paths, T, *change)
        seen.append(sources.fingerprints(spark, paths.snapshots, [sources.time_text(T)]))
    store(spark, paths, T, "a", "b", "c", cell="43020$10001")
    seen.append(sources.fingerprints(spark, paths.snapshots, [sources.time_text(T)]))
    assert len({str(s) for s in seen}) == len(seen)
    # Several times in one write have what each alone would have.
    both = people(spark, T, "a", "b", "c").union(people(spark, T + HOUR, "x"))
    sinks.write_snapshot(both, paths.snapshots, many_times=True)
    found = sources.fingerprints(spark, paths.snapshots, [sources.time_text(t) for t in (T, T + HOUR, T + DAY)])
    assert found[sources.time_text(T)] == first[sources.time_text(T)] and len(found) == 2
    assert rows(sources.read_snapshot(spark, paths.snapshots, [T])) == rows(people(spark, T, "a", "b", "c"))


@pytest.fixture
def reads(monkeypatch):
    """The times whose snapshots a job reads: the others' folders are left out by their names."""
    seen = []

    def read_snapshot(spark, path, times):
        found = sources.read_snapshot(spark, path, times)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*stat_time", plan) and "PartitionFilters: []" not in plan
        seen.append(sorted(sources.stored_times(spark, path, times)))
        return found

    monkeypatch.setattr(jobs, "read_snapshot", read_snapshot)
    return seen


def text(*moments):
    return sorted(sources.time_text(m) for m in moments)


def test_only_changed_times_are_read_and_computed(spark, inputs, paths, reads):
    schedule = jobs.steps(T - HOUR, T + HOUR)
    for t in schedule[:-1]:
        store(spark, paths, t, "a", "b")
    absent = text(schedule[-1])

    def movement():
        return jobs.run_movement(spark, inputs, paths, schedule[0], schedule[-1], changed_only=True)

    def history(outputs=jobs.BOTH):
        return jobs.run_history(spark, inputs, paths, schedule[0], schedule[-1], outputs, changed_only=True)

    assert movement() == absent and history(jobs.OUTPUTS["hdfs"]) == absent
    assert reads == [text(*schedule[:-1])] * 2
    first = rows(sources.finished(spark, paths.marks, sources.PROFILES))
    # Nothing has changed: nothing is read. The same snapshot written again is no change.
    store(spark, paths, T, "b", "a")
    assert movement() == absent and history(jobs.OUTPUTS["hdfs"]) == absent and len(reads) == 2
    assert rows(sources.finished(spark, paths.marks, sources.PROFILES)) == first
    # One snapshot changes: its own time, the next one, and the hour that looks back at it.
    store(spark, paths, T - HOUR, "a", "b", "c")
    movement()
    assert reads[2] == text(T - HOUR, T - HOUR + QUARTER, T - QUARTER, T)
    latest = sources.finished(spark, paths.marks, sources.PROFILES)
    changed = {r[0] for r in set(rows(latest)) - set(first)}
    assert changed == set(text(T - HOUR, T - HOUR + QUARTER, T))
    history(jobs.OUTPUTS["hdfs"])
    assert reads[3] == text(T - HOUR)
    # Results that were never made are missing, whatever the snapshots say.
    history()
    assert reads[4] == text(*schedule[:-1])
    # All results are those of a job over everything.
    got = rows(sources.read_stats(spark, paths.stats, paths.marks))
    jobs.run_history(spark, inputs, paths, schedule[0], schedule[-1])
    assert rows(sources.read_stats(spark, paths.stats, paths.marks)) == got


def test_a_snapshot_without_a_fingerprint_is_computed_every_time(spark, inputs, paths, reads):
    people(spark, T, "a").write.partitionBy("stat_time").parquet(paths.snapshots)
    for n in (1, 2):
        assert jobs.run_history(spark, inputs, paths, T, T, jobs.OUTPUTS["hdfs"], changed_only=True) == []
        assert reads == [text(T)] * n


def test_an_earlier_snapshot_that_comes_later_is_a_change(spark, inputs, paths):
    store(spark, paths, T, "a", "b")
    jobs.run_movement(spark, inputs, paths, T, changed_only=True)
    assert sources.read_profiles(spark, paths.profiles, paths.marks).where("movement != 'current'").count() == 0
    store(spark, paths, T - QUARTER, "a")
    jobs.run_movement(spark, inputs, paths, T, changed_only=True)
    stayed = sources.read_profiles(spark, paths.profiles, paths.marks).where(F.col("movement") == "stayed_15m")
    assert '"' in stayed.first()["profile_json"]
