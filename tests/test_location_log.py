"""The location log: whole batches, late signals, a base that costs what changed, and what vacuum may remove."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SMALL, rows
from crowdtide import schemas as S
from crowdtide.sinks import ledger
from crowdtide.sinks import location_log as sink
from crowdtide.sources import location_log as log
from crowdtide.sources.tables import read_latest_locations
from crowdtide.streaming import locations as stream
from crowdtide.streaming.event_time import start_append_stream, window_counts
from crowdtide.streaming.ttl_state import STATE_PROVIDER, expired_locations
from crowdtide.workload import tables as w

NOW = datetime(2024, 1, 31)
HOUR = timedelta(hours=1)


def line(user, cell, minute, seq="1"):
    stamp = (datetime(2024, 1, 30, 12) + timedelta(minutes=minute)).strftime("%Y%m%d%H%M%S")
    return f"1|{user}|1|{cell}|{stamp}|{stamp}|{stamp}|{stamp}|{seq}|x|"


def put(folder, name, *texts):
    folder.mkdir(exist_ok=True)
    (folder.parent / name).write_text("\n".join(texts) + "\n")
    (folder.parent / name).rename(folder / name)


def read(spark, path, *columns):
    return rows(log.read_location_log(spark, path).select(*columns or ("msisdn", "cell_id", "batch_id")))


def test_a_batch_that_fails_before_its_commit_is_read_once_after_a_restart(spark, tmp_path, monkeypatch):
    folder, path = tmp_path / "in", str(tmp_path / "log")

    def run():
        stream.start_location_stream(stream.file_lines(spark, str(folder)), path, str(tmp_path / "p"), clock=lambda: NOW).awaitTermination()

    put(folder, "1.txt", line("a", "1", 1), line("b", "1", 1), "junk")
    run()
    put(folder, "2.txt", line("a", "2", 2), line("c", "2", 2), "junk")
    commit = sink.commit_batch
    monkeypatch.setattr(sink, "commit_batch", lambda *a, **k: (_ for _ in ()).throw(OSError("lost before the commit")))
    with pytest.raises(StreamingQueryException):
        run()
    # Its files are there, and nobody reads them.
    assert len(list((tmp_path / "log").glob("rows/outcome=located/batch_id=1/*/*.parquet"))) > 0
    assert read(spark, path) == [("a", "1$1", 0), ("b", "1$1", 0)]
    assert log.read_rejected_signals(spark, path).count() == 1
    monkeypatch.setattr(sink, "commit_batch", commit)
    run()
    assert len(list((tmp_path / "log").glob("rows/outcome=located/batch_id=1/*"))) == 2
    assert read(spark, path) == [("a", "1$1", 0), ("a", "1$2", 1), ("b", "1$1", 0), ("c", "1$2", 1)]
    assert [(r["batch_id"], r["signals"], r["rejected"]) for r in log.read_commits(spark, path).orderBy("batch_id").collect()] == [(0, 3, 1), (1, 3, 1)]
    # The files of the failed attempt go, the others stay.
    assert stream.vacuum_log(spark, path, HOUR) == []
    gone = stream.vacuum_log(spark, path, HOUR, now=time.time() + 7200)
    assert sorted(g.split("/")[-3] for g in gone if "/rows/" in g) == ["outcome=located", "outcome=no_msisdn"]
    assert len(read(spark, path)) == 4 and log.read_rejected_signals(spark, path).count() == 2


def test_a_batch_that_fails_after_its_commit_replaces_itself(spark, tmp_path, lines):
    path = str(tmp_path / "log")
    write = stream.append_batch(path, clock=lambda: NOW)
    for cell in ("1", "2"):
        write(lines(line("a", cell, 1), "junk", "junk"), 0)
    assert read(spark, path) == [("a", "1$2", 0)]
    assert rows(log.read_rejected_signals(spark, path).select("value", "signals")) == [("junk", 2)]


def test_late_signals_are_set_apart_with_their_lag(spark, tmp_path, lines):
    path = str(tmp_path / "log")
    write = stream.append_batch(path, clock=lambda: NOW, delay=timedelta(minutes=10))
    write(lines(line("a", "1", 60), line("b", "1", 20)), 0)
    write(lines(line("a", "old", 50), line("b", "old", 50), line("b", "old", 50), line("c", "in", 51)), 1)
    assert read(spark, path) == [("a", "1$1", 0), ("b", "1$1", 0), ("c", "1$in", 1)]
    late = log.read_late_signals(spark, path).select("msisdn", "cell_id", "lag_seconds", "signals", "batch_id")
    assert rows(late) == [("a", "1$old", 0, 1, 1), ("b", "1$old", 0, 2, 1)]
    # Batch 1 again, after batch 2 has moved the watermark: the same signals are late, by as much.
    write(lines(line("d", "1", 300)), 2)
    write(lines(line("a", "old", 50), line("b", "old", 50), line("b", "old", 50), line("c", "in", 51)), 1)
    assert rows(log.read_late_signals(spark, path).select("msisdn", "cell_id", "lag_seconds", "signals", "batch_id")) == rows(late)
    write(lines(line("d", "late", 40)), 3)
    assert log.read_late_signals(spark, path).where("batch_id = 3").first()["lag_seconds"] == 250 * 60
    counts = log.read_commits(spark, path).orderBy("batch_id").select("signals", "located", "kept", "late", "rejected")
    assert [tuple(r) for r in counts.collect()] == [(2, 2, 2, 0, 0), (4, 1, 1, 3, 0), (1, 1, 1, 0, 0), (1, 0, 0, 1, 0)]


def test_empty_and_blank_batches_are_committed(spark, tmp_path, lines):
    path = str(tmp_path / "log")
    write = stream.append_batch(path, clock=lambda: NOW, delay=HOUR)
    write(lines("", None), 0)
    write(spark.createDataFrame([], "value string"), 1)
    assert read(spark, path) == []
    assert [tuple(r)[5:] for r in log.read_commits(spark, path).collect()] == [(0, 0, 0, 0, 0)] * 2
    assert stream.compact_log(spark, path, NOW, HOUR) == set()


def test_a_batch_is_read_and_shuffled_once(spark, lines):
    plan = stream.sort_out(w.signal_lines(spark, SMALL), NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_max_by" in plan


def files(folder):
    return {str(p) for p in folder.glob("base/bucket=*/version=*/*.parquet")}


def test_compaction_gives_equal_reads(spark, tmp_path, lines):
    """Over two compactions, at two times, with signals that come late and users who expire."""
    path, plain = str(tmp_path / "log"), str(tmp_path / "plain")
    ends = []
    for n in range(12):
        for to in (path, plain):
            write = stream.append_batch(to, clock=lambda n=n: NOW + timedelta(minutes=20 * n))
            write(lines(*[line(f"u{i}", f"c{n}", (7 * n + i) % 60, str(n)) for i in range(n % 5, 20)]), n)
        if n in (5, 11):
            end = NOW + timedelta(minutes=20 * n + 10)
            stream.compact_log(spark, path, end, timedelta(hours=2), below=n, buckets=8)
            ends += [end, end + timedelta(minutes=5)]
            for at in ends[-2:]:
                assert rows(read_latest_locations(spark, path, at, HOUR)) == rows(read_latest_locations(spark, plain, at, HOUR))
    assert {r[0] for r in read(spark, path, "batch_id")} == {-1, 11}
    before = rows(read_latest_locations(spark, path, ends[-1], HOUR))
    removed = stream.vacuum_log(spark, path, HOUR, now=time.time() + 7200)
    assert any("outcome=located/batch_id=10" in f for f in removed) and any("version=" in f for f in removed)
    assert not any("batch_id=11" in f for f in removed)
    assert rows(read_latest_locations(spark, path, ends[-1], HOUR)) == before
    assert stream.vacuum_log(spark, path, HOUR, now=time.time() + 7200) != removed


def test_untouched_buckets_keep_their_files(spark, tmp_path, lines):
    path = str(tmp_path / "log")
    write = stream.append_batch(path, clock=lambda: NOW)
    write(lines(*[line(f"u{i}", "1", i) for i in range(40)]), 0)
    assert stream.compact_log(spark, path, NOW, HOUR, buckets=16) == set(log.read_base(spark, path).versions)
    first, base = files(tmp_path / "log"), log.read_base(spark, path)
    assert len(base.versions) > 8 and base.upto == 0
    write(lines(line("u3", "2", 50), line("u7", "2", 50)), 1)
    touched = stream.compact_log(spark, path, NOW, HOUR, buckets=16)
    assert 1 <= len(touched) <= 2
    after = log.read_base(spark, path)
    assert {b for b in base.versions if after.versions[b] != base.versions[b]} == touched and after.upto == 1
    new = files(tmp_path / "log") - first
    assert first < files(tmp_path / "log") and {int(f.split("bucket=")[1].split("/")[0]) for f in new} == touched
    # Readers of the new state are given the folders of the touched buckets' new versions and the others' old ones.
    plan = log.base_rows(spark, path, after).inputFiles()
    assert {f.removeprefix("file://") for f in plan} == (new | {f for f in first if int(f.split("bucket=")[1].split("/")[0]) not in touched})
    got = {r["msisdn"]: r["cell_id"] for r in log.read_location_log(spark, path).collect()}
    assert got == {f"u{i}": "1$2" if i in (3, 7) else "1$1" for i in range(40)}
    assert stream.compact_log(spark, path, NOW, HOUR, buckets=16) == set()
    with pytest.raises(ValueError, match="16 buckets"):
        stream.compact_log(spark, path, NOW, HOUR, buckets=8)


def test_expired_buckets_are_given_up_unread(spark, tmp_path, lines):
    path = str(tmp_path / "log")
    stream.append_batch(path, clock=lambda: NOW)(lines(*[line(f"u{i}", "1", i) for i in range(30)]), 0)
    stream.compact_log(spark, path, NOW, HOUR, buckets=8)
    stream.append_batch(path, clock=lambda: NOW + 3 * HOUR)(lines(line("u1", "2", 50)), 1)
    touched = stream.compact_log(spark, path, NOW + 3 * HOUR, HOUR, buckets=8)
    assert set(log.read_base(spark, path).versions) == touched and len(touched) == 1
    assert read(spark, path) == [("u1", "1$2", -1)]


def test_a_reader_that_began_before_a_compaction_and_vacuum_still_ends(spark, tmp_path, lines):
    path = str(tmp_path / "log")
    write = stream.append_batch(path, clock=lambda: NOW)
    write(lines(*[line(f"u{i}", "1", i) for i in range(30)]), 0)
    stream.compact_log(spark, path, NOW, HOUR, buckets=4)
    write(lines(line("u1", "2", 50)), 1)
    reader = log.read_location_log(spark, path)
    stream.compact_log(spark, path, NOW, HOUR, buckets=4)
    write(lines(line("u2", "2", 50)), 1)
    # What it reads stopped counting just now, so it is kept for the hour, whenever it was written.
    assert all("_" not in f for f in stream.vacuum_log(spark, path, HOUR))
    assert reader.count() >= 31


def test_ledger_merges_and_keeps_what_readers_may_use(spark, tmp_path):
    path, schema = str(tmp_path / "l"), S.BASE_VERSIONS
    row = lambda b, v: (b, v, 1, 8, None, True, 0.0)
    newest = lambda df: df.groupBy("bucket").agg(F.max_by(F.struct(*df.columns), "version").alias("v")).select("v.*")
    decided = lambda: rows(newest(ledger.read(spark, path, schema)).select("bucket", "version"))
    assert decided() == [] and ledger.merge(spark, path, schema, newest, 0) == []
    for v in "abc":
        ledger.add(spark, path, schema, [row(1, v), row(2, v)])
    reader = newest(ledger.read(spark, path, schema))
    assert ledger.merge(spark, path, schema, newest, 0) == []
    ledger.add(spark, path, schema, [row(2, "d")])
    # A writer that had begun before the merge adds to the earlier generation: its rows count too.
    late = spark.createDataFrame([row(1, "e")], schema)
    late.write.mode("append").parquet(f"{path}/g=0")
    assert decided() == [(1, "e"), (2, "d")]
    ledger.merge(spark, path, schema, newest, 0)
    assert decided() == [(1, "e"), (2, "d")] and rows(reader.select("bucket", "version")) == [(1, "c"), (2, "c")]
    removed = ledger.merge(spark, path, schema, newest, time.time() + 1)
    assert len(removed) == 2 and decided() == [(1, "e"), (2, "d")]


def run_to_its_end(query):
    query.awaitTermination()
    return [(p.numInputRows, *[(o.numRowsTotal, o.numRowsDroppedByWatermark) for o in p.stateOperators]) for p in query.recentProgress]


def test_state_shrinks_as_the_watermark_moves_and_late_signals_are_dropped(spark, tmp_path):
    folder, out, progress = tmp_path / "in", str(tmp_path / "out"), []
    lots = [
        [line(f"u{i}", str(i % 3), i) for i in range(120)],
        [line("x", "1", 600), line("y", "late", 3), line("y", "late", 100)],
        [line("z", "1", 601), line("y", "late", 500), "junk", ""],
    ]
    for n, lot in enumerate(lots):
        put(folder, f"{n}.txt", *lot)
        counted = window_counts(stream.file_lines(spark, str(folder)), timedelta(minutes=15), timedelta(minutes=30))
        progress.append(run_to_its_end(start_append_stream(counted, out, str(tmp_path / "p"))))
    totals = [p[-1][1][0] for p in progress]
    # 119 minutes less 30: five windows of three cells are out, three are open; then all of them go.
    assert totals[0] == 9 and totals[1] == 1 and totals[2] == 1
    assert [sum(step[1][1] for step in p) for p in progress] == [0, 1, 1]
    got = spark.read.parquet(out).groupBy("cell_id").agg(F.sum("signals").alias("n"))
    assert rows(got) == [("1$0", 40), ("1$1", 40), ("1$2", 40), ("1$late", 1)]
    assert spark.read.parquet(out).groupBy("window_start", "cell_id").count().where("count > 1").count() == 0


def test_locations_expire_on_the_time_of_the_signals(spark, tmp_path):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == STATE_PROVIDER
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def expired(*lot):
        put(folder, f"{len(list(folder.glob('*'))) if folder.exists() else 0}.txt", *lot)
        found = expired_locations(stream.file_lines(spark, str(folder)), HOUR, timedelta(minutes=10))
        steps = run_to_its_end(start_append_stream(found, out, str(tmp_path / "p")))
        got = spark.read.parquet(out).select("msisdn", "cell_id", F.date_format("expires", "HH:mm"))
        return rows(got), steps

    assert expired(line("a", "1", 0), line("a", "2", 5), line("b", "1", 30), "junk")[0] == []
    # The watermark comes to 12:50: nobody is an hour old.
    assert expired(line("b", "2", 60), line("c", "1", 21))[0] == []
    # 13:10 passes a's 13:05, but not c's 13:21.
    assert expired(line("d", "1", 80))[0] == [("a", "1$2", "13:05")]
    # A late signal is dropped; a comes back and is kept anew; c has expired, b expires at 14:00.
    got, steps = expired(line("c", "late", 60), line("a", "3", 100), line("e", "1", 140))
    assert got == [("a", "1$2", "13:05"), ("b", "1$2", "14:00"), ("c", "1$1", "13:21")]
    assert sum(s[1][1] for s in steps) == 1
    got, steps = expired(line("f", "1", 1000))
    assert got == [("a", "1$2", "13:05"), ("a", "1$3", "14:40"), ("b", "1$2", "14:00"), ("c", "1$1", "13:21"), ("d", "1$1", "14:20"), ("e", "1$1", "15:20")]
