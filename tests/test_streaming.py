from __future__ import annotations

import time
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from conftest import SMALL, rows
from crowdtide.operators.signals import LOG_ORDER, latest_per_user, locate_signals, parse_signals
from crowdtide.sources.location_log import read_location_log, read_rejected_signals
from crowdtide.sources.tables import read_latest_locations
from crowdtide.streaming import locations as stream
from crowdtide.streaming.ttl_state import STATE_PROVIDER, newest_rows, newest_with_ttl
from crowdtide.workload import tables as w

NOW = datetime(2024, 1, 31)


def _line(user, cell, second, seq="1"):
    stamp = f"202401301200{second:02d}"
    return f"1|{user}|1|{cell}|{stamp}|{stamp}|{stamp}|{stamp}|{seq}|x|"


def _put(folder, name, *texts):
    """A whole file appears at once, so the stream never sees half of it."""
    folder.mkdir(exist_ok=True)
    (folder.parent / name).write_text("\n".join(texts) + "\n")
    (folder.parent / name).rename(folder / name)


def test_stream_in_many_batches_equals_batch(spark, tmp_path):
    text = tmp_path / "in"
    w.signal_lines(spark, SMALL).repartition(6).write.text(str(text))
    log = str(tmp_path / "log")
    lines = stream.file_lines(spark, str(text), max_files=2)
    stream.start_location_stream(lines, log, str(tmp_path / "progress"), clock=lambda: NOW).awaitTermination()
    assert read_location_log(spark, log).select("batch_id").distinct().count() > 1
    got = read_latest_locations(spark, log, NOW, timedelta(days=40), by="event_time")
    want = latest_per_user(locate_signals(parse_signals(w.signal_lines(spark, SMALL))), order_by=LOG_ORDER)
    assert rows(got) == rows(want)


def test_late_signal_does_not_replace_a_newer_one(spark, tmp_path):
    folder, log = tmp_path / "in", str(tmp_path / "log")
    clocks = iter([NOW, NOW + timedelta(minutes=1)])
    for name, texts in [("1.txt", [_line("a", "new", 30), _line("b", "b", 1)]), ("2.txt", [_line("a", "late", 10), ""])]:
        _put(folder, name, *texts)
        stream.start_location_stream(
            stream.file_lines(spark, str(folder)), log, str(tmp_path / "p"), clock=lambda: next(clocks)
        ).awaitTermination()
    assert rows(read_latest_locations(spark, log, NOW + timedelta(minutes=2))) == [("a", "1$new"), ("b", "1$b")]
    assert rows(read_latest_locations(spark, log, NOW + timedelta(minutes=60, seconds=30))) == [("a", "1$late")]
    assert read_latest_locations(spark, log, NOW + timedelta(hours=2)).count() == 0


def test_a_batch_run_again_replaces_itself(spark, tmp_path, lines):
    log = str(tmp_path / "log")
    write = stream.append_batch(log, clock=lambda: NOW, files=1)
    batch = lines(_line("a", "1", 1), _line("a", "2", 2), "1||1|2", "broken")
    for _ in range(2):
        write(batch, 0)
    write(lines(_line("b", "3", 1)), 1)
    assert rows(read_location_log(spark, log).select("msisdn", "cell_id", "batch_id")) == [
        ("a", "1$2", 0),
        ("b", "1$3", 1),
    ]
    assert read_location_log(spark, log).where("msisdn = 'a'").first()["signal"] == _line("a", "2", 2)


def test_signals_that_cannot_be_located_are_stored_by_batch(spark, tmp_path, lines):
    log = str(tmp_path / "log")
    write = stream.append_batch(log, clock=lambda: NOW, files=1)
    timeless = "1|c|1|2|x|never|x|x|1|x|"
    batch = lines(_line("a", "1", 1), "1||1|2", "broken", timeless, "")
    for _ in range(2):
        write(batch, 0)
    write(lines(_line("b", "3", 1), "|"), 1)
    stored = read_rejected_signals(spark, log).select("value", "reject_reason", "batch_id")
    assert rows(stored) == sorted(
        [("1||1|2", "no_msisdn", 0), ("broken", "no_msisdn", 0), (timeless, "no_time", 0), ("|", "no_msisdn", 1)], key=repr
    )
    assert read_location_log(spark, log).count() == 2


def test_a_batch_run_again_in_a_later_hour_replaces_itself(spark, tmp_path, lines):
    log, batch = str(tmp_path / "log"), lines(_line("a", "1", 1))
    for clock in (NOW, NOW + timedelta(hours=2)):
        stream.append_batch(log, clock=lambda t=clock: t)(batch, 7)
    assert rows(read_location_log(spark, log).select("msisdn", "ingest_time")) == [("a", NOW + timedelta(hours=2))]


def test_files_of_a_batch_are_bounded(spark, tmp_path, lines):
    log = tmp_path / "log"
    write = stream.append_batch(str(log), clock=lambda: NOW, files=2)
    write(lines(*[_line(f"u{i}", "1", 1) for i in range(50)]), 0)
    assert 1 <= len(list(log.glob("rows/outcome=located/batch_id=0/*/*.parquet"))) <= 2


def test_newest_is_by_time_then_number_then_text(spark, lines):
    found = latest_per_user(locate_signals(parse_signals(lines(
        _line("a", "ten", 1, "10"), _line("a", "nine", 1, "9"), _line("b", "x", 1, "x"), _line("b", "one", 1, "1"), _line("b", "y", 1, "y"),
    ))), order_by=LOG_ORDER)
    assert rows(found) == [("a", "1$ten"), ("b", "1$one")]


def test_a_signal_without_a_time_is_not_the_newest(spark, lines):
    bad = "1|a|1|bad|x|x|x|x|9|x|"
    assert rows(stream.newest_in_batch(lines(_line("a", "1", 1), bad)).select("msisdn", "cell_id")) == [("a", "1$1")]
    batch = pd.DataFrame({"msisdn": ["a", "a"], "cell_id": ["1", "bad"], "event_time": [pd.Timestamp(2024, 1, 1), pd.NaT], "event_no": [1, 2], "seq": ["", ""]})
    assert newest_rows(batch)["cell_id"].tolist() == ["1"]


def test_a_hot_user_reaches_the_state_as_one_row_per_task():
    batch = pd.DataFrame({"msisdn": ["hot"] * 900 + ["b"] * 100, "cell_id": "c", "event_time": pd.Timestamp(2024, 1, 1), "event_no": range(1000), "seq": ""})
    kept = newest_rows(batch)
    assert sorted(zip(kept["msisdn"], kept["event_no"])) == [("b", 999), ("hot", 899)]


def test_running_aggregate_in_update_mode(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    _put(folder, "1.txt", _line("a", "1", 1), _line("b", "1", 5))
    for name, texts in [("2.txt", [_line("a", "2", 9)]), ("3.txt", [_line("b", "late", 2)])]:
        query = (
            stream.newest_so_far(stream.file_lines(spark, str(folder)))
            .writeStream.outputMode("update")
            .foreachBatch(lambda df, n: df.withColumn("n", F.lit(n)).write.mode("append").parquet(out))
            .option("checkpointLocation", str(tmp_path / "p"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        _put(folder, name, *texts)
    last = spark.read.parquet(out).groupBy("msisdn").agg(F.max_by("cell_id", "n").alias("cell_id"))
    assert rows(last) == [("a", "1$2"), ("b", "1$1")]


def test_kafka_settings():
    options = stream.kafka_options("h:1", "a, b", "g")
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "kafka.group.id": "g",
        "startingOffsets": "latest",
    }


def test_unwrap_drops_the_key(spark):
    messages = spark.createDataFrame([(b"k", b"text")], "key binary, value binary")
    assert rows(stream.unwrap(messages)) == [("text",)]


def test_state_keeps_the_newest_and_forgets_after_its_time(spark, tmp_path):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == STATE_PROVIDER
    folder, seen, ttl = tmp_path / "in", [], 25
    folder.mkdir()
    query = (
        newest_with_ttl(stream.file_lines(spark, str(folder)), ttl)
        .writeStream.outputMode("update")
        .foreachBatch(lambda df, n: seen.extend((r["msisdn"], r["cell_id"]) for r in df.collect()))
        .option("checkpointLocation", str(tmp_path / "p"))
        .trigger(processingTime="1 second")
        .start()
    )

    def wait_for(row):
        deadline = time.time() + 60
        while row not in seen and time.time() < deadline:
            assert query.exception() is None
            time.sleep(0.2)
        assert row in seen

    try:
        _put(folder, "1.txt", _line("a", "1", 30), _line("b", "1", 30))
        wait_for(("a", "1$1"))
        _put(folder, "2.txt", _line("a", "old", 10), _line("b", "2", 40))
        wait_for(("b", "1$2"))
        assert sorted(seen) == [("a", "1$1"), ("b", "1$1"), ("b", "1$2")]
        time.sleep(ttl + 1)
        _put(folder, "3.txt", _line("a", "old", 10))
        wait_for(("a", "1$old"))
    finally:
        query.stop()
