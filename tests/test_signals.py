from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from crowdtide import schemas as S
from crowdtide.operators import signals as sig
from crowdtide.operators import snapshot as snap

GOLDEN = "1|18616994978|43020|14581|20170425190252|20170425190452|20170425180614|20170425192411|123||"


def test_parse_known_line(lines):
    row = sig.parse_signals(lines(GOLDEN)).first()
    assert row["msisdn"] == "18616994978" and row["appid"] == "" and row["websiteid"] == ""
    assert row["endtime"] == "20170425190452"
    located = sig.locate_signals(sig.parse_signals(lines(GOLDEN))).first()
    assert located["cell_id"] == "43020$14581"
    assert located["event_time"] == datetime(2017, 4, 25, 19, 4, 52)


def test_short_long_and_blank_lines(lines):
    df = sig.parse_signals(lines("1|a", "1|b|c|d|e|f|g|h|i|j|k|extra", "", None))
    got = rows(df.select("msisdn", "lac", "websiteid"))
    assert got == [("a", "", ""), ("b", "c", "k")]


def test_round_trip(lines):
    full = sig.serialise_signals(sig.parse_signals(lines(GOLDEN)))
    assert full.first()[0] == GOLDEN
    short = sig.serialise_signals(sig.parse_signals(lines("1|a")))
    assert short.first()[0] == "1|a" + "|" * 9
    nulls = sig.parse_signals(lines(GOLDEN)).withColumn("appid", F.lit(None).cast("string"))
    assert sig.serialise_signals(nulls).first()[0] == GOLDEN


def test_signal_without_user_is_not_located(lines):
    assert sig.locate_signals(sig.parse_signals(lines("1||43020|1|||||"))).count() == 0


@pytest.fixture
def located(spark):
    noon = datetime(2024, 1, 1, 12)
    minute = timedelta(minutes=1)
    data = [
        ("a", "old", noon - 30 * minute, 1),
        ("a", "new", noon - 5 * minute, 2),
        ("a", "later", noon + minute, 3),
        ("b", "tie1", noon, 7),
        ("b", "tie2", noon, 8),
        ("c", "expired", noon - 60 * minute, 1),
        ("d", "edge", noon - 59 * minute, 1),
    ]
    return spark.createDataFrame(data, "msisdn string, cell_id string, event_time timestamp_ntz, seq long")


def test_latest_respects_time_ties_and_ttl(located):
    got = rows(sig.latest_locations(located, datetime(2024, 1, 1, 12)))
    assert got == [("a", "new"), ("b", "tie2"), ("d", "edge")]


def test_one_user_with_most_signals(spark):
    hot = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("msisdn"),
        F.col("id").cast("string").alias("cell_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("event_time"),
        F.col("id").alias("seq"),
    )
    got = sig.latest_per_user(hot)
    assert got.where("msisdn = 'hot'").first()["cell_id"] == "49999"
    assert got.count() == hot.select("msisdn").distinct().count()


def test_snapshot_rows(spark):
    locations = spark.createDataFrame(
        [("18601723326", "1$2"), ("", "1$2"), (None, "1$2"), ("123", "")], "msisdn string, cell_id string"
    )
    got = {tuple(r) for r in snap.build_snapshot(locations, datetime(2017, 1, 1, 12)).collect()}
    assert got == {
        ("73CD34AC44E37A62982440ECD8C3A67B", "1$2", "1860172", "20170101120000"),
        ("202CB962AC59075B964B07152D234B70", "", "123", "20170101120000"),
    }


def test_malformed_location_lines(lines):
    df = snap.split_location_lines(lines("186,1$2", "186", "186,", ",1$2", "186,1$2,x", "", "186,1$2,,", None))
    assert rows(snap.accepted(df)) == [("186", "1$2"), ("186", "1$2")]
    reasons = rows(snap.rejected(df).select("line", "reject_reason"))
    assert len(reasons) == 6
    assert (",1$2", snap.REASON_USER) in reasons
    assert ("186,1$2,x", snap.REASON_FIELDS) in reasons


def test_field_names_are_the_signal_order():
    assert len(S.SIGNAL_FIELDS) == 11 and S.SIGNAL_FIELDS[1] == "msisdn"
