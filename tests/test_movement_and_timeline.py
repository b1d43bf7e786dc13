from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from crowdtide.operators import counts, joins, movement, timeline
from crowdtide.operators.counts import LabelSpec

SNAP = "user_hash string, cell_id string, prefix7 string, stat_time string"
EDGES = "from_id string, to_id string, ratio double"
PLACED = "user_hash string, area_id string, prefix7 string"


def test_stayed_and_moved_by_hand(spark):
    now = spark.createDataFrame([("a", "d1", "p"), ("a", "d2", "p"), ("b", "d1", "p"), ("c", "d3", "p")], PLACED)
    then = spark.createDataFrame([("a", "d1", "p"), ("a", "d3", "p"), ("b", "d2", "p")], PLACED)
    assert rows(movement.stayed(now, then)) == [("a", "d1", "p")]
    # a is in d1 and d2 now, d1 and d3 before: three of the four pairs differ.
    assert rows(movement.moved(now, then)) == [
        ("a", "d1", "p"),
        ("a", "d2", "p"),
        ("a", "d2", "p"),
        ("b", "d1", "p"),
        ("c", "d3", "p"),
    ]
    assert rows(movement.moved_strict(now, then)) == [("a", "d2", "p"), ("b", "d1", "p"), ("c", "d3", "p")]


def test_stayed_keeps_multiplicity(spark):
    twice = spark.createDataFrame([("a", "d", "p"), ("a", "d", "p")], PLACED)
    assert movement.stayed(twice, twice).count() == 4


def test_locate_is_many_to_many_and_drops_unknown_cells(spark):
    snap = spark.createDataFrame([("a", "c1", "p", "t"), ("b", "c2", "p", "t"), ("c", "?", "p", "t")], SNAP)
    bridge = spark.createDataFrame([("c1", "d1", None), ("c1", "d2", None), ("c2", None, None)], EDGES)
    assert rows(movement.locate(snap, bridge)) == [("a", "d1", "p"), ("a", "d2", "p"), ("b", "", "p")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_broadcast_and_salted_joins_agree(spark, how):
    facts = spark.range(20_000).select(
        F.col("id").alias("user"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k")
    )
    dim = spark.range(40).select(F.col("id").alias("k"), F.explode(F.array(F.lit("x"), F.lit("y"))).alias("v"))
    small = joins.dimension_join(facts, dim, "k", how, spread_by="user")
    large = joins.dimension_join(facts, dim, "k", how, spread_by="user", limit_bytes=0, salts=5)
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()
    key = ["user", "k", "v"]
    assert small.select(key).exceptAll(large.select(key)).count() == 0
    assert small.count() == large.count()


def test_measured_bytes_grows_with_the_rows(spark):
    one = joins.measured_bytes(spark.range(10).select(F.lit("abc").alias("s")))
    assert one == 10 * (3 + 16)
    assert joins.measured_bytes(spark.range(0).select(F.lit("abc").alias("s"))) == 0


def test_lags_due():
    assert set(movement.lags_for(datetime(2024, 1, 1, 12))) == {"stayed_15m", "stayed_60m"}
    assert set(movement.lags_for(datetime(2024, 1, 1, 12, 15))) == {"stayed_15m"}


def test_movement_counts_equal_counting_located_people(spark):
    rng = random.Random(7)
    times = ["20240101110000", "20240101114500", "20240101120000", "20240101121500"]
    data = []
    for t in times:
        for u in range(40):
            if rng.random() < 0.8:
                data.append((f"u{u}", rng.choice(["c1", "c2", "c3", "$", ""]), f"p{u % 3}", t))
    snaps = spark.createDataFrame(data, SNAP)
    bridge = spark.createDataFrame(
        [("c1", "d1", None), ("c1", "d2", None), ("c2", "d2", None), ("c2", "", None), ("c1", "d1", None), ("$", "d1", None)],
        EDGES,
    )
    regions = spark.createDataFrame([("p0", "310000"), ("p1", "1"), ("p1", "2")], "prefix7 string, home_region string")
    spec = LabelSpec(names=("kind", "tone"), positions=(1, 2), width=3)
    labels = [(spec, counts.parse_labels(
        spark.createDataFrame([(f"u{u}|k{u % 2}|",) for u in range(0, 40, 2)], "value string"), spec
    ))]
    got = movement.movement_counts(snaps, movement.LAGS, bridge, regions, labels)
    columns = ["area_id", "label", "value", "cnt"]

    def at(t):
        return movement.locate(snaps.where(F.col("stat_time") == t), bridge)

    def expected(people):
        dated = people.withColumn("stat_time", F.lit("t"))
        return rows(counts.area_counts(dated, regions, labels, area="area_id").select(columns))

    def found(t, kind):
        return rows(got.where((F.col("stat_time") == t) & (F.col("movement") == kind)).select(columns))

    for t, back15, back60 in [
        ("20240101120000", "20240101114500", "20240101110000"),
        ("20240101121500", "20240101120000", None),
    ]:
        assert found(t, "current") == expected(at(t)) != []
        assert found(t, "stayed_15m") == expected(movement.stayed(at(t), at(back15))) != []
        want = expected(movement.stayed(at(t), at(back60))) if back60 else []
        assert found(t, "stayed_60m") == want
    assert found("20240101130000", "current") == []


@pytest.mark.parametrize(
    "span, times",
    [
        ("20170101000000-20170101010000", 5),
        ("20170101000000-20170101001459", 1),
        ("20170101010000-20170101000000", 1),
        ("20170101000000", 1),
        ("", 0),
        (None, 0),
        ("2017-20170101000000", 0),
        ("20170101000000-", 0),
        ("20171301000000-20170101000000", 0),
    ],
)
def test_time_ranges(lines, span, times):
    got = timeline.expand_ranges(lines(span), "value").collect()
    assert len(got) == times
    if times:
        assert got[0]["stat_time"] == span[:14]


@pytest.mark.parametrize("ttl", [timedelta(minutes=10), timedelta(minutes=15), timedelta(minutes=50), timedelta(hours=3)])
def test_latest_over_range_equals_looking_at_each_time(spark, ttl):
    rng = random.Random(int(ttl.total_seconds()))
    begin, end = datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 9, 7)
    data = []
    for n in range(400):
        user = "hot" if n % 3 == 0 else f"u{rng.randrange(15)}"
        moment = begin - timedelta(hours=4) + timedelta(seconds=rng.choice([0, 0.25]) + 60 * rng.randrange(480))
        data.append((user, f"c{n}", moment, n))
    data += [("edge", "on", begin, 1000), ("edge", "end", begin + 3 * timedelta(hours=1), 1001)]
    signals = spark.createDataFrame(data, "msisdn string, cell_id string, event_time timestamp_ntz, seq long")
    got = {tuple(r) for r in timeline.latest_over_range(signals, begin, end, ttl=ttl).collect()}

    want = set()
    moment = begin
    while moment <= end:
        newest = {}
        for user, cell, when, seq in data:
            if moment - ttl < when <= moment and (when, seq) > newest.get(user, (datetime.min, -1, ""))[:2]:
                newest[user] = (when, seq, cell)
        want |= {(user, cell, moment) for user, (_, _, cell) in newest.items()}
        moment += timedelta(minutes=15)
    assert got == want != set()


def test_tracking_moves_each_row_once(spark):
    """One exchange, by user, and only after it are rows sent to later times."""
    snap = spark.createDataFrame([("a", "c1", "p", "20240115120000"), ("a", "c1", "p", "20240115121500")], SNAP)
    tracked = movement.track(snap, movement.LAGS)
    assert [r["stayed_15m"] for r in tracked.orderBy("stat_time").collect()] == [None, "c1"]
    plan = tracked._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange" if "Exchange" in plan else "Repartition")
    assert tracked._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
