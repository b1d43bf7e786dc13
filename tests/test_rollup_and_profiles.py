from __future__ import annotations

import json
from functools import reduce
from operator import add

from pyspark.sql import functions as F

from conftest import SMALL, rows
from crowdtide.operators import profile, rollup
from crowdtide.workload import catalog
from crowdtide.workload import tables as w

STATS = "stat_time string, area_id string, label string, value string, cnt long"
EDGES = "from_id string, to_id string, ratio double"
T = "t"


def _stats(spark, *data):
    return spark.createDataFrame([(T, *r) for r in data], STATS)


def _flat(df):
    return rows(df.select("area_id", "label", "value", "cnt"))


def test_weights_round_half_up_after_the_sum(spark):
    stats = _stats(spark, ("c1", "uv", "uv", 1), ("c2", "uv", "uv", 2), ("c3", "uv", "uv", 1), ("lost", "uv", "uv", 9))
    bridge = spark.createDataFrame(
        [("c1", "g1", 0.5), ("c1", "g2", 0.5), ("c2", "g1", None), ("c3", "g3", 0.4), ("c3", "", 1.0), (None, "g", 1.0)],
        EDGES,
    )
    assert _flat(rollup.roll_up(stats, bridge)) == [
        ("NULL_VALUE", "uv", "uv", 1),
        ("g1", "uv", "uv", 3),
        ("g2", "uv", "uv", 1),
        ("g3", "uv", "uv", 0),
    ]


def test_product_keeps_floating_point_value(spark):
    stats = _stats(spark, ("c", "uv", "uv", 50))
    bridge = spark.createDataFrame([("c", "g", 0.29)], EDGES)
    assert 50 * 0.29 < 14.5
    assert rollup.roll_up(stats, bridge).first()["cnt"] == 14


def test_sum_does_not_depend_on_order(spark):
    stats = _stats(spark, *[(f"c{i}", "uv", "uv", 1) for i in range(10)])
    bridge = spark.createDataFrame([(f"c{i}", "g", 0.15) for i in range(10)], EDGES)
    assert reduce(add, [0.15] * 10) < 1.5
    assert rollup.roll_up(stats, bridge).first()["cnt"] == 2


def test_steps_start_from_rounded_counts(spark):
    stats = _stats(spark, ("c1", "uv", "uv", 1))
    half = spark.createDataFrame([("c1", "g1", 0.5), ("c1", "g2", 0.5)], EDGES)
    up = spark.createDataFrame([("g1", "d", None), ("g2", "d", None)], EDGES)
    assert rollup.roll_up(rollup.roll_up(stats, half), up).first()["cnt"] == 2


def test_city_takes_administrative_districts_only(spark):
    stats = _stats(spark, ("CAN_1", "uv", "uv", 2), ("CAN_2", "uv", "uv", 3), ("DIS_1", "uv", "uv", 7))
    assert _flat(rollup.city_total(stats)) == [("DIS_ALL", "uv", "uv", 5)]


def test_chain_equals_separate_steps(spark):
    cells, bridges = catalog.cell_stats(spark, SMALL), w.bridges(spark, SMALL)
    grid = rollup.roll_up(cells, bridges.cell_grid)
    from_grid = rollup.roll_up(grid, bridges.grid_district)
    from_cell = rollup.roll_up(cells, bridges.cell_district)
    steps = {
        ("grid", "grid"): grid,
        ("grid", "sub"): from_grid,
        ("city", "sub"): rollup.city_total(from_grid),
        ("cell", "sub"): from_cell,
        ("parent", "sub"): rollup.roll_up(from_cell, bridges.district_parent),
    }
    together = rollup.area_stats(cells, bridges)
    for (branch, level), df in steps.items():
        part = together.where((F.col("branch") == branch) & (F.col("level") == level))
        assert _flat(part) == _flat(df), (branch, level)
    assert together.count() == sum(df.count() for df in steps.values())


def test_chain_with_blank_targets_and_shared_names(spark):
    """A grid and a district of the same name, and a blank target on the first step."""
    stats = _stats(spark, ("c", "uv", "uv", 4), ("d", "uv", "uv", 1))
    bridges = rollup.Bridges(
        cell_grid=spark.createDataFrame([("c", "x", 0.5), ("d", "", None)], EDGES),
        grid_district=spark.createDataFrame([("x", "CAN_1", None), ("NULL_VALUE", "CAN_1", None)], EDGES),
        cell_district=spark.createDataFrame([("c", "x", None)], EDGES),
        district_parent=spark.createDataFrame([("x", "top", None)], EDGES),
    )
    got = rows(rollup.area_stats(stats, bridges).select("level", "branch", "area_id", "cnt"))
    assert got == sorted(
        [
            ("grid", "grid", "x", 2),
            ("grid", "grid", "NULL_VALUE", 1),
            ("sub", "grid", "CAN_1", 3),
            ("sub", "city", "DIS_ALL", 3),
            ("sub", "cell", "x", 4),
            ("sub", "parent", "top", 4),
        ],
        key=repr,
    )


def test_district_bridge(spark):
    dg = spark.createDataFrame([("g1", "d1"), ("g2", "d2"), ("g3", "d3")], "gridid string, disid string")
    info = spark.createDataFrame(
        [("d1", "1", "0"), ("d2", "0", "0"), ("d3", "1", "1")], "disid string, ispoi string, disabled string"
    )
    grids = spark.createDataFrame(
        [("g1", "310101", "1", "0"), ("g2", "310101", "2", "0"), ("g3", "310101", "1", "1")],
        "gridid string, district string, gtype string, disabled string",
    )
    assert rows(rollup.derive_district_bridge(dg, info, grids)) == [("g1", "CAN_310101", 1.0), ("g1", "d1", 1.0)]


def test_profile_merges_values_with_sorted_keys(spark):
    stats = _stats(spark, ("43044$11182", "gender", "男", 10), ("43044$11182", "gender", "女", 5), ("a", "uv", "uv", 1))
    got = rows(profile.row_keys(profile.profiles(stats)).select("row_key", "profile_json"))
    assert got == [("43044$11182-gender-t", '{"女":5,"男":10}'), ("a-uv-t", '{"uv":1}')]


def test_profile_takes_the_highest_branch_per_value(spark):
    data = [
        (T, "d", "age", "20", 1, "grid", "sub"),
        (T, "d", "age", "20", 2, "cell", "sub"),
        (T, "d", "age", "30", 3, "grid", "sub"),
        (T, "d", "age", "40", 4, "parent", "sub"),
        (T, "d", "age", "40", 5, "cell", "sub"),
    ]
    stats = spark.createDataFrame(data, STATS + ", branch string, level string")
    assert json.loads(profile.profiles(stats).first()["profile_json"]) == {"20": 2, "30": 3, "40": 4}


def test_awkward_values_stay_whole(spark):
    stats = _stats(spark, ("a", "age", 'x"y,z##1@;', 1))
    assert json.loads(profile.profiles(stats).first()["profile_json"]) == {'x"y,z##1@;': 1}


def test_invariants_on_the_tables(spark):
    cells = catalog.cell_stats(spark, SMALL)
    people = w.snapshot(spark, SMALL)
    total = {r["label"]: r["n"] for r in cells.groupBy("label").agg(F.sum("cnt").alias("n")).collect()}
    assert total["uv"] == total["ufrom"] == total["ufrom_short"] == people.count()
    areas = catalog.area_stats(spark, SMALL)
    members = areas.where("area_id like 'CAN%' and branch = 'grid' and level = 'sub'").agg(F.sum("cnt")).first()[0]
    assert areas.where("area_id = 'DIS_ALL'").agg(F.sum("cnt")).first()[0] == members
