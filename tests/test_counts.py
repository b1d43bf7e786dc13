from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from crowdtide.operators import counts
from crowdtide.operators.counts import STANDARD_LABELS, LabelSpec

PEOPLE = "user_hash string, cell_id string, prefix7 string, stat_time string"
REGIONS = "prefix7 string, home_region string"
T = "20240115120000"


@pytest.mark.parametrize(
    "line, values",
    [
        ("u|1|2|3|4|5|6", ["4", "1", "2", "3", "6"]),
        ("u|1|2|3|4", ["4", "1", "2", "3"]),
        ("u|1|2|3", []),
        ("u", []),
        ("u||2|3|4|5|6", ["4", "NULL_VALUE", "2", "3", "6"]),
        ("u|1|2|3|4|5|", ["4", "1", "2", "3", "NULL_VALUE"]),
        ("u|1|2|3|4|5|6|7|8", ["4", "1", "2", "3", "6|7|8"]),
    ],
)
def test_label_rows_of_any_length(lines, line, values):
    row = counts.parse_labels(lines(line), STANDARD_LABELS[1]).first()
    assert (row["user_hash"], row["values"]) == ("u", values)


def test_label_row_without_user_joins_to_nobody(spark, lines):
    labels = [(STANDARD_LABELS[0], counts.parse_labels(lines("|1|2|3|4|5|6", ""), STANDARD_LABELS[0]))]
    people = spark.createDataFrame([("", "c", "p", T), (None, "c", "p", T)], PEOPLE)
    assert counts.label_counts(people, labels).count() == 0


def test_comma_separated_labels(lines):
    spec = LabelSpec.from_config({"names": "a, b", "positions": "2,1", "width": "3", "sep_index": "1"})
    row = counts.parse_labels(lines("u,x|y,z"), spec).first()
    assert (row["user_hash"], row["values"]) == ("u", ["z", "x|y"])


@pytest.mark.parametrize(
    "fields",
    [
        {"names": (), "positions": (), "width": 1},
        {"names": ("a",), "positions": (1, 2), "width": 3},
        {"names": ("a",), "positions": (3,), "width": 3},
        {"names": ("a",), "positions": (1,), "width": 3, "sep": ";"},
    ],
)
def test_bad_label_specs(fields):
    with pytest.raises(ValueError):
        LabelSpec(**fields)


def test_region_counts_by_hand(spark):
    people = spark.createDataFrame(
        [
            ("u1", "c", "p1", T),
            ("u2", "c", "p1", T),
            ("u3", "c", "p2", T),
            ("u4", "$", "p3", T),
            ("u5", "", "none", T),
        ],
        PEOPLE,
    )
    regions = spark.createDataFrame([("p1", "310000"), ("p2", "320000"), ("p3", "")], REGIONS)
    got = rows(counts.region_counts(people, regions).select("area_id", "label", "value", "cnt"))
    assert got == [
        ("NULL_VALUE", "ufrom", "NULL_VALUE", 2),
        ("NULL_VALUE", "ufrom_short", "NULL_VALUE", 2),
        ("NULL_VALUE", "uv", "uv", 2),
        ("c", "ufrom", "310000", 2),
        ("c", "ufrom", "320000", 1),
        ("c", "ufrom_short", "310000", 2),
        ("c", "ufrom_short", "999999", 1),
        ("c", "uv", "uv", 3),
    ]


def test_repeated_prefix_multiplies(spark):
    people = spark.createDataFrame([("u1", "c", "p", T), ("u2", "c", "p", T)], PEOPLE)
    regions = spark.createDataFrame([("p", "310000"), ("p", "320000")], REGIONS)
    got = {(r["label"], r["value"]): r["cnt"] for r in counts.region_counts(people, regions).collect()}
    assert got[("uv", "uv")] == 4 and got[("ufrom", "310000")] == 2 and got[("ufrom", "320000")] == 2


def test_labels_by_hand(spark, lines):
    spec = LabelSpec(names=("gender", "age"), positions=(1, 2), width=3)
    again = LabelSpec(names=("gender",), positions=(1,), width=2)
    people = spark.createDataFrame(
        [("u1", "c", "p", T), ("u2", "c", "p", T), ("u3", "$", "p", T), ("nolabels", "c", "p", T)], PEOPLE
    )
    labels = [
        (spec, counts.parse_labels(lines("u1|男|30, or so", "u2|男|", "u3|女", "stranger|男|1"), spec)),
        (again, counts.parse_labels(lines("u2|男"), again)),
    ]
    got = rows(counts.label_counts(people, labels).select("area_id", "label", "value", "cnt"))
    assert got == sorted(
        [
            ("NULL_VALUE", "gender", "女", 1),
            ("c", "age", "30, or so", 1),
            ("c", "age", "NULL_VALUE", 1),
            ("c", "gender", "男", 3),
        ],
        key=repr,
    )


def test_one_cell_holding_most_people(spark):
    people = spark.range(30_000).select(
        F.col("id").cast("string").alias("user_hash"),
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("cell_id"),
        F.lit("p").alias("prefix7"),
        F.lit(T).alias("stat_time"),
    )
    regions = spark.createDataFrame([("p", "310000")], REGIONS)
    spec = LabelSpec(names=("kind",), positions=(1,), width=2)
    labels = people.select(F.col("user_hash"), F.array(F.lit("x")).alias("values"))
    got = counts.area_counts(people, regions, [(spec, labels)]).where("area_id = 'hot'")
    assert {(r["label"], r["cnt"]) for r in got.collect()} == {
        ("uv", 21_000), ("ufrom", 21_000), ("ufrom_short", 21_000), ("kind", 21_000)
    }
    assert counts.head_counts(people).where("area_id = 'hot'").first()["cnt"] == 21_000


def test_groups_of_many_times_are_counted_task_by_task(spark, lines):
    """The same counts, and before people become label rows those of a time and cell lie in one partition."""
    times = [f"202401151{i}0000" for i in range(8)]
    people = spark.createDataFrame([(f"u{i % 9}", f"c{i % 3}", "1860001", t) for i in range(40) for t in times], PEOPLE)
    prefixes = spark.createDataFrame([("1860001", "310000"), ("1860001", None)], REGIONS)
    spec = STANDARD_LABELS[0]
    labels = [(spec, counts.parse_labels(lines(*(f"u{i}|{i % 2}|a|b|c|d|e" for i in range(7))), spec))]
    keys = ("stat_time", "cell_id")
    gathered = counts.area_counts(people, prefixes, labels, gather=keys)
    assert rows(gathered) == rows(counts.area_counts(people, prefixes, labels)) and gathered.count() > 0
    placed = counts.labelled(people, labels, keys, keys).select(*keys, F.spark_partition_id().alias("n")).distinct()
    assert placed.count() == 24 and placed.select("n").distinct().count() > 1
