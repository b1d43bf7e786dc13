"""The engine's inputs, derived whole from the benchmark tables.

Signals come from ``events``, the area bridges and number prefixes from ``nation``, the label files
from ``customer`` and ``supplier``.
"""

from __future__ import annotations

import os
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdtide.functions import format_time, pseudonym
from crowdtide.operators.counts import STANDARD_LABELS, parse_labels
from crowdtide.operators.rollup import Bridges
from crowdtide.operators.signals import latest_locations
from crowdtide.operators.snapshot import build_snapshot

AS_OF = datetime(2024, 1, 15, 12)
DAY = timedelta(hours=24)
HOUR = timedelta(hours=1)
RANGE = (datetime(2024, 1, 1), datetime(2024, 1, 31))


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; its schema is looked up in the files once."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def phone(number: Column) -> Column:
    """The phone number of a user or customer."""
    return (F.lit(18600000000) + (number % 30) * 10000 + number).cast("string")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def signal_lines(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events`` as signal text: a sign-up has no phone number, an error has no cell."""
    return events_as_lines(table(spark, sf_dir, "events"), keep)


def events_as_lines(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    placed = F.col("event_type") != "error"
    known = F.col("event_type") != "signup"
    k, stamp = F.col("k"), F.col("stamp")
    fields = [
        F.lit("1"),
        F.when(known, phone(F.col("user_id"))).otherwise(""),
        F.when(placed, (F.lit(43020) + k % 5).cast("string")).otherwise(""),
        F.when(placed, (F.lit(10000) + k).cast("string")).otherwise(""),
        stamp,
        stamp,
        stamp,
        stamp,
        F.col("event_id").cast("string"),
        F.col("event_type"),
    ]
    read_once = events.select("*", _k().alias("k"), format_time(F.col("ts")).alias("stamp"))
    return read_once.select(*keep, F.concat_ws("|", *fields).alias("value"))


#: Arrivals come in so many lots; signals are late by up to 40 hours, and a watermark waits for six.
LOTS, DELAY = 4, timedelta(hours=6)


def arrivals(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``signal_lines`` with the ``lot`` they arrive in: every tenth 40 hours after its time, others 2 hours after or at once."""
    hours = F.when(F.col("event_id") % 10 == 0, 40).when(F.col("event_id") % 10 == 5, 2).otherwise(0)
    day = F.date_diff(F.timestamp_add("HOUR", hours, F.col("ts")).cast("date"), F.lit("2024-01-01").cast("date"))
    lot = F.least(F.greatest(F.call_function("div", day, F.lit(8)), F.lit(0)), F.lit(LOTS - 1)).cast("int")
    return events_as_lines(table(spark, sf_dir, "events").withColumn("lot", lot), (*keep, "lot"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed locations, with the same cells and users as ``signal_lines``."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") != "signup")
    k = F.col("k")
    cell = F.concat((F.lit(43020) + k % 5).cast("string"), F.lit("$"), (F.lit(10000) + k).cast("string"))
    return events.select("user_id", "event_type", "ts", "event_id", _k().alias("k")).select(
        phone(F.col("user_id")).alias("msisdn"),
        F.when(F.col("event_type") != "error", cell).otherwise("$").alias("cell_id"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("seq"),
    )


def snapshot(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF, ttl: timedelta = DAY) -> DataFrame:
    return build_snapshot(latest_locations(signals(spark, sf_dir), as_of, ttl), as_of)


def location_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ``msisdn,cell`` text, with lines that have no user, no cell or a field too many."""
    kind = F.col("event_type")
    user = F.when(kind == "signup", "").otherwise(phone(F.col("user_id")))
    cell = F.concat(F.lit("43020$"), (F.lit(10000) + _k()).cast("string"))
    rest = F.when(kind == "error", "").when(kind == "purchase", F.concat(cell, F.lit(","), kind)).otherwise(cell)
    return table(spark, sf_dir, "events").select("event_id", F.concat(user, F.lit(","), rest).alias("value"))


def prefix_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.col("n_regionkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("18600"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("prefix7"),
        F.when(region == 0, "310000")
        .when(region == 4, "")
        .otherwise((F.lit(110000) + region * 10000).cast("string"))
        .alias("home_region"),
    )


def _nation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four cells per nation: ``k`` runs on through the nations, ``j`` from 0 to 3 within each."""
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .select(key.alias("n"), F.col("n_regionkey").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j"))
        .withColumn("k", F.col("n") * 4 + F.col("j"))
        .withColumn(
            "cell",
            F.concat((F.lit(43020) + F.col("k") % 5).cast("string"), F.lit("$"), (F.lit(10000) + F.col("k")).cast("string")),
        )
    )


def _edges(rows: DataFrame, source: Column, target: Column, ratio: Column | None = None) -> DataFrame:
    weight = F.lit(None).cast("double") if ratio is None else ratio.cast("double")
    return rows.select(source.alias("from_id"), target.alias("to_id"), weight.alias("ratio"))


def _named(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def bridges(spark: SparkSession, sf_dir: str) -> Bridges:
    """Even cells lie half in the next grid; some cells also belong to a grid-based district."""
    cells = _nation_cells(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_regionkey").alias("r"))
    cell, n, k = F.col("cell"), F.col("n"), F.col("k")
    even = k % 2 == 0
    cell_grid = _edges(cells, cell, _named("G", n), F.when(even, 0.5)).unionByName(
        _edges(cells.where(even), cell, _named("G", n + 1), F.lit(0.5))
    )
    grid_district = _edges(nation, _named("G", n), _named("CAN_", F.lit(310100) + F.col("r"))).unionByName(
        _edges(nation, _named("G", n), _named("DIS_", n % 3))
    )
    cell_district = _edges(cells, cell, _named("DIS_F", k % 10)).unionByName(
        _edges(cells.where(F.col("j") == 3), cell, _named("DIS_", n % 3))
    )
    tops = cells.select((k % 10).alias("d")).distinct()
    district_parent = _edges(tops, _named("DIS_F", F.col("d")), F.when(F.col("d") < 5, "DIS_TOP_A").otherwise("DIS_TOP_B"))
    return Bridges(cell_grid, grid_district, cell_district, district_parent)


def label_lines(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One label file from all customers, one from all suppliers, with short rows in both."""
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    balance = F.col("c_acctbal")
    first = F.concat_ws(
        "|",
        pseudonym(phone(F.col("c_custkey"))),
        (F.col("c_custkey") % 6).cast("string"),
        (F.col("c_nationkey") % 2).cast("string"),
        F.when(balance < 0, "neg").when(balance < 1000, "").otherwise("pos"),
        F.col("c_mktsegment"),
        F.when(F.col("c_nationkey") < 20, F.concat((F.col("c_nationkey") % 4).cast("string"), F.lit("G|flux"))),
    )
    nation = F.col("s_nationkey")
    second = F.concat_ws(
        "|",
        pseudonym(phone(F.col("s_suppkey"))),
        _named("d", nation % 4),
        _named("h", nation),
        _named("w", nation % 6),
        F.when(nation >= 8, _named("z", nation % 2)),
        F.when(nation >= 16, F.lit("x")),
        F.when(nation >= 16, _named("r", nation % 3)),
    )
    return [customer.select(first.alias("value")), supplier.select(second.alias("value"))]


def labels(spark: SparkSession, sf_dir: str):
    lines = label_lines(spark, sf_dir)
    return [(spec, parse_labels(text, spec)) for spec, text in zip(STANDARD_LABELS, lines, strict=True)]


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    events = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", _k().alias("k"))
    return events.select(
        F.substring(F.col("ts").cast("string"), 1, 10).alias("date"),
        F.col("user_id").cast("string").alias("user"),
        F.col("event_type").alias("keyword"),
        F.get(F.array(F.lit("beijing"), F.lit("shanghai"), F.lit("shenzhen")), k % 3).alias("city"),
        F.get(F.array(F.lit("android"), F.lit("ios")), k % 2).alias("platform"),
        F.get(F.array(F.lit("1.0"), F.lit("1.2"), F.lit("1.5"), F.lit("2.0")), k % 4).alias("version"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 90).cast("int").alias("age"),
        (F.col("c_nationkey") % 2).cast("string").alias("sex"),
    )


def people_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``people`` as text: of every ten lines one has a word for its age, one lacks a field, one has a field too many."""
    key = F.col("c_custkey")
    kind, age, sex = key % 10, (key % 90).cast("string"), (F.col("c_nationkey") % 2).cast("string")
    name = F.when(kind == 7, F.concat(F.lit('"'), "c_name", F.lit(', junior"'))).otherwise(F.col("c_name"))
    age = F.when(kind == 1, "old").when(kind == 5, "").otherwise(age)
    line = F.when(kind == 2, F.concat_ws(",", name, age)).when(kind == 3, F.concat_ws(",", name, age, sex, sex)).otherwise(F.concat_ws(",", name, age, sex))
    return table(spark, sf_dir, "customer").select(line.alias("value"))


def graph_flow(root: str) -> dict:
    """People in two files and nations in a third, to a sink of people with their nation and one of the aged."""

    def node(name: str, sep: str, *columns: str, **more) -> dict:
        typed = [{"name": c.removesuffix("#"), "dataType": int(c.endswith("#"))} for c in columns]
        named = [{"columns": [{"name": c["name"]} for c in typed]}]
        return {"id": name, "delimiter": sep, "filePath": root, "filePattern": f"{name}_#flow.startDataTime#.txt", "inputGroups": [{"columns": typed}], "outputGroups": named, **more}

    return {
        "source": [
            node("even", ",", "name", "age#", "nation#"),
            node("odd", "|", "name", "age#", "nation#"),
            node("nations", ";", "nation#", "country"),
        ],
        "channel": [
            {"id": "adults", "inputs": ["even", "odd"], "filter": "age >= 18"},
            {"id": "placed", "inputs": ["adults", "nations"], "on": ["nation"], "filter": "country <> 'CHINA'"},
        ],
        "sink": [
            node("by_country", ",", "name", "country", "age#", inputs=["placed"]),
            node("aged", "|", "name", "age#", inputs=["adults"]),
        ],
    }


def flow_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    customer, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    rows = customer.select(F.col("c_name").alias("name"), (key % 90).cast("int").alias("age"), F.col("c_nationkey").alias("nation"), key.alias("key"))
    halves = [rows.where(F.col("key") % 2 == n).drop("key") for n in (0, 1)]
    return [*halves, table(spark, sf_dir, "nation").select("n_nationkey", "n_name")]


def time_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day: the text range from the first event to the last."""
    day = F.substring(format_time(F.col("ts")), 1, 8).alias("day")
    spans = table(spark, sf_dir, "events").groupBy("user_id", day).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return spans.select("user_id", "day", F.concat_ws("-", format_time(F.col("lo")), format_time(F.col("hi"))).alias("span"))


def district_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    grid = _named("G", F.col("s_suppkey"))
    district_grid = supplier.select(grid.alias("gridid"), _named("D", F.col("s_nationkey")).alias("disid"))
    district_info = nation.select(
        _named("D", F.col("n_nationkey")).alias("disid"),
        F.when(F.col("n_regionkey") < 3, "1").otherwise("0").alias("ispoi"),
        F.when(F.col("n_nationkey") < 20, "0").otherwise("1").alias("disabled"),
    )
    grid_info = supplier.select(
        grid.alias("gridid"),
        F.col("s_nationkey").cast("string").alias("district"),
        F.when(F.col("s_acctbal") >= 0, "1").otherwise("2").alias("gtype"),
        F.when(F.col("s_acctbal") < 9000, "0").otherwise("1").alias("disabled"),
    )
    return district_grid, district_info, grid_info
