"""Sketches, filters by tables of values, buckets, typed lines and flow graphs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from crowdtide.operators import adhoc, counts, sketches
from crowdtide.plans import flow as flows
from crowdtide.sinks import tables as sinks
from crowdtide.sources import delimited
from crowdtide.workload import catalog
from crowdtide.workload import tables as w


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- sketches


def test_merged_sketches_are_those_of_all_users(spark, tmp_path):
    log = spark.range(40000).select((F.col("id") % 7).alias("day"), (F.col("id") % 3).alias("k"), (F.col("id") % 9000).cast("string").alias("user"))
    path = str(tmp_path / "days")
    sketches.user_sketches(log, ["day", "k"], "user").write.partitionBy("day").parquet(path)
    days = spark.read.parquet(path)
    merged = sketches.estimated_users(sketches.merged_sketches(days, ["k"]))
    at_once = sketches.estimated_users(sketches.user_sketches(log, ["k"], "user"))
    error = 3 * sketches.standard_error()
    exact = {r["k"]: r["uv"] for r in adhoc.distinct_users(log, ["k"], "user").collect()}
    for found in (merged, at_once):
        for r in found.collect():
            assert abs(r["uv"] - exact[r["k"]]) <= error * exact[r["k"]]
    # Days are the only thing read, and a sketch a key is what moves.
    plan = plan_of(sketches.merged_sketches(days, ["k"]))
    assert plan.count("FileScan") == 1 and "days" in plan and "partial_hll_union_agg" in plan
    # A day written again replaces itself; a week that has seen it twice is the same.
    twice = sketches.estimated_users(sketches.merged_sketches(days.union(days), ["k"]))
    assert rows(twice) == rows(merged)


def test_sketches_of_nobody_and_of_few(spark):
    log = spark.createDataFrame([("a", None), ("b", "x"), ("b", "x"), ("b", "y")], "k string, user string")
    found = {r["k"]: r["uv"] for r in sketches.estimated_users(sketches.user_sketches(log, ["k"], "user")).collect()}
    assert found == {"a": 0, "b": 2}
    none = sketches.user_sketches(log.where("false"), ["k"], "user")
    assert sketches.estimated_users(sketches.merged_sketches(none, ["k"])).collect() == []


# --- values that come as tables


@pytest.fixture
def facts(spark):
    return spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("a"), F.concat(F.lit("s"), F.col("id") % 4).alias("b"))


def values(spark, kind, *found):
    return spark.createDataFrame([(v,) for v in found], f"v {kind}")


@pytest.mark.parametrize("limit", [1 << 20, 0], ids=["broadcast", "salted"])
def test_allowed_only_is_a_filter_by_tables(spark, facts, limit):
    allowed = {"a": values(spark, "long", 7, 7, 3, None, 49), "b": values(spark, "string", "s1", "s2", "nobody")}
    got = adhoc.allowed_only(facts, allowed, spread_by="id", limit_bytes=limit, salts=4)
    assert got.columns == facts.columns
    assert rows(got) == rows(facts.where("a IN (7, 3, 49) AND b IN ('s1', 's2')"))
    plan = plan_of(got)
    assert (" IN (" not in plan and "INSET" not in plan) and ("Broadcast" in plan) == (limit > 0 or "BroadcastHashJoin" in plan)
    nobody = adhoc.allowed_only(facts, {"a": values(spark, "long", None)}, spread_by="id", limit_bytes=limit)
    assert nobody.collect() == [] and nobody.columns == facts.columns
    assert rows(adhoc.allowed_only(facts, {}, spread_by="id")) == rows(facts)


def test_a_hundred_thousand_values_stay_a_table(spark):
    lines = w.table(spark, SMALL, "lineitem")
    many = spark.range(100_000).select((F.col("id") * 3).alias("v"))
    got = adhoc.allowed_only(lines, {"l_orderkey": many}, spread_by="l_linenumber")
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(l_orderkey,0)" in plan and "LessThanOrEqual(l_orderkey,299997)" in plan
    assert len(plan) < 20_000 and " IN (" not in plan and "INSET" not in plan
    assert got.count() == lines.where("l_orderkey % 3 = 0 AND l_orderkey <= 299997").count()


# --- buckets


def test_bucketed_people_and_labels_join_without_an_exchange(spark, tmp_path):
    people, path = w.snapshot(spark, SMALL), str(tmp_path / "people")
    labels = w.labels(spark, SMALL)
    sinks.write_bucketed_snapshot(people, "people_b", path, 4)
    for n, (_, table) in enumerate(labels):
        sinks.write_bucketed_labels(table, f"labels_b{n}", str(tmp_path / f"labels{n}"), 4)
    kept = [(spec, spark.table(f"labels_b{n}")) for n, (spec, _) in enumerate(labels)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for own in (kept, kept[:1]):
            got = counts.label_counts(spark.table("people_b"), own, in_place=True)
            plan = plan_of(got)
            assert "Exchange" not in plan[plan.index("SortMergeJoin") :]
        assert rows(counts.label_counts(spark.table("people_b"), kept, in_place=True)) == rows(counts.label_counts(people, labels))
        # A time written again replaces itself, another is added; a session that only knows the path reads both.
        later = people.withColumn("stat_time", F.lit("20240116000000"))
        for again in (people.limit(10), later, later):
            sinks.write_bucketed_snapshot(again, "people_b", path, 4)
        seen = spark.table("people_b").groupBy("stat_time").count()
        assert rows(seen) == [("20240115120000", 10), ("20240116000000", people.count())]
        spark.sql("DROP TABLE people_b")
        opened = sinks.open_bucketed_snapshot(spark, "people_c", path, 4)
        assert rows(opened.groupBy("stat_time").count()) == [("20240115120000", 10), ("20240116000000", people.count())]
        plan = plan_of(counts.label_counts(opened, kept, in_place=True))
        assert "Exchange" not in plan[plan.index("SortMergeJoin") :]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in ("people_b", "people_c", "labels_b0", "labels_b1"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


# --- typed lines


def test_typed_lines_keep_what_does_not_fit(spark, tmp_path):
    lines = ["ann,17,f", "bob,x,m", "short,1", "long,1,f,more", '"a, b",3,m', '"a, b",y,m', ",,", "", "zoe,99999999999,f", 'q"uo,4,f']
    (tmp_path / "t.txt").write_text("\n".join(lines) + "\n")
    found = delimited.read_typed_lines(spark, str(tmp_path / "t.txt"), ["name_string", "age_int", "sex_string"])
    assert found.columns == ["name", "age", "sex", "line", "reject_reason"]
    assert plan_of(found).count("FileScan") == 1
    got = {r["line"] or r["name"]: r["reject_reason"] for r in found.collect()}
    assert got == {
        "ann": None, "bob,x,m": "bad_value", "short,1": "field_count", "long,1,f,more": "field_count", "a, b": None,
        '"a, b",y,m': "bad_value", None: None, "zoe,99999999999,f": "bad_value", 'q"uo': None,
    }
    assert found.where("reject_reason IS NULL").select("age").count() == 4
    (tmp_path / "empty.txt").write_text("")
    assert delimited.read_typed_lines(spark, str(tmp_path / "empty.txt"), ["a_int"]).collect() == []


# --- flows


def test_each_source_of_a_graph_is_read_once(spark, tmp_path, monkeypatch):
    flow = w.graph_flow(str(tmp_path))
    scans = []
    for node, found in zip(flow["source"], w.flow_sources(spark, SMALL), strict=True):
        found.write.csv(flows.file_path(node, w.AS_OF), sep=node["delimiter"])
    writer = type(spark.range(1).write)
    for name in ("csv", "parquet"):
        whole = getattr(writer, name)

        def counted(self, *args, _whole=whole, **more):
            files = self._df.inputFiles()
            scans.extend(n["id"] for n in flow["source"] if any(f"/{n['id']}_2024" in f for f in files))
            return _whole(self, *args, **more)

        monkeypatch.setattr(writer, name, counted)
    flows.run_flow(spark, flow, w.AS_OF)
    assert sorted(scans) == ["even", "nations", "odd"]


def test_a_flow_without_names_is_a_line(spark, tmp_path):
    flow = catalog.PEOPLE_FLOW | {side: [catalog.PEOPLE_FLOW[side][0] | {"filePath": str(tmp_path / side)}] for side in ("source", "sink")}
    spark.createDataFrame([("a", 9, "m"), ("b", 10, "f")], "name string, age int, sex string").write.csv(flows.file_path(flow["source"][0], w.AS_OF))
    flows.run_flow(spark, flow | {"channel": [{}, {"filter": "age >= 10"}, {"filter": "name <> 'x'"}]}, w.AS_OF)
    assert rows(spark.read.csv(flows.file_path(flow["sink"][0], w.AS_OF))) == [("b", "10")]


@pytest.mark.parametrize(
    "change, words",
    [
        ({"sink": []}, "needs a sink"),
        ({"channel": [{"id": "x"}]}, "several sources"),
        ({"channel": [{"id": "even", "inputs": ["even"]}]}, "two nodes"),
        ({"channel": [{"id": "x", "inputs": ["later"]}, {"id": "later", "inputs": ["x"]}]}, "not before it"),
    ],
)
def test_flows_that_cannot_run_are_errors(spark, change, words):
    with pytest.raises(ValueError, match=words):
        flows.run_flow(spark, w.graph_flow("/nowhere") | change, w.AS_OF)
