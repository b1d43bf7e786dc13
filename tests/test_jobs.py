from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from crowdtide import schemas as S
from crowdtide.operators import counts, profile, rollup
from crowdtide.operators.signals import latest_locations
from crowdtide.operators.snapshot import build_snapshot
from crowdtide.operators.timeline import latest_over_range
from crowdtide.plans import jobs
from crowdtide.plans.flow import apply_flow, file_path, input_schema, run_flow
from crowdtide.plans.lineage import cut_lineage, shared_folder
from crowdtide.sinks import tables as sinks
from crowdtide.sources import delimited, dimensions
from crowdtide.sources import tables as sources
from crowdtide.workload import catalog
from crowdtide.workload import tables as w


@pytest.fixture
def paths(tmp_path):
    return jobs.Paths(*[str(tmp_path / n) for n in ("snapshots", "backups", "stats", "profiles", "current", "marks", "rejected")])


@pytest.fixture
def inputs(spark):
    return jobs.Inputs(w.bridges(spark, SMALL), w.prefix_region(spark, SMALL), w.labels(spark, SMALL))


def _locations(spark, at=w.AS_OF):
    return latest_locations(w.signals(spark, SMALL), at, w.DAY)


def test_snapshot_job(spark, inputs, paths):
    for _ in range(2):  # a repeated run changes nothing
        jobs.run_snapshot(spark, _locations(spark), inputs, paths, w.AS_OF)
    kept = sources.read_snapshot(spark, paths.snapshots, [w.AS_OF])
    assert rows(kept) == rows(w.snapshot(spark, SMALL))
    want = catalog.area_stats(spark, SMALL)
    columns = ["area_id", "label", "value", "cnt", "level"]
    assert rows(sources.read_stats(spark, paths.stats, paths.marks, w.AS_OF).select(columns)) == rows(want.select(columns))
    published = sources.read_profiles(spark, paths.profiles, paths.marks)
    assert rows(published.select("area_id", "label", "profile_json")) == rows(
        profile.profiles(want).select("area_id", "label", "profile_json")
    )
    marks = spark.read.schema(S.MARKS).parquet(paths.marks).collect()
    assert {m["complete"] for m in marks} == {"DATA_FLAG-20240115120000"} and len({m["run"] for m in marks}) == 2


def test_output_choice(spark, inputs, paths):
    jobs.run_snapshot(spark, _locations(spark), inputs, paths, w.AS_OF, jobs.OUTPUTS["hdfs"])
    assert os.path.exists(paths.stats) and not os.path.exists(paths.profiles)
    assert jobs.OUTPUTS["both"] == jobs.OUTPUTS["hdfs"] | jobs.OUTPUTS["hbase"]


def test_history_job_equals_single_jobs(spark, inputs, paths, tmp_path):
    begin, end = w.AS_OF - timedelta(minutes=15), w.AS_OF
    single = jobs.Paths(*[str(tmp_path / "single" / n) for n in ("s", "b", "st", "p", "c", "f", "r")])
    for moment in (begin, end):
        jobs.run_snapshot(spark, _locations(spark, moment), inputs, single, moment)
    jobs.run_history(spark, inputs, jobs.Paths(single.snapshots, *[getattr(paths, n) for n in
                     ("backups", "stats", "profiles", "current_profiles", "marks", "rejected")]), begin, end)
    assert rows(sources.read_stats(spark, paths.stats, paths.marks)) == rows(sources.read_stats(spark, single.stats, single.marks))
    assert rows(sources.read_profiles(spark, paths.profiles, paths.marks)) == rows(
        sources.read_profiles(spark, single.profiles, single.marks)
    )


def test_only_the_run_marked_last_is_read(spark, paths):
    def put(run, *values):
        rows_ = [(v, "uv", '{"uv":1}', "20240101000000", m, "") for v, m in values]
        sinks.write_profiles(spark.createDataFrame(rows_, S.PROFILE), paths.profiles, run)

    def seen():
        return rows(sources.read_profiles(spark, paths.profiles, paths.marks).select("area_id", "movement"))

    keys = [("20240101000000", "current"), ("20240101000000", "stayed_15m")]
    put("one", ("a", "current"), ("b", "current"), ("a", "stayed_15m"))
    sinks.mark_complete(spark, paths.marks, sources.PROFILES, "none", keys)
    assert seen() == []
    sinks.mark_complete(spark, paths.marks, sources.PROFILES, "one", keys)
    assert seen() == [("a", "current"), ("a", "stayed_15m"), ("b", "current")]
    put("two", ("c", "current"))
    assert len(seen()) == 3  # written, but not marked
    sinks.mark_complete(spark, paths.marks, sources.PROFILES, "two", keys)
    assert seen() == [("c", "current")]


def test_realtime_job_replaces_the_current_table(spark, inputs, paths):
    early = w.AS_OF - timedelta(days=3)
    for moment in (early, w.AS_OF):
        jobs.run_realtime(spark, _locations(spark, moment), inputs, paths, moment)
    assert not os.path.exists(paths.snapshots)
    got = sources.read_current_profiles(spark, paths.current_profiles, paths.marks)
    assert rows(got) == rows(profile.profiles(catalog.area_stats(spark, SMALL)).select(got.columns))


def test_backup_job_keeps_only_the_snapshot(spark, paths):
    jobs.run_backup(_locations(spark), paths, w.AS_OF)
    assert sources.read_snapshot(spark, paths.backups, [w.AS_OF]).count() == w.snapshot(spark, SMALL).count()
    assert not os.path.exists(paths.stats)


def test_movement_job(spark, inputs, paths):
    times = [w.AS_OF - timedelta(minutes=m) for m in (60, 45, 30, 15, 0)]
    latest = latest_over_range(w.signals(spark, SMALL), times[0], times[-1], ttl=w.DAY)
    sinks.write_snapshot(build_snapshot(latest, F.col("snapshot_time")), paths.snapshots, many_times=True)
    assert rows(sources.read_snapshot(spark, paths.snapshots, [w.AS_OF])) == rows(w.snapshot(spark, SMALL))
    jobs.run_movement(spark, inputs, paths, w.AS_OF)
    columns = ["stat_time", "movement", "area_id", "label", "profile_json"]
    once = rows(sources.read_profiles(spark, paths.profiles, paths.marks).select(columns))
    assert once == rows(catalog.movement_profile(spark, SMALL).select(columns))
    jobs.run_movement(spark, inputs, paths, times[2], w.AS_OF)
    ranged = sources.read_profiles(spark, paths.profiles, paths.marks)
    assert rows(ranged.where("stat_time = '20240115120000'").select(columns)) == once
    assert {(r[0], r[1]) for r in ranged.select("stat_time", "movement").distinct().collect()} == {
        ("20240115113000", "current"),
        ("20240115113000", "stayed_15m"),
        ("20240115114500", "current"),
        ("20240115114500", "stayed_15m"),
        ("20240115120000", "current"),
        ("20240115120000", "stayed_15m"),
        ("20240115120000", "stayed_60m"),
    }


def test_snapshot_read_prunes_partitions(spark, paths):
    both = w.snapshot(spark, SMALL).unionByName(w.snapshot(spark, SMALL, w.AS_OF - timedelta(hours=1)))
    sinks.write_snapshot(both, paths.snapshots)
    plan = sources.read_snapshot(spark, paths.snapshots, [w.AS_OF])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stat_time" in plan
    ranged = sources.read_snapshot_range(spark, paths.snapshots, w.AS_OF - timedelta(minutes=15), w.AS_OF)
    assert {r["stat_time"] for r in ranged.collect()} == {"20240115120000"}


def test_stats_as_text_and_rebuilt_profiles(spark, paths, tmp_path):
    stats = catalog.cell_stats(spark, SMALL).withColumn("level", F.lit("cell"))
    sinks.write_stats(stats, paths.stats, "r", fmt="csv")
    folder = os.path.join(paths.stats, "stat_time=20240115120000", "level=cell", "run=r")
    line = sorted(delimited.read_lines(spark, folder).collect())[0]["value"]
    assert len(line.split(",")) == 5
    got = sinks.rebuild_profiles(spark, folder, w.AS_OF)
    assert rows(got.select("area_id", "label", "profile_json")) == rows(
        profile.profiles(stats.drop("level"), by=()).select("area_id", "label", "profile_json")
    )
    assert got.columns[-3:] == ["stat_time", "movement", "run"]


def test_rebuilt_profiles_store_the_lines_they_cannot_use(spark, tmp_path):
    folder = tmp_path / "stats"
    folder.mkdir()
    (folder / "part.txt").write_text("a,age,x,many\na,age\na,age,x,1\n")
    for _ in range(2):
        got = sinks.rebuild_profiles(spark, str(folder), w.AS_OF, run="r")
        assert rows(got.select("area_id", "label", "profile_json")) == [("a", "age", '{"x":1}')]
    stored = spark.read.parquet(str(folder / "_rejected"))
    assert rows(stored.select("line", "reject_reason", "run")) == [("a,age", "no_count", "r"), ("a,age,x,many", "no_count", "r")]
    sinks.rebuild_profiles(spark, str(folder), w.AS_OF, run="r", rejected_path=str(tmp_path / "elsewhere"))
    assert spark.read.parquet(str(tmp_path / "elsewhere")).count() == 2


def test_statistics_sample_to_profiles(lines):
    text = lines("3181$19645,ufrom,520000,1", "$4173711,uv,uv,77", "43044$11182,gender,男,10",
                 "43044$11182,gender,女,5", "bad,age,x,many", "short,age")
    got = {(r["area_id"], r["label"]): json.loads(r["profile_json"])
           for r in profile.profiles(delimited.parse_stats(text), by=()).collect()}
    assert got == {
        ("3181$19645", "ufrom"): {"520000": 1},
        ("$4173711", "uv"): {"uv": 77},
        ("43044$11182", "gender"): {"女": 5, "男": 10},
    }


def test_statistics_text_keeps_every_value(spark, lines, paths):
    values = ["30, or so", 'say "x"', "", " blank ends ", "back\\slash", "x\\", None, "plain"]
    data = [("a", "age", v, i, None if i % 2 else "cell", "20240101000000", "sub", "") for i, v in enumerate(values)]
    sinks.write_stats(spark.createDataFrame(data, S.AREA_STATS), paths.stats, "r", fmt="csv")
    text = delimited.read_stats_lines(spark, paths.stats)
    got = {r["cnt"]: (r["value"], r["branch"]) for r in delimited.parse_stats(text, keep=("stat_time",)).collect()}
    assert got == {i: (v, None if i % 2 else "cell") for i, v in enumerate(values)}
    bad = lines("a,age,x,many", "a,age", "a,age,x,1")
    assert rows(delimited.rejected_stats(bad)) == [("a,age", "no_count"), ("a,age,x,many", "no_count")]


def test_text_dimensions(lines):
    bridge = delimited.parse_bridge(lines("c,g,0.5", "c,g", "c,,0.5", "c,g,0.5,x", "c,g,half", "c", "", "c,"))
    assert rows(bridge) == sorted(
        [("c", "g", 0.5), ("c", "g", None), ("c", "", 0.5), ("c", "g", None), ("c", "g", None)], key=repr
    )
    regions = delimited.parse_prefix_regions(lines("1860172,310000", "1860173,", "1860174,1,2", "1860175", ",310000"))
    assert rows(regions) == [("1860172", "310000"), ("1860173", ""), ("1860174", "1,2"), ("1860175", None)]
    snap = delimited.parse_snapshot(lines("H,1$2,186,20170101120000", "H,1$2,186", "", "H,1$2"))
    assert rows(snap) == [("H", "1$2", "186", "20170101120000"), ("H", "1$2", "186", None)]


def test_dimension_export(spark, tmp_path):
    bridge = spark.createDataFrame([("c", "g", 0.5), ("d", "h", None)], S.BRIDGE)
    sinks.export_dimension(bridge, str(tmp_path / "out"))
    assert rows(delimited.read_lines(spark, str(tmp_path / "out"))) == [("c,g,0.5",), ("d,h,0.0",)]


def test_jdbc_settings(spark):
    grids = dimensions.Relation("t", "cell", "grid", "share", split_by="n", lower=1, upper=9, parts=4)
    options = dimensions.jdbc_options(grids, "jdbc:x", user="u")
    assert options["url"] == "jdbc:x" and options["user"] == "u" and options["numPartitions"] == "4"
    assert options["dbtable"] == "(SELECT cell AS from_id, grid AS to_id, share AS ratio, n AS split_by FROM t) bridge"
    assert "partitionColumn" not in dimensions.jdbc_options(dimensions.Relation("t", "a", "b"), "jdbc:x")
    upper = spark.createDataFrame([("c", "d")], "FROM_ID string, TO_ID string")
    assert rows(dimensions.as_bridge(upper)) == [("c", "d", None)]
    weighted = spark.createDataFrame([("c", "d", 0.5)], "FROM_ID string, TO_ID string, RATIO float")
    assert rows(dimensions.as_bridge(weighted)) == [("c", "d", 0.5)]


def test_bucketed_labels_join_without_moving(spark, tmp_path):
    rows_ = w.labels(spark, SMALL)[0][1]
    sinks.write_bucketed_labels(rows_, "labels_by_user", str(tmp_path / "labels"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        spec = w.labels(spark, SMALL)[0][0]
        kept = spark.table("labels_by_user")
        got = counts.label_counts(w.snapshot(spark, SMALL), [(spec, kept)])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 4 out of 4" in plan
        assert rows(got) == rows(counts.label_counts(w.snapshot(spark, SMALL), [(spec, rows_)]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE labels_by_user")


def test_typed_reader_and_search_log(spark, tmp_path):
    (tmp_path / "students.txt").write_text("ann,17,f\nbob,x,m\n")
    students = delimited.read_typed(spark, str(tmp_path / "students.txt"), ["name_string", "age_int", "sex_string"])
    assert [tuple(r) for r in students.collect()] == [("ann", 17, "f"), ("bob", None, "m")]
    (tmp_path / "log.txt").write_text('2024-01-01\tu1\tsay "hi\tbeijing\tandroid\t1.0\n')
    log = delimited.read_search_log(spark, str(tmp_path / "log.txt")).first()
    assert tuple(log) == ("2024-01-01", "u1", 'say "hi', "beijing", "android", "1.0")


def test_flow_files(spark, tmp_path):
    start = datetime(2024, 1, 2, 3, 4, 5)
    flow = json.loads(json.dumps(catalog.PEOPLE_FLOW))
    flow["source"][0]["filePath"] = flow["sink"][0]["filePath"] = str(tmp_path)
    flow["sink"][0]["filePattern"] = "out_#flow.startDataTime#"
    flow["sink"][0]["delimiter"] = "|"
    (tmp_path / "people_20240102030405.txt").write_text("ann,9,f\nbob,10,m\ncat,x,f\n")
    run_flow(spark, flow, start)
    assert rows(delimited.read_lines(spark, str(tmp_path / "out_20240102030405"))) == [("bob|10",)]


def test_flow_without_filter_reorders(spark):
    node = {"outputGroups": [{"columns": [{"name": "b"}]}, {"columns": [{"name": "a"}]}]}
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert apply_flow(df, {"source": [node], "channel": [{}], "sink": [node]}).columns == ["b", "a"]
    with pytest.raises(ValueError):
        input_schema({"inputGroups": [{"columns": [{"name": "a", "dataType": 9}]}]})
    assert file_path({"filePath": "/x/", "filePattern": "f"}, datetime(2024, 1, 1)) == "/x/f"


def test_lineage_needs_a_shared_folder(spark):
    assert cut_lineage(spark.range(3)).count() == 3
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_rollup_ranks_cover_all_branches(spark):
    branches = {r["branch"] for r in catalog.area_stats(spark, SMALL).select("branch").distinct().collect()}
    assert branches == set(rollup.BRANCH_RANK)
