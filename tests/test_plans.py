"""The plans that the engine counts on at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from crowdtide.operators.movement import LAGS, movement_counts
from crowdtide.sinks import tables as sinks
from crowdtide.sources.tables import read_snapshot
from crowdtide.workload import catalog
from crowdtide.workload import tables as w

#: Queries over files that they write first, in a job or a stream, have their plans below.
WRITTEN = {n for n in catalog.QUERIES if n.endswith("_job")} | {
    "stream_latest", "stats_roundtrip", "rebuilt_area_profile", "movement_rerun", "history_gaps", "stored_rejects",
    "typed_people", "exported_bridge", "configured_labels", "compacted_latest", "late_signals", "batch_counts",
    "closed_windows", "expired_users", "recomputed_times", "vacuumed_profiles", "typed_outcomes", "uv_week_estimates",
    "bucketed_label_counts", "flow_files",
}
PLANNED = [name for name in catalog.QUERIES if name not in WRITTEN]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in plan


def test_scan_is_pruned_and_filtered(spark):
    df = entry.queries()["latest_location"](spark, SMALL)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThan(ts," in plan and "LessThanOrEqual(ts," in plan
    assert "value:double" not in plan


def test_hash_is_made_per_user_not_per_signal(spark):
    """No MD5 below the aggregate that keeps one row per user."""
    plan = _plan(entry.queries()["label_counts"](spark, SMALL))
    events = plan[: plan.index("FileScan parquet")]
    below = events[events.index("partial_max_by") :]
    assert "md5" not in below


def test_latest_and_counts_combine_before_the_shuffle(spark):
    assert "partial_max_by" in _plan(entry.queries()["latest_location"](spark, SMALL))
    plan = _plan(entry.queries()["cell_stats"](spark, SMALL))
    assert "partial_sum" in plan and "partial_count" in plan


def test_both_halves_of_cell_stats_share_one_shuffle_of_signals(spark):
    df = entry.queries()["cell_stats"](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in _plan(df)


def test_area_stats_is_one_chain(spark):
    """Cell counts are summed once for all four district branches."""
    plan = _plan(entry.queries()["area_stats"](spark, SMALL))
    assert plan.count("Generate posexplode") == 1
    assert plan.count("partial_count") == 1


def test_joins_without_broadcast_stay_whole(spark):
    """With broadcasting off every join shuffles, and the answer is the same."""
    names = ["area_stats", "movement_profile", "stayed_60m"]
    want = {n: sorted(map(tuple, entry.queries()[n](spark, SMALL).collect())) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for n in names:
            assert sorted(map(tuple, entry.queries()[n](spark, SMALL).collect())) == want[n]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_movement_over_stored_snapshots_moves_them_once(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    sinks.write_snapshot(w.snapshot(spark, SMALL), path)
    stored = read_snapshot(spark, path, [w.AS_OF])
    bridges = w.bridges(spark, SMALL)
    df = movement_counts(stored, LAGS, bridges.cell_district, w.prefix_region(spark, SMALL), w.labels(spark, SMALL))
    df.collect()
    plan = _plan(df)
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count("FileScan parquet [user_hash") == 1 and "ReusedExchange" in final


def test_outcomes_are_counted_in_one_pass(spark):
    plan = _plan(entry.queries()["signal_outcomes"](spark, SMALL))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
