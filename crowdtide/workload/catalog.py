"""Every registered query, by name. Each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdtide.functions import format_time, pseudonym
from crowdtide.operators import adhoc, counts, movement, rollup, sketches, timeline
from crowdtide.operators import profile as prof
from crowdtide.operators import signals as sig
from crowdtide.operators import snapshot as snap
from crowdtide.plans import jobs
from crowdtide.plans.flow import apply_flow, file_path, output_names, run_flow
from crowdtide.plans.lineage import scratch_folder as _shared
from crowdtide.sinks import tables as sinks
from crowdtide.sources import delimited
from crowdtide.sources import tables as stored
from crowdtide.sources.delimited import parse_stats
from crowdtide.sources.tables import read_latest_locations, time_text
from crowdtide.sources.location_log import read_commits, read_late_signals
from crowdtide.streaming.event_time import start_append_stream, window_counts
from crowdtide.streaming.locations import compact_log, file_lines, start_location_stream, utc_now, vacuum_log
from crowdtide.streaming.ttl_state import STATE_PROVIDER, expired_locations
from crowdtide.workload import tables as w

Query = Callable[[SparkSession, str], DataFrame]

STAT_COLUMNS = ("stat_time", "area_id", "label", "value", "cnt")
QUARTER = timedelta(minutes=15)
SIXTY = timedelta(minutes=60)
STREAM_FILES = 8
STATE_SETTING = "spark.sql.streaming.stateStore.providerClass"


def parse_signals(spark: SparkSession, d: str) -> DataFrame:
    return sig.parse_signals(w.signal_lines(spark, d))


def serialise_signals(spark: SparkSession, d: str) -> DataFrame:
    return sig.serialise_signals(sig.parse_signals(w.signal_lines(spark, d)))


def latest_location(spark: SparkSession, d: str) -> DataFrame:
    return sig.latest_locations(w.signals(spark, d), w.AS_OF, w.DAY)


def snapshot(spark: SparkSession, d: str) -> DataFrame:
    return w.snapshot(spark, d)


def salted_pseudonym(spark: SparkSession, d: str) -> DataFrame:
    users = w.table(spark, d, "customer")
    number = w.phone(F.col("c_custkey"))
    return users.select("c_custkey", pseudonym(number, "pepper").alias("salted"), pseudonym(number, "").alias("plain"))


def rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    return snap.rejected(snap.split_location_lines(w.location_lines(spark, d), keep=("event_id",)))


def accepted_rows(spark: SparkSession, d: str) -> DataFrame:
    return snap.accepted(snap.split_location_lines(w.location_lines(spark, d)))


def region_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts.region_counts(w.snapshot(spark, d), w.prefix_region(spark, d)).select(*STAT_COLUMNS)


def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts.label_counts(w.snapshot(spark, d), w.labels(spark, d)).select(*STAT_COLUMNS)


def label_values(spark: SparkSession, d: str) -> DataFrame:
    """How often each label value is given by the users of both label files."""
    return _value_counts(w.labels(spark, d))


def _value_counts(labels: jobs.Labels) -> DataFrame:
    users = labels[0][1].select("user_hash").unionByName(labels[1][1].select("user_hash")).distinct()
    return counts.labelled(users, labels, ()).groupBy("label", "value").agg(F.count(F.lit(1)).alias("cnt"))


def cell_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = counts.area_counts(w.snapshot(spark, d), w.prefix_region(spark, d), w.labels(spark, d))
    return stats.select(*STAT_COLUMNS)


def grid_stats(spark: SparkSession, d: str) -> DataFrame:
    return rollup.roll_up(cell_stats(spark, d), w.bridges(spark, d).cell_grid).select(*STAT_COLUMNS)


def district_stats(spark: SparkSession, d: str) -> DataFrame:
    return rollup.roll_up(grid_stats(spark, d), w.bridges(spark, d).grid_district).select(*STAT_COLUMNS)


def cell_district_stats(spark: SparkSession, d: str) -> DataFrame:
    return rollup.roll_up(cell_stats(spark, d), w.bridges(spark, d).cell_district).select(*STAT_COLUMNS)


def parent_district_stats(spark: SparkSession, d: str) -> DataFrame:
    bridge = w.bridges(spark, d).district_parent
    return rollup.roll_up(cell_district_stats(spark, d), bridge).select(*STAT_COLUMNS)


def city_total(spark: SparkSession, d: str) -> DataFrame:
    return rollup.city_total(district_stats(spark, d)).select(*STAT_COLUMNS)


def area_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = rollup.area_stats(cell_stats(spark, d), w.bridges(spark, d))
    return stats.select(*STAT_COLUMNS, "branch", "level")


def profile_json(spark: SparkSession, d: str) -> DataFrame:
    return prof.row_keys(prof.profiles(area_stats(spark, d))).select("row_key", "profile_json")


def current_profile_json(spark: SparkSession, d: str) -> DataFrame:
    stats = area_stats(spark, d).drop("stat_time")
    return prof.row_keys(prof.profiles(stats, by=()), timed=False).select("row_key", "profile_json")


def rebuilt_profile(spark: SparkSession, d: str) -> DataFrame:
    """Cell statistics as text, read back and made into profiles."""
    text = cell_stats(spark, d).select(F.concat_ws(",", "area_id", "label", "value", "cnt").alias("value"))
    return prof.profiles(parse_stats(text), by=())


def located(spark: SparkSession, d: str) -> DataFrame:
    return movement.locate(w.snapshot(spark, d), w.bridges(spark, d).cell_district)


def _people_every(spark: SparkSession, d: str, step: timedelta) -> DataFrame:
    """Snapshots of the last hour, ``step`` apart, from one pass over the signals."""
    latest = timeline.latest_over_range(w.signals(spark, d), w.AS_OF - SIXTY, w.AS_OF, step=step, ttl=w.DAY)
    return snap.build_snapshot(latest, F.col("snapshot_time"))


def _now_and_then(spark: SparkSession, d: str, lag: timedelta) -> tuple[DataFrame, DataFrame]:
    people = movement.locate(_people_every(spark, d, lag), w.bridges(spark, d).cell_district, by=("stat_time",))
    now, then = (
        people.where(F.col("stat_time") == time_text(moment)).drop("stat_time") for moment in (w.AS_OF, w.AS_OF - lag)
    )
    return now, then


def stayed_15m(spark: SparkSession, d: str) -> DataFrame:
    return movement.stayed(*_now_and_then(spark, d, QUARTER))


def stayed_60m(spark: SparkSession, d: str) -> DataFrame:
    return movement.stayed(*_now_and_then(spark, d, SIXTY))


def arrived(spark: SparkSession, d: str) -> DataFrame:
    return movement.moved(*_now_and_then(spark, d, SIXTY))


def departed(spark: SparkSession, d: str) -> DataFrame:
    now, then = _now_and_then(spark, d, SIXTY)
    return movement.moved(then, now)


def arrived_strict(spark: SparkSession, d: str) -> DataFrame:
    return movement.moved_strict(*_now_and_then(spark, d, SIXTY))


def _movement_counts(spark: SparkSession, d: str, people: DataFrame) -> DataFrame:
    return movement.movement_counts(
        people, movement.LAGS, w.bridges(spark, d).cell_district, w.prefix_region(spark, d), w.labels(spark, d)
    )


def movement_profile(spark: SparkSession, d: str) -> DataFrame:
    now = F.col("stat_time") == time_text(w.AS_OF)
    stats = _movement_counts(spark, d, _people_every(spark, d, QUARTER)).where(now)
    return prof.profiles(stats, by=("stat_time", "movement"))


def time_range(spark: SparkSession, d: str) -> DataFrame:
    return timeline.expand_ranges(w.time_ranges(spark, d), "span", keep=("user_id", "day"))


def _range_snapshots(spark: SparkSession, d: str, ttl: timedelta) -> DataFrame:
    latest = timeline.latest_over_range(w.signals(spark, d), *w.RANGE, ttl=ttl)
    return snap.build_snapshot(latest, F.col("snapshot_time"))


def backfill_uv(spark: SparkSession, d: str) -> DataFrame:
    """Times stay numbers until the counts are made; only those are written out as text."""
    latest = timeline.latest_over_range(w.signals(spark, d), *w.RANGE, ttl=w.DAY)
    stats = counts.head_counts(latest, by=("snapshot_time",))
    return stats.select(format_time(F.col("snapshot_time")).alias("stat_time"), "area_id", "cnt")


def backfill_stats(spark: SparkSession, d: str) -> DataFrame:
    people = _range_snapshots(spark, d, w.HOUR)
    stats = counts.area_counts(people, w.prefix_region(spark, d), w.labels(spark, d), gather=("stat_time", "cell_id"))
    return stats.select(*STAT_COLUMNS)


def movement_backfill(spark: SparkSession, d: str) -> DataFrame:
    people = _range_snapshots(spark, d, w.HOUR)
    return _movement_counts(spark, d, people).select(*STAT_COLUMNS, "movement")


def district_bridge(spark: SparkSession, d: str) -> DataFrame:
    return rollup.derive_district_bridge(*w.district_inputs(spark, d))


def multi_filter(spark: SparkSession, d: str) -> DataFrame:
    wanted = {"city": ["shanghai", "shenzhen"], "platform": ["ios"], "version": ["1.2", "2.0"]}
    return adhoc.multi_filter(w.search_log(spark, d), wanted)


def uv_per_day_key(spark: SparkSession, d: str) -> DataFrame:
    wanted = {"city": ["beijing", "shanghai"], "platform": [], "version": ["1.0", "1.5"]}
    return adhoc.distinct_users(adhoc.multi_filter(w.search_log(spark, d), wanted), ["date", "keyword"], "user")


# The keys of the flow format.
PEOPLE_FLOW = {
    "source": [
        {
            "delimiter": ",",
            "filePath": "people",
            "filePattern": "people_#flow.startDataTime#.txt",
            "inputGroups": [
                {
                    "columns": [
                        {"columnType": 0, "dataType": 0, "name": "name"},
                        {"columnType": 0, "dataType": 1, "name": "age"},
                        {"columnType": 0, "dataType": 0, "name": "sex"},
                    ]
                }
            ],
            "outputGroups": [{"columns": [{"name": "name"}, {"name": "age"}, {"name": "sex"}]}],
        }
    ],
    "channel": [{"filter": "age >= 10"}],
    "sink": [
        {
            "delimiter": ",",
            "filePath": "people_out",
            "filePattern": "people_#flow.startDataTime#.txt",
            "inputGroups": [{"columns": [{"name": "name"}, {"name": "age"}, {"name": "sex"}]}],
            "outputGroups": [{"columns": [{"name": "name"}, {"name": "age"}]}],
        }
    ],
}


def flow_filter(spark: SparkSession, d: str) -> DataFrame:
    return apply_flow(w.people(spark, d), PEOPLE_FLOW)


def sql_filter(spark: SparkSession, d: str) -> DataFrame:
    return adhoc.select_where(w.people(spark, d), "age BETWEEN 30 AND 44 AND sex = '1'")


def text_length(spark: SparkSession, d: str) -> DataFrame:
    return adhoc.text_length(w.table(spark, d, "documents"), "text")


def row_count(spark: SparkSession, d: str) -> DataFrame:
    return adhoc.row_count(w.signal_lines(spark, d))


def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    """Signal text as a file stream in several micro-batches into the log, compacted and read back."""
    root = _shared(spark, "stream")
    w.signal_lines(spark, d).repartition(STREAM_FILES).write.text(posixpath.join(root, "lines"))
    lines = file_lines(spark, posixpath.join(root, "lines"), max_files=STREAM_FILES // 4)
    log = posixpath.join(root, "locations")
    start_location_stream(lines, log, posixpath.join(root, "progress"), files=2).awaitTermination()
    now = utc_now() + timedelta(minutes=1)
    compact_log(spark, log, now, w.DAY, buckets=STREAM_FILES)
    return read_latest_locations(spark, log, w.RANGE[1], w.DAY, by="event_time")


def _in_lots(spark: SparkSession, d: str, root: str, run: Callable[[DataFrame], StreamingQuery]) -> Iterator[int]:
    """Signals arrive lot by lot in a folder; after each, the stream goes on from its checkpoint until all is read."""
    folder = posixpath.join(root, "lines")
    arrivals = w.arrivals(spark, d)
    for lot in range(w.LOTS):
        arrivals.where(F.col("lot") == lot).select("value").write.mode("append").text(folder)
        run(file_lines(spark, folder)).awaitTermination()
        yield lot


def _log_in_lots(spark: SparkSession, d: str, delay: timedelta | None) -> Iterator[tuple[str, int]]:
    root = _shared(spark, "stream")
    log, progress = posixpath.join(root, "locations"), posixpath.join(root, "progress")
    for lot in _in_lots(spark, d, root, lambda lines: start_location_stream(lines, log, progress, files=2, delay=delay)):
        yield log, lot


def late_signals(spark: SparkSession, d: str) -> DataFrame:
    """Signals that came after the watermark of their batch had passed them, and by how much."""
    for log, _ in _log_in_lots(spark, d, w.DELAY):
        pass
    found = read_late_signals(spark, log).withColumn("event_time", format_time(F.col("event_time")))
    return found.select("batch_id", "msisdn", "cell_id", "event_time", "lag_seconds", "signals")


def batch_counts(spark: SparkSession, d: str) -> DataFrame:
    """What became of the signals of each batch, as counted while the batch was written."""
    for log, _ in _log_in_lots(spark, d, w.DELAY):
        pass
    marked = read_commits(spark, log).withColumn("watermark", format_time(F.col("watermark")))
    return marked.select("batch_id", "watermark", "signals", "located", "kept", "late", "rejected")


def compacted_latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest locations after two compactions, the second of changed buckets, and what they replaced is gone."""
    for log, lot in _log_in_lots(spark, d, None):
        if lot % 2:
            compact_log(spark, log, utc_now() + timedelta(minutes=1), w.DAY, buckets=STREAM_FILES)
            vacuum_log(spark, log, timedelta(0))
    return read_latest_locations(spark, log, w.RANGE[1], w.DAY, by="event_time")


def _appended_in_lots(spark: SparkSession, d: str, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    root = _shared(spark, "stream")
    out, progress = posixpath.join(root, "out"), posixpath.join(root, "progress")
    for _ in _in_lots(spark, d, root, lambda lines: start_append_stream(rows(lines), out, progress)):
        pass
    return spark.read.parquet(out)


def closed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Signals per cell and quarter of an hour, of the quarters that the watermark has passed."""
    found = _appended_in_lots(spark, d, lambda lines: window_counts(lines, QUARTER, w.DELAY))
    return found.select(format_time(F.col("window_start")).alias("window_start"), "cell_id", "signals")


def expired_users(spark: SparkSession, d: str) -> DataFrame:
    """The last cell of users who were not heard of for an hour, and when that was over."""
    before = spark.conf.get(STATE_SETTING, None)
    spark.conf.set(STATE_SETTING, STATE_PROVIDER)
    try:
        found = _appended_in_lots(spark, d, lambda lines: expired_locations(lines, w.HOUR, w.DELAY))
    finally:
        spark.conf.set(STATE_SETTING, before) if before else spark.conf.unset(STATE_SETTING)
    return found.select("msisdn", "cell_id", format_time(F.col("expires")).alias("expires"))


def _paths(spark: SparkSession) -> jobs.Paths:
    root = _shared(spark, "jobs")
    return jobs.Paths(*[posixpath.join(root, n) for n in ("snapshots", "backups", "stats", "profiles", "current", "marks", "rejected")])


def _inputs(spark: SparkSession, d: str) -> jobs.Inputs:
    return jobs.Inputs(w.bridges(spark, d), w.prefix_region(spark, d), w.labels(spark, d))


def _now(spark: SparkSession, d: str) -> DataFrame:
    return sig.latest_locations(w.signals(spark, d), w.AS_OF, w.DAY)


def _hard_stats(spark: SparkSession, d: str) -> DataFrame:
    """Area statistics with values that text has to quote: separators, quotes, blanks at the ends, nothing."""
    label = F.col("label")
    value = F.when(label == "arpu", F.concat(F.lit(" "), "value", F.lit(', "or" so '))).when(label == "gender", "").otherwise(F.col("value"))
    return area_stats(spark, d).withColumn("value", value).groupBy("stat_time", "area_id", "label", "value", "branch", "level").agg(F.sum("cnt").alias("cnt"))


def stats_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = posixpath.join(_shared(spark, "stats"), "text")
    sinks.write_stats(_hard_stats(spark, d), path, sinks.new_run(), fmt="csv")
    return parse_stats(delimited.read_stats_lines(spark, path), keep=("stat_time", "level"))


def rebuilt_area_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of districts that two branches reach, rebuilt from saved text."""
    path, run = posixpath.join(_shared(spark, "stats"), "text"), sinks.new_run()
    sinks.write_stats(_hard_stats(spark, d), path, run, fmt="csv")
    folder = posixpath.join(path, f"stat_time={time_text(w.AS_OF)}", "level=sub", f"run={run}")
    return sinks.rebuild_profiles(spark, folder, w.AS_OF).select("area_id", "label", "profile_json")


def movement_rerun(spark: SparkSession, d: str) -> DataFrame:
    """A movement job run again after the earlier snapshots are gone: nothing of its first result stays."""
    first, inputs = _paths(spark), _inputs(spark, d)
    sinks.write_snapshot(_people_every(spark, d, QUARTER), first.snapshots, many_times=True)
    jobs.run_movement(spark, inputs, first, w.AS_OF)
    again = replace(first, snapshots=posixpath.join(_shared(spark, "jobs"), "snapshots"))
    sinks.write_snapshot(w.snapshot(spark, d), again.snapshots)
    jobs.run_movement(spark, inputs, again, w.AS_OF)
    return stored.read_profiles(spark, first.profiles, first.marks)


def movement_job(spark: SparkSession, d: str) -> DataFrame:
    paths = _paths(spark)
    sinks.write_snapshot(_people_every(spark, d, QUARTER), paths.snapshots, many_times=True)
    jobs.run_movement(spark, _inputs(spark, d), paths, w.AS_OF)
    return stored.read_profiles(spark, paths.profiles, paths.marks).select("stat_time", "movement", "area_id", "label", "profile_json")


def snapshot_job(spark: SparkSession, d: str) -> DataFrame:
    paths = _paths(spark)
    jobs.run_snapshot(spark, _now(spark, d), _inputs(spark, d), paths, w.AS_OF)
    return prof.row_keys(stored.read_profiles(spark, paths.profiles, paths.marks)).select("row_key", "profile_json")


def history_job(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of stored snapshots; the job is told of times between them that have none."""
    paths = _paths(spark)
    sinks.write_snapshot(_people_every(spark, d, SIXTY), paths.snapshots, many_times=True)
    jobs.run_history(spark, _inputs(spark, d), paths, w.AS_OF - SIXTY, w.AS_OF)
    return stored.read_stats(spark, paths.stats, paths.marks, w.AS_OF).select(*STAT_COLUMNS, "branch", "level")


def history_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The times of the schedule for which no snapshot is stored, and those for which one is."""
    paths = _paths(spark)
    sinks.write_snapshot(_people_every(spark, d, SIXTY), paths.snapshots, many_times=True)
    absent = jobs.run_history(spark, _inputs(spark, d), paths, w.AS_OF - SIXTY, w.AS_OF, jobs.OUTPUTS["hdfs"])
    there = stored.read_stats(spark, paths.stats, paths.marks).select("stat_time").distinct().withColumn("absent", F.lit(False))
    return there.union(spark.createDataFrame([(t, True) for t in absent], "stat_time string, absent boolean"))


def realtime_job(spark: SparkSession, d: str) -> DataFrame:
    """Run twice: the second table takes the place of the first."""
    paths, inputs = _paths(spark), _inputs(spark, d)
    earlier = sig.latest_locations(w.signals(spark, d), w.AS_OF - w.DAY, w.DAY)
    jobs.run_realtime(spark, earlier, inputs, paths, w.AS_OF - w.DAY)
    jobs.run_realtime(spark, _now(spark, d), inputs, paths, w.AS_OF)
    found = stored.read_current_profiles(spark, paths.current_profiles, paths.marks)
    return prof.row_keys(found, timed=False).select("row_key", "profile_json")


REPAIRED = (w.AS_OF - SIXTY, w.AS_OF + 3 * SIXTY)


def recomputed_times(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of some hours are made again once late signals are there: which movement profiles are computed anew?"""
    paths, inputs, signals = _paths(spark), _inputs(spark, d), w.signals(spark, d)
    for number, known in enumerate((signals.where(F.col("seq") % 10 != 0), signals)):
        latest = timeline.latest_over_range(known, *REPAIRED, ttl=w.HOUR)
        sinks.write_snapshot(snap.build_snapshot(latest, F.col("snapshot_time")), paths.snapshots, many_times=True)
        began = sinks.new_run()
        jobs.run_movement(spark, inputs, paths, *REPAIRED, changed_only=number > 0)
    return stored.finished(spark, paths.marks, stored.PROFILES).where(F.col("run") > began).select("stat_time", "movement")


def vacuumed_profiles(spark: SparkSession, d: str) -> DataFrame:
    """A movement job three times over, then everything that no longer counts is removed."""
    paths, inputs = _paths(spark), _inputs(spark, d)
    sinks.write_snapshot(_people_every(spark, d, QUARTER), paths.snapshots, many_times=True)
    for _ in range(3):
        jobs.run_movement(spark, inputs, paths, w.AS_OF)
        sinks.vacuum(spark, paths, timedelta(0))
    return stored.read_profiles(spark, paths.profiles, paths.marks).select("stat_time", "movement", "area_id", "label", "profile_json")


def backup_job(spark: SparkSession, d: str) -> DataFrame:
    paths = _paths(spark)
    jobs.run_backup(_now(spark, d), paths, w.AS_OF)
    return stored.read_snapshot(spark, paths.backups, [w.AS_OF])


def stored_rejects(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot job over text, and the lines it could not use."""
    paths = _paths(spark)
    lines = w.location_lines(spark, d)
    jobs.run_snapshot_lines(spark, lines, _inputs(spark, d), paths, w.AS_OF, jobs.OUTPUTS["hdfs"])
    return stored.read_rejected(spark, paths.rejected, paths.marks)


def signal_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Every signal is either located or rejected for a reason."""
    return sig.outcome_counts(sig.parse_signals(w.signal_lines(spark, d)))


def typed_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Lines read by a run-time schema: the rows they give, and those that do not fit it with the reason."""
    path = posixpath.join(_shared(spark, "people"), "text")
    w.people_lines(spark, d).write.text(path)
    return delimited.read_typed_lines(spark, path, ["name_string", "age_int", "sex_string"])


def uv_week_estimates(spark: SparkSession, d: str) -> DataFrame:
    """Distinct users per week and keyword from stored daily sketches, beside the exact number."""
    log, week = w.search_log(spark, d), F.date_trunc("week", F.col("date").cast("date")).cast("date").cast("string").alias("week")
    path = posixpath.join(_shared(spark, "sketches"), "days")
    sketches.user_sketches(log, ["date", "keyword"], "user").write.partitionBy("date").parquet(path)
    days = spark.read.schema("keyword string, sketch binary, date string").parquet(path)
    estimates = sketches.estimated_users(sketches.merged_sketches(days, [week, "keyword"]))
    exact = adhoc.distinct_users(log.withColumn("week", week), ["week", "keyword"], "user")
    near = F.abs(F.col("estimate") - F.col("uv")) <= 3 * sketches.standard_error() * F.col("uv")
    return exact.join(estimates.withColumnRenamed("uv", "estimate"), ["week", "keyword"]).select("week", "keyword", "uv", near.alias("near"))


def bucketed_label_counts(spark: SparkSession, d: str) -> DataFrame:
    """Label counts of two stored snapshots, with snapshots and labels in the same buckets by user."""
    root, name = _shared(spark, "buckets"), f"crowdtide_{uuid.uuid4().hex}"
    people = _people_every(spark, d, SIXTY)
    sinks.write_bucketed_snapshot(people, f"{name}_people", posixpath.join(root, "people"), STREAM_FILES)
    labels = []
    for number, (spec, rows) in enumerate(w.labels(spark, d)):
        sinks.write_bucketed_labels(rows, f"{name}_labels_{number}", posixpath.join(root, f"labels-{number}"), STREAM_FILES)
        labels.append((spec, spark.table(f"{name}_labels_{number}")))
    return counts.label_counts(spark.table(f"{name}_people"), labels, in_place=True).select(*STAT_COLUMNS)


def allowed_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose number is among those of all large line items, and whose customer is among those in debt."""
    lines, customers = w.table(spark, d, "lineitem"), w.table(spark, d, "customer")
    allowed = {
        "o_orderkey": lines.where("l_quantity > 25").select("l_orderkey"),
        "o_custkey": customers.where("c_acctbal < 5000").select("c_custkey"),
    }
    orders = w.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return adhoc.allowed_only(orders, allowed, spread_by="o_orderkey")


def flow_files(spark: SparkSession, d: str) -> DataFrame:
    """A flow over files: two sources united and filtered, joined with a third, to two sinks."""
    root = _shared(spark, "flow")
    flow = w.graph_flow(root)
    for node, rows in zip(flow["source"], w.flow_sources(spark, d), strict=True):
        rows.write.csv(file_path(node, w.AS_OF), sep=node["delimiter"])
    run_flow(spark, flow, w.AS_OF)
    found = []
    for node in flow["sink"]:
        names = output_names(node)
        rows = spark.read.schema(", ".join(f"{n} string" for n in names)).csv(file_path(node, w.AS_OF), sep=node["delimiter"])
        found.append(rows.select(F.lit(node["id"]).alias("sink"), "name", F.concat_ws("/", *names[1:]).alias("rest")))
    return found[0].union(found[1])


def typed_people(spark: SparkSession, d: str) -> DataFrame:
    path = posixpath.join(_shared(spark, "people"), "text")
    w.people(spark, d).write.csv(path)
    return delimited.read_typed(spark, path, ["name_string", "age_int", "sex_string"])


def exported_bridge(spark: SparkSession, d: str) -> DataFrame:
    path = posixpath.join(_shared(spark, "bridge"), "text")
    sinks.export_dimension(w.bridges(spark, d).cell_grid, path)
    return delimited.parse_bridge(delimited.read_lines(spark, path))


def configured_labels(spark: SparkSession, d: str) -> DataFrame:
    """Label files found by text settings, counted as ``label_values`` does."""
    root, settings = _shared(spark, "labels"), {"labels": "2"}
    for number, (spec, text) in enumerate(zip(counts.STANDARD_LABELS, w.label_lines(spark, d), strict=True), start=1):
        path = posixpath.join(root, str(number))
        text.write.text(path)
        own = {"path": path, "names": ",".join(spec.names), "positions": ",".join(map(str, spec.positions)), "width": str(spec.width), "sep_index": "0"}
        settings |= {f"label.{number}.{k}": v for k, v in own.items()}
    return _value_counts(delimited.load_labels(spark, settings))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        parse_signals,
        serialise_signals,
        latest_location,
        snapshot,
        salted_pseudonym,
        accepted_rows,
        rejected_rows,
        region_counts,
        label_values,
        label_counts,
        cell_stats,
        grid_stats,
        district_stats,
        cell_district_stats,
        parent_district_stats,
        city_total,
        area_stats,
        profile_json,
        current_profile_json,
        rebuilt_profile,
        located,
        stayed_15m,
        stayed_60m,
        arrived,
        departed,
        arrived_strict,
        movement_profile,
        time_range,
        backfill_uv,
        backfill_stats,
        movement_backfill,
        district_bridge,
        multi_filter,
        uv_per_day_key,
        flow_filter,
        sql_filter,
        text_length,
        row_count,
        stream_latest,
        compacted_latest,
        late_signals,
        batch_counts,
        closed_windows,
        expired_users,
        stats_roundtrip,
        rebuilt_area_profile,
        movement_rerun,
        movement_job,
        snapshot_job,
        history_job,
        history_gaps,
        realtime_job,
        backup_job,
        recomputed_times,
        vacuumed_profiles,
        stored_rejects,
        signal_outcomes,
        typed_people,
        typed_outcomes,
        uv_week_estimates,
        bucketed_label_counts,
        allowed_orders,
        flow_files,
        exported_bridge,
        configured_labels,
    )
}
