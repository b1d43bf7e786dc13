"""The signal stream: lines in, a log of latest locations out.

Each micro-batch keeps the newest signal per user and adds those rows to a log, under its number and attempt.
The same pass sorts out signals that cannot be located, and those that a watermark has passed: they are kept
with the reason or with how late they were. What became of a batch is counted while it is written, and a
commit made of these counts, written last, makes its rows count. So a batch that fails leaves nothing behind
that is read, one that is run again replaces itself, and readers see whole batches only. Between batches
nothing is held but the commits. ``compact_log`` takes batches into the base of the log.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdtide import schemas as S
from crowdtide.functions import is_blank, micros_between, ntz, parse_time
from crowdtide.operators.signals import LOG_ORDER, latest_per_user, locate_signals, parse_signals
from crowdtide.sinks import ledger
from crowdtide.sinks import location_log as sink
from crowdtide.sinks.location_log import PER_USER, compact_log as compact_log, vacuum_log as vacuum_log
from crowdtide.sources.location_log import LATE, LOCATED, NO_TIME, NO_USER


def kafka_options(brokers: str, topics: str, group: str, **extra: str) -> dict[str, str]:
    """Kafka reader options: comma-separated topics, start at the newest offset, progress in the checkpoint."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(t.strip() for t in topics.split(",")),
        "kafka.group.id": group,
        "startingOffsets": "latest",
        **extra,
    }


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    stream = spark.readStream.format("kafka").options(**options).load()
    return unwrap(stream)


def unwrap(messages: DataFrame) -> DataFrame:
    """The message value as text; the key is not used."""
    return messages.select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def newest_in_batch(lines: DataFrame) -> DataFrame:
    """The newest signal per user of one batch, with its text; signals without a readable time are not taken."""
    timed = locate_signals(parse_signals(lines)).where(F.col("event_time").isNotNull())
    return latest_per_user(timed, keep=PER_USER, order_by=LOG_ORDER)


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def sort_out(lines: DataFrame, watermark: datetime | None = None) -> DataFrame:
    """What becomes of each line of a batch, in one pass: the columns of ``SIGNAL_ROWS`` but for those of the batch.

    Of a user's located signals the newest is kept. Signals at or before the watermark are late, those without
    a phone number or a readable time cannot be used: of these one row per different line is kept. ``signals``
    counts the lines that a row stands for. Both kinds are combined before the shuffle, so neither a user nor
    a line with most of the batch is a hot key.
    """
    parsed = parse_signals(lines, keep=("value",)).withColumn("event_time", parse_time(F.col("endtime")))
    when = F.col("event_time")
    outcome = F.when(is_blank(F.col("msisdn")), NO_USER).when(when.isNull(), NO_TIME)
    if watermark is not None:
        outcome = outcome.when(when <= ntz(watermark), LATE)
    located = F.col("outcome") == LOCATED
    rows = parsed.select(
        outcome.otherwise(LOCATED).alias("outcome"),
        "msisdn",
        F.concat("lac", F.lit(S.CELL_JOINER), "ci").alias("cell_id"),
        "event_time",
        F.col("eventid").try_cast("long").alias("event_no"),
        F.concat_ws(S.SIGNAL_SEP, "intime", "eventid").alias("seq"),
        "value",
        F.concat_ws(S.SIGNAL_SEP, *S.SIGNAL_FIELDS).alias("signal"),
    ).withColumn("value", F.when(located, F.col("signal")).otherwise(F.col("value")))
    kept = ("cell_id", "event_time", "event_no", "seq", "value")
    newest = F.max_by(F.struct(*kept), F.struct(*LOG_ORDER)).alias("newest")
    grouped = rows.groupBy("outcome", "msisdn", F.when(~located, F.col("value")).alias("line")).agg(newest, F.count("*").alias("signals"))
    late = F.call_function("div", micros_between(F.col("newest.event_time"), ntz(watermark)), F.lit(1_000_000)) if watermark else F.lit(None)
    return grouped.select("outcome", "msisdn", "newest.*", "signals", F.when(F.col("outcome") == LATE, late).cast("long").alias("lag_seconds"))


def append_batch(
    path: str, clock: Callable[[], datetime] = utc_now, files: int | None = None, delay: timedelta | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds a batch to the log at ``path`` and commits it.

    The rows of a batch that is run again take the place of its own, in a later hour too. ``ingest_time`` is
    the UTC clock of the attempt. ``files`` deals the finished rows to so many files; set it where batches are
    small and frequent. With a ``delay``, signals as old as the newest of all earlier batches less the delay
    are late; without one no signal is.
    """

    def write(lines: DataFrame, batch_id: int) -> None:
        spark, now, attempt, seen = lines.sparkSession, clock(), ledger.stamped_name(), Observation()
        watermark = sink.watermark_before(spark, path, batch_id, delay) if delay is not None else None
        stamp = {"ingest_time": ntz(now), "ingest_hour": F.lit(now.strftime("%Y%m%d%H"))}
        stamp |= {"batch_id": F.lit(batch_id).cast("long"), "attempt": F.lit(attempt)}
        rows = sort_out(lines, watermark).withColumns(stamp)
        rows = rows.repartition(files, "msisdn", "value") if files else rows
        outcome, signals = F.col("outcome"), F.col("signals")
        # Counted where rows are written: what a lost executor has to do again is not counted twice.
        rows = rows.observe(
            seen,
            F.sum(signals).alias("signals"),
            F.sum(F.when(outcome == LOCATED, signals)).alias("located"),
            F.count_if(outcome == LOCATED).alias("kept"),
            F.sum(F.when(outcome == LATE, signals)).alias("late"),
            F.sum(F.when(outcome.isin(NO_USER, NO_TIME), signals)).alias("rejected"),
            F.max(F.when(outcome == LOCATED, F.col("event_time"))).cast("string").alias("newest_event"),
        )
        sink.write_attempt(rows, path)
        counts = dict(seen.get)
        newest = counts.pop("newest_event")
        sink.commit_batch(
            spark, path, batch_id=batch_id, attempt=attempt, ingest_time=now, watermark=watermark,
            newest_event=datetime.fromisoformat(newest) if newest else None, **{k: v or 0 for k, v in counts.items()},
        )

    return write


def start_location_stream(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    clock: Callable[[], datetime] = utc_now,
    files: int | None = None,
    delay: timedelta | None = None,
) -> StreamingQuery:
    """Run the stream: at the interval ``every``, or over what is there and then stop when it is None."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        lines.writeStream.foreachBatch(append_batch(path, clock, files, delay))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def newest_so_far(lines: DataFrame) -> DataFrame:
    """The newest signal per user over the whole stream, as a running aggregate for update mode.

    Its state grows with the number of users; use it for bounded sets of users.
    """
    return newest_in_batch(lines)
