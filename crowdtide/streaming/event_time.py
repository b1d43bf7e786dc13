"""Signals counted by windows of their own time, each window once: when the watermark has passed it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crowdtide.functions import micros_between, ntz
from crowdtide.operators.signals import locate_signals, parse_signals

_EPOCH = datetime(1970, 1, 1)


def micros(moment: Column) -> Column:
    """Microseconds of a zone-free time since 1970, by its own digits."""
    return micros_between(ntz(_EPOCH), moment)


def instant(moment: Column) -> Column:
    """A zone-free time as the instant with the same digits in UTC: watermarks are made of instants only."""
    return F.timestamp_micros(micros(moment))


def zone_free(at: Column) -> Column:
    """The reverse, from microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", at, ntz(_EPOCH))


def interval(length: timedelta) -> str:
    return f"{length // timedelta(milliseconds=1)} milliseconds"


def window_counts(lines: DataFrame, width: timedelta, delay: timedelta) -> DataFrame:
    """(window_start, window_end, cell_id, signals) per cell and window, for append mode.

    A window's counts come out once, when the newest signal seen is more than ``delay`` after its end; a
    signal of a window that is out is dropped, and the state holds the open windows alone. Counting starts
    before the shuffle. Signals without a phone number or a readable time are not counted.
    """
    located = locate_signals(parse_signals(lines)).where(F.col("event_time").isNotNull())
    timed = located.select("cell_id", instant(F.col("event_time")).alias("at")).withWatermark("at", interval(delay))
    counted = timed.groupBy(F.window("at", interval(width)).alias("window"), "cell_id").agg(F.count("*").alias("signals"))
    ends = [zone_free(F.unix_micros(F.col(f"window.{side}"))).alias(f"window_{side}") for side in ("start", "end")]
    return counted.select(*ends, "cell_id", "signals")


def start_append_stream(rows: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Adds what comes out to a table of files, whose readers see whole batches: at an interval, or until all is read."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
