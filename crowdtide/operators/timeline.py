"""Times as data: ranges of snapshot times, and snapshots for a whole range in one job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.functions import format_time, is_blank, micros_between, ntz, parse_time

STEP = timedelta(minutes=S.STEP_MINUTES)


def expand_ranges(ranges: DataFrame, col: str, keep: Sequence[str] = (), step: timedelta = STEP) -> DataFrame:
    """``begin-end`` text to one ``stat_time`` text row per step, both ends included.

    The begin is always given, even past the end. Text without a dash is itself the one time. Blank
    text, ends that are not 14 characters long and ends that are no time give nothing.
    """
    text = F.col(col)
    ends = F.split(text, "-")
    begin_text, end_text = F.get(ends, F.lit(0)), F.get(ends, F.lit(1))
    begin, end = parse_time(begin_text), parse_time(end_text)
    stepped = F.transform(
        F.sequence(begin, F.greatest(begin, end), F.lit(step)),
        format_time,
    )
    times = (
        F.when(is_blank(text), F.lit(None).cast("array<string>"))
        .when(~text.contains("-"), F.array(text))
        .when(begin.isNotNull() & end.isNotNull(), stepped)
    )
    return ranges.select(*keep, F.explode(times).alias("stat_time"))


def latest_over_range(
    signals: DataFrame,
    begin: datetime,
    end: datetime,
    *,
    step: timedelta = STEP,
    ttl: timedelta = timedelta(seconds=S.TTL_SECONDS),
    key: str = "msisdn",
    keep: Sequence[str] = ("cell_id",),
    order_by: Sequence[str] = ("event_time", "seq"),
) -> DataFrame:
    """Each user's newest live location at every step from ``begin`` to ``end``, in one pass.

    Signals shrink to one per user and step before the shuffle, so a user's group is bounded by the
    number of steps. Each kept signal is then repeated only for the steps at which it is the newest
    live one: the work follows the size of the answer, not steps times signals.
    """
    step_us, ttl_us = step // timedelta(microseconds=1), ttl // timedelta(microseconds=1)
    last = (end - begin) // step
    when = F.col("event_time")

    def steps_up_to(micros: Column) -> Column:
        """Whole steps in ``micros``, rounded up."""
        return F.call_function("div", micros + F.lit(step_us - 1), F.lit(step_us)).cast("int")

    first_step = F.greatest(steps_up_to(micros_between(ntz(begin), when)), F.lit(0))
    live = signals.where((when > ntz(begin - ttl)) & (when <= ntz(end)))
    newest = (
        live.withColumn("at", first_step)
        .groupBy(key, "at")
        .agg(F.max_by(F.struct(*dict.fromkeys(("event_time", *keep))), F.struct(*order_by)).alias("newest"))
    )
    following = F.lead("at").over(Window.partitionBy(key).orderBy("at"))
    expires = steps_up_to(micros_between(ntz(begin), F.col("newest.event_time")) + ttl_us)
    until = F.least(following - 1, expires - 1, F.lit(last))
    moment = F.timestamp_add("MICROSECOND", F.col("n").cast("long") * F.lit(step_us), ntz(begin))
    return (
        newest.select(key, "newest", "at", until.alias("until"))
        .where(F.col("until") >= F.col("at"))
        .select(key, "newest", F.explode(F.sequence("at", "until")).alias("n"))
        .select(key, *[f"newest.{c}" for c in keep], moment.alias("snapshot_time"))
    )
