"""Location signals: text to columns and back, and the latest location per user."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.functions import is_blank, ntz, parse_time

#: Of a user's signals the newest is the last in this order: by time, then event number, then text.
LOG_ORDER = ("event_time", "event_no", "seq")


def parse_signals(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-blank line; a missing field reads as ``''``, extra fields are ignored."""
    parts = F.split(F.col(col), re.escape(S.SIGNAL_SEP))
    fields = [F.coalesce(F.get(parts, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(S.SIGNAL_FIELDS)]
    return lines.where(~is_blank(F.col(col))).select(*keep, *fields)


def serialise_signals(signals: DataFrame, col: str = "value") -> DataFrame:
    """The text form of each signal; a null field is written as nothing."""
    fields = [F.coalesce(F.col(n), F.lit("")) for n in S.SIGNAL_FIELDS]
    return signals.select(F.concat_ws(S.SIGNAL_SEP, *fields).alias(col))


def locate_signals(signals: DataFrame) -> DataFrame:
    """Typed location columns of parsed signals; rows without a phone number are left out.

    ``event_time`` is the end of the signal. Of signals that end together ``LOG_ORDER`` takes the one
    of the larger event number, then that which came in last.
    """
    return signals.where(~is_blank(F.col("msisdn"))).select(
        "msisdn",
        F.concat("lac", F.lit(S.CELL_JOINER), "ci").alias("cell_id"),
        parse_time(F.col("endtime")).alias("event_time"),
        F.col("eventid").try_cast("long").alias("event_no"),
        F.concat_ws(S.SIGNAL_SEP, "intime", "eventid").alias("seq"),
        F.concat_ws(S.SIGNAL_SEP, *S.SIGNAL_FIELDS).alias("signal"),
    )


def rejected_signals(signals: DataFrame) -> DataFrame:
    """Parsed signals that cannot be located, with the reason: no phone number, or no readable end."""
    return signals.withColumn("reject_reason", reject_reason()).where(F.col("reject_reason").isNotNull())


def reject_reason() -> Column:
    """Why a parsed signal cannot be located; null if it can."""
    return F.when(is_blank(F.col("msisdn")), "no_msisdn").when(parse_time(F.col("endtime")).isNull(), "no_time")


def outcome_counts(signals: DataFrame) -> DataFrame:
    """How many parsed signals are located, or rejected for which reason; counted in one pass."""
    outcome = F.coalesce(reject_reason(), F.lit("located")).alias("outcome")
    return signals.select(outcome).groupBy("outcome").agg(F.count("*").alias("n"))


def live_at(signals: DataFrame, as_of: datetime, ttl: timedelta, time_col: str = "event_time") -> DataFrame:
    """Rows in the half-open interval (as_of - ttl, as_of]; a plain range that reaches the scan."""
    when = F.col(time_col)
    return signals.where((when > ntz(as_of - ttl)) & (when <= ntz(as_of)))


def latest_per_user(
    signals: DataFrame,
    *,
    key: str = "msisdn",
    keep: Sequence[str] = ("cell_id",),
    order_by: Sequence[str] = ("event_time", "seq"),
) -> DataFrame:
    """Newest row per user by ``order_by``.

    An aggregate, not a window: each map task sends at most one row per user, so a user with a
    huge share of the signals costs the shuffle nothing.
    """
    newest = F.max_by(F.struct(*keep), F.struct(*order_by))
    return signals.groupBy(key).agg(newest.alias("newest")).select(key, "newest.*")


def latest_locations(
    signals: DataFrame, as_of: datetime, ttl: timedelta = timedelta(seconds=S.TTL_SECONDS), **options
) -> DataFrame:
    """Each user's newest live location at ``as_of``."""
    return latest_per_user(live_at(signals, as_of, ttl), **options)
