"""Latest location per user as streaming state that expires by itself."""

from __future__ import annotations

from collections.abc import Iterator

from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from crowdtide import schemas as S
from crowdtide.operators.signals import locate_signals, parse_signals
from crowdtide.streaming.event_time import interval, micros, zone_free

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "event_time timestamp_ntz, event_no long, seq string, cell_id string"
_SIGNAL = "msisdn string, cell_id string, event_time timestamp_ntz, event_no long, seq string"
_OUTPUT = "msisdn string, cell_id string, event_time timestamp_ntz"


def newest_rows(batch: pd.DataFrame, time: str = "event_time") -> pd.DataFrame:
    """One row per user, the newest."""
    return batch.sort_values([time, "event_no", "seq"], na_position="first").drop_duplicates("msisdn", keep="last")


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return map(newest_rows, batches)


class NewestLocation(StatefulProcessor):
    """Keeps the newest location of a user.

    The time-to-live starts anew whenever the kept location is written: with a newer signal or one that ties.
    An older signal changes nothing, its time-to-live included.
    """

    def __init__(self, ttl_seconds: int) -> None:
        self._ttl_ms = ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getValueState("newest", _STATE, self._ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self._newest.get() if self._newest.exists() else None
        best = tuple(kept) if kept is not None else None
        changed = False
        for batch in rows:
            top = newest_rows(batch).iloc[-1]
            found = (top["event_time"].to_pydatetime(), int(top["event_no"]), top["seq"], top["cell_id"])
            if best is None or found[:3] >= tuple(best[:3]):
                best, changed = found, True
        if changed:
            self._newest.update(best)
            yield pd.DataFrame({"msisdn": [key[0]], "cell_id": [best[3]], "event_time": [best[0]]})

    def close(self) -> None:
        pass


def newest_with_ttl(lines: DataFrame, ttl_seconds: int = S.TTL_SECONDS) -> DataFrame:
    """One row per user whose newest location changed; needs the session to use ``STATE_PROVIDER``.

    Run it with a processing-time trigger: state on the processing clock always asks for one more
    batch, so an available-now run would not end. Signals without a readable time are not taken, and a
    missing event number counts as -1. Each task sends one row per user and Arrow batch to the state, so a
    user with a large share of the signals is combined before.
    """
    located = locate_signals(parse_signals(lines)).where(F.col("event_time").isNotNull())
    located = located.select("msisdn", "cell_id", "event_time", F.coalesce("event_no", F.lit(-1).cast("long")).alias("event_no"), "seq")
    located = located.mapInPandas(_combine, _SIGNAL)
    return located.groupBy("msisdn").transformWithStateInPandas(
        statefulProcessor=NewestLocation(ttl_seconds),
        outputStructType=_OUTPUT,
        outputMode="Update",
        timeMode="ProcessingTime",
    )


_KEPT = "at long, event_no long, seq string, cell_id string"
_TIMED = "msisdn string, cell_id string, at long, event_no long, seq string"
_EXPIRED = "msisdn string, cell_id string, at long, expires long"


def _combine_timed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield newest_rows(batch, "at")


class ExpiringLocation(StatefulProcessor):
    """Keeps the newest location of a user until the watermark has passed its time-to-live, then gives it out.

    A timer on the signals' own time stands for each user. A newer signal moves it; when it goes off the state is
    cleared. So what expires, and when, follows from the signals and their batches, whenever they are read.
    """

    def __init__(self, ttl_micros: int) -> None:
        self._ttl = ttl_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._newest = handle.getValueState("newest", _KEPT)

    def _timer(self, at: int) -> int:
        """The first millisecond at which a location of that time has expired."""
        return -(-(at + self._ttl) // 1000)

    def _expired(self, key, kept) -> pd.DataFrame:
        return pd.DataFrame({"msisdn": [key[0]], "cell_id": [kept[3]], "at": [kept[0]], "expires": [kept[0] + self._ttl]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = tuple(self._newest.get()) if self._newest.exists() else None
        if kept and self._timer(kept[0]) <= timerValues.getCurrentWatermarkInMs():
            # Its timer would go off after these rows, which begin anew.
            self._handle.deleteTimer(self._timer(kept[0]))
            yield self._expired(key, kept)
            self._newest.clear()
            kept = None
        best = kept
        for batch in rows:
            top = newest_rows(batch, "at").iloc[-1]
            found = (int(top["at"]), int(top["event_no"]), top["seq"], top["cell_id"])
            if best is None or found[:3] > best[:3]:
                best = found
        if best != kept:
            if kept:
                self._handle.deleteTimer(self._timer(kept[0]))
            self._newest.update(best)
            self._handle.registerTimer(self._timer(best[0]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._newest.exists():
            yield self._expired(key, tuple(self._newest.get()))
            self._newest.clear()

    def close(self) -> None:
        pass


def expired_locations(lines: DataFrame, ttl: timedelta = timedelta(seconds=S.TTL_SECONDS), delay: timedelta = timedelta(0)) -> DataFrame:
    """(msisdn, cell_id, event_time, expires): locations whose time-to-live the watermark has passed, for append mode.

    The watermark follows the newest signal by ``delay``; signals that it has passed are dropped. Needs the
    session to use ``STATE_PROVIDER``; runs with any trigger and ends by itself with available-now. Signals
    without a readable time are not taken, and a missing event number counts as -1. Each task sends one row per
    user and Arrow batch to the state, so a user with a large share of the signals is combined before.
    """
    located = locate_signals(parse_signals(lines)).where(F.col("event_time").isNotNull())
    number = F.coalesce("event_no", F.lit(-1).cast("long")).alias("event_no")
    timed = located.select("msisdn", "cell_id", micros(F.col("event_time")).alias("at"), number, "seq").mapInPandas(_combine_timed, _TIMED)
    expired = (
        timed.withColumn("moment", F.timestamp_micros("at"))
        .withWatermark("moment", interval(delay))
        .groupBy("msisdn")
        .transformWithStateInPandas(
            statefulProcessor=ExpiringLocation(ttl // timedelta(microseconds=1)),
            outputStructType=_EXPIRED,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    return expired.select("msisdn", "cell_id", zone_free(F.col("at")).alias("event_time"), zone_free(F.col("expires")).alias("expires"))
