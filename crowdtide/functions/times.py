"""Column expressions on ``timestamp_ntz`` and on ``yyyyMMddHHmmss`` text.

Everything stays zone-free, so the session time zone cannot shift a snapshot.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_time(text: Column) -> Column:
    """``yyyyMMddHHmmss`` to ``timestamp_ntz``; null for anything else."""
    day = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    hour = F.concat_ws(":", F.substring(text, 9, 2), F.substring(text, 11, 2), F.substring(text, 13, 2))
    iso = F.concat(day, F.lit(" "), hour)
    return F.when(text.rlike("^[0-9]{14}$"), iso.try_cast("timestamp_ntz"))


def format_time(moment: Column) -> Column:
    """``yyyyMMddHHmmss`` of a zone-free time, from its own digits.

    A date formatter would first read it in the session's zone, and move times that a clock change skips.
    """
    return F.translate(F.substring(moment.cast("string"), 1, 19), "-: ", "")


def micros_between(start: Column, end: Column) -> Column:
    """Exact microseconds from ``start`` to ``end``, as a long."""
    gap = end - start

    def part(name: str) -> Column:
        return F.extract(F.lit(name), gap)

    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("long")
