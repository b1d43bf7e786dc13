"""Distinct users as sketches that can be merged: stored per day, read for any longer period.

A sketch is a few kilobytes whatever number of users it has seen. Days are written once, from the log; weeks,
months and any other grouping of days come from the sketches, without the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers are 2 to this power: 4096 of them give a standard error of 1.6 %.
REGISTERS_LOG2 = 12


def standard_error(registers_log2: int = REGISTERS_LOG2) -> float:
    """Of an estimate, as a share of the true number. Small numbers are kept exactly."""
    return 1.04 / 2 ** (registers_log2 / 2)


def user_sketches(df: DataFrame, keys: Sequence[str], user: str, registers_log2: int = REGISTERS_LOG2) -> DataFrame:
    """``keys`` and the ``sketch`` of their users. Made in each task and merged, so a hot key moves as one sketch a task.

    Null users are not counted.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(user).cast("string"), F.lit(registers_log2)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The sketches of groups of sketches; all must have been made with the same number of registers."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_users(sketches: DataFrame) -> DataFrame:
    """``uv`` in place of the sketch."""
    others = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*others, F.hll_sketch_estimate("sketch").alias("uv"))
