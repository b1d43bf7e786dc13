"""Filters and one-off aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtide.operators.joins import BROADCAST_LIMIT_BYTES, SALTS, measured_bytes


def multi_filter(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose columns are all in their allowed lists; an empty list is no restriction."""
    tests = [F.col(c).isin(list(values)) for c, values in allowed.items() if values]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def allowed_only(
    df: DataFrame, allowed: Mapping[str, DataFrame], *, spread_by: str, limit_bytes: int = BROADCAST_LIMIT_BYTES, salts: int = SALTS
) -> DataFrame:
    """Rows whose columns are all among allowed values that come as tables of one column, of any length.

    The values stay tables: they are not put into the plan. First the smallest and largest value of each
    column become a range that reaches the scan, so parts of files outside are not read. Then values measured
    at or under ``limit_bytes`` are broadcast, and the rows do not move; others are met by a shuffle in which
    every value is cut into ``salts`` parts by a hash of ``spread_by``, so one with most of the rows fills many
    tasks. Repeated and null values change nothing; an empty table lets no row through.
    """
    for column, values in allowed.items():
        name = values.columns[0]
        distinct = values.where(F.col(name).isNotNull()).select(F.col(name).alias(column)).distinct()
        ends = distinct.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
        if ends["low"] is None:
            return df.where(F.lit(False))
        df = df.where(F.col(column).between(F.lit(ends["low"]), F.lit(ends["high"])))
        if measured_bytes(distinct) <= limit_bytes:
            df = df.join(F.broadcast(distinct), column, "left_semi").select(*df.columns)
            continue
        salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
        copies = distinct.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        df = df.withColumn("_salt", salt).join(copies, [column, "_salt"], "left_semi").select(*df.columns)
    return df


def distinct_users(df: DataFrame, keys: Sequence[str], user: str) -> DataFrame:
    """Distinct users per key. Spark de-duplicates per (key, user) first, so a hot key is spread."""
    return df.groupBy(*keys).agg(F.countDistinct(user).alias("uv"))


def text_length(df: DataFrame, col: str = "value") -> DataFrame:
    """Total length of all lines, in characters."""
    return df.agg(F.coalesce(F.sum(F.length(col)), F.lit(0)).cast("long").alias("total_length"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def select_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which a SQL condition holds."""
    return df.where(F.expr(condition))
