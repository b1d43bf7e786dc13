"""Joining a large table to a dimension whose size is measured, not assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 << 20
SALTS = 32
_ROW_OVERHEAD = 16


def measured_bytes(dim: DataFrame) -> int:
    """Size of ``dim`` as text plus a fixed cost per value, from one distributed sum."""
    row = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(_ROW_OVERHEAD) for c in dim.columns),
        F.lit(0),
    )
    return dim.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("n")).first()["n"]


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "inner",
    *,
    spread_by: str,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join row-level ``facts`` to ``dim``, whatever share of the facts one key holds.

    A dimension measured at or under ``limit_bytes`` is broadcast, so the facts do not move. A
    larger one is shuffled with every key cut into ``salts`` parts by a hash of ``spread_by``: a
    key with a third of all facts still fills many tasks. Both give the same rows.
    """
    if measured_bytes(dim) <= limit_bytes:
        return facts.join(F.broadcast(dim), on, how)
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", salt).join(copies, [on, "_salt"], how).drop("_salt")
