"""Snapshots: latest locations with the phone number replaced by its hash."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide.functions import format_time, is_blank, phone_prefix, pseudonym, trimmed_fields

REASON_FIELDS = "field_count"
REASON_USER = "no_msisdn"


def split_location_lines(lines: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``msisdn,cell`` text to columns, with ``reject_reason`` set on rows that cannot be used."""
    parts = trimmed_fields(F.col(col), ",")
    reason = (
        F.when(is_blank(F.col(col)) | (F.size(parts) != 2), F.lit(REASON_FIELDS))
        .when(is_blank(F.get(parts, F.lit(0))), F.lit(REASON_USER))
        .otherwise(F.lit(None).cast("string"))
    )
    return lines.select(
        *keep,
        F.col(col).alias("line"),
        F.get(parts, F.lit(0)).alias("msisdn"),
        F.get(parts, F.lit(1)).alias("cell_id"),
        reason.alias("reject_reason"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNull()).select("msisdn", "cell_id")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNotNull()).drop("msisdn", "cell_id")


def build_snapshot(locations: DataFrame, stat_time: datetime | Column, salt: str | None = None) -> DataFrame:
    """Hash the users of ``locations`` and stamp the rows; a blank phone number is no user.

    The hash is written so that it can never be null. Otherwise a later join would add a test for
    it, and that test, MD5 included, would be pushed down to every raw signal.
    """
    phone = F.col("msisdn")
    if isinstance(stat_time, datetime):
        stamp = F.lit(stat_time.strftime("%Y%m%d%H%M%S"))
    else:
        stamp = format_time(stat_time)
    return locations.where(phone.isNotNull() & (phone != "")).select(
        F.coalesce(pseudonym(phone, salt), F.lit("")).alias("user_hash"),
        "cell_id",
        phone_prefix(phone).alias("prefix7"),
        stamp.alias("stat_time"),
    )
