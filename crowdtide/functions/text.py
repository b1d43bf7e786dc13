"""Column expressions on text: hashing, defaults, delimited fields. All run inside codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from crowdtide import schemas as S


def is_blank(col: Column) -> Column:
    """True for null and for the empty string; never null itself."""
    return F.coalesce(col, F.lit("")) == ""


def blank_to_unknown(col: Column) -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(S.UNKNOWN))


def cell_or_unknown(col: Column) -> Column:
    """A cell id, or ``NULL_VALUE`` when it is blank or made of two blank halves."""
    return F.coalesce(F.nullif(F.nullif(col, F.lit("")), F.lit(S.CELL_JOINER)), F.lit(S.UNKNOWN))


def region_bucket(region: Column) -> Column:
    """Collapse a home region to local, elsewhere or unknown."""
    return (
        F.when(is_blank(region), F.lit(S.UNKNOWN))
        .when(region == S.REGION_LOCAL, region)
        .otherwise(F.lit(S.REGION_ELSEWHERE))
    )


def pseudonym(phone: Column, salt: str | None = None) -> Column:
    """Upper-case MD5 of a phone number; null for a blank one. A blank salt adds nothing."""
    plain = F.nullif(phone, F.lit(""))
    if salt:
        plain = F.concat(plain, F.lit(salt))
    return F.upper(F.md5(plain))


def phone_prefix(phone: Column) -> Column:
    return F.substring(phone, 1, S.PREFIX_LENGTH)


def trimmed_fields(line: Column, sep: str) -> Column:
    """Split on ``sep`` without the blank fields at the end."""
    return F.split(F.rtrim(line, F.lit(sep)), re.escape(sep))
