from crowdtide.functions.text import (
    blank_to_unknown,
    cell_or_unknown,
    is_blank,
    phone_prefix,
    pseudonym,
    region_bucket,
    trimmed_fields,
)
from crowdtide.functions.times import format_time, micros_between, ntz, parse_time

__all__ = [
    "blank_to_unknown",
    "cell_or_unknown",
    "format_time",
    "is_blank",
    "micros_between",
    "ntz",
    "parse_time",
    "phone_prefix",
    "pseudonym",
    "region_bucket",
    "trimmed_fields",
]
