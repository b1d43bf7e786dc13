"""Table schemas and the fixed values that published rows depend on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Field order of a pipe-separated location signal.
SIGNAL_FIELDS = (
    "datasrc", "msisdn", "lac", "ci", "begintime", "endtime",
    "fstintime", "intime", "eventid", "appid", "websiteid",
)
SIGNAL_SEP = "|"

# Words that appear in published rows.
UNKNOWN = "NULL_VALUE"
CELL_JOINER = "$"
LABEL_HEADCOUNT = "uv"
LABEL_REGION = "ufrom"
LABEL_REGION_SHORT = "ufrom_short"
REGION_LOCAL = "310000"
REGION_ELSEWHERE = "999999"
CITY_AREA = "DIS_ALL"
CITY_MEMBER_PREFIX = "CAN"
ROWKEY_JOINER = "-"
COMPLETE_MARK = "DATA_FLAG"

# Times and periods.
TIME_FORMAT = "yyyyMMddHHmmss"
STEP_MINUTES = 15
TTL_SECONDS = 3600
PREFIX_LENGTH = 7


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


SIGNAL = _strings(*SIGNAL_FIELDS)
SNAPSHOT = _strings("user_hash", "cell_id", "prefix7", "stat_time")
PREFIX_REGION = _strings("prefix7", "home_region")
BRIDGE = T.StructType(
    [
        T.StructField("from_id", T.StringType()),
        T.StructField("to_id", T.StringType()),
        T.StructField("ratio", T.DoubleType()),
    ]
)
AREA_STATS = T.StructType(
    [
        T.StructField("area_id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("cnt", T.LongType()),
        T.StructField("branch", T.StringType()),
        T.StructField("stat_time", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)
# A line of statistics text. Lines of four fields have no branch.
STATS_LINE = "area_id string, label string, value string, cnt string, branch string"
# A missing value is written as \\N, an empty one as two quotes.
STATS_CSV = {"quote": '"', "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
PROFILE = _strings("area_id", "label", "profile_json", "stat_time", "movement", "run")
CURRENT_PROFILE = _strings("area_id", "label", "profile_json", "run")
REJECTED = _strings("line", "reject_reason", "stat_time", "run")
MARKS = _strings("complete", "kind", "stat_time", "movement", "run", "marked_at", "source")
FINGERPRINTS = _strings("stat_time", "fingerprint", "written_at")
LOCATION_LOG = T.StructType(
    [
        T.StructField("msisdn", T.StringType()),
        T.StructField("cell_id", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_no", T.LongType()),
        T.StructField("seq", T.StringType()),
        T.StructField("signal", T.StringType()),
        T.StructField("ingest_time", T.TimestampNTZType()),
        T.StructField("ingest_hour", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
# What became of the signals of a batch. Of a user's located signals the newest is kept, of equal other lines one.
SIGNAL_ROWS = T.StructType(
    [
        T.StructField("msisdn", T.StringType()),
        T.StructField("cell_id", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_no", T.LongType()),
        T.StructField("seq", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("signals", T.LongType()),
        T.StructField("lag_seconds", T.LongType()),
        T.StructField("ingest_time", T.TimestampNTZType()),
        T.StructField("ingest_hour", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.StringType()),
    ]
)
BATCH_COMMITS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("ingest_time", T.TimestampNTZType()),
        T.StructField("watermark", T.TimestampNTZType()),
        T.StructField("newest_event", T.TimestampNTZType()),
        T.StructField("signals", T.LongType()),
        T.StructField("located", T.LongType()),
        T.StructField("kept", T.LongType()),
        T.StructField("late", T.LongType()),
        T.StructField("rejected", T.LongType()),
    ]
)
BASE_ROWS = T.StructType(
    [f for f in LOCATION_LOG if f.name != "batch_id"]
    + [T.StructField("bucket", T.IntegerType()), T.StructField("version", T.StringType())]
)
# One row per renewed bucket, and one without a bucket for the batch that the base now goes up to.
BASE_VERSIONS = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("version", T.StringType()),
        T.StructField("upto", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("newest", T.StringType()),
        T.StructField("has_rows", T.BooleanType()),
        T.StructField("at", T.DoubleType()),
    ]
)
SEARCH_LOG = _strings("date", "user", "keyword", "city", "platform", "version")

_RUNTIME_TYPES = {"string": T.StringType(), "int": T.IntegerType()}


def runtime_schema(columns: Iterable[str]) -> T.StructType:
    """Schema from ``name_type`` words such as ``age_int``; ``string`` and ``int`` only."""
    fields = []
    for word in columns:
        name, _, kind = word.rpartition("_")
        if not name or kind not in _RUNTIME_TYPES:
            raise ValueError(f"expected name_string or name_int, got {word!r}")
        fields.append(T.StructField(name, _RUNTIME_TYPES[kind]))
    return T.StructType(fields)
