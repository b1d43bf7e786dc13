"""Delimited text files. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.functions import is_blank, trimmed_fields
from crowdtide.operators.counts import LabelSpec, parse_labels


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value``, for formats in which a short row means something."""
    return spark.read.text(path)


def read_typed(spark: SparkSession, path: str, columns: Iterable[str], sep: str = ",") -> DataFrame:
    """Rows by a run-time schema of ``name_type`` words; a value that does not parse becomes null."""
    return spark.read.schema(S.runtime_schema(columns)).csv(path, sep=sep, mode="PERMISSIVE")


_BROKEN = "_broken_line"


def read_typed_lines(spark: SparkSession, path: str, columns: Iterable[str], sep: str = ",") -> DataFrame:
    """Rows by a run-time schema, and of lines that do not fit it the text and why, from one scan.

    ``reject_reason`` is ``field_count`` for a line with too many or too few fields and ``bad_value`` for one
    with a field of another type; ``line`` is that line, and the columns hold what could be read of it. For
    accepted rows both are null. An empty field is a null value and no fault. Quoted separators count as text.
    """
    schema = S.runtime_schema(columns)
    names, options = schema.fieldNames(), {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = F.from_csv(F.col("value"), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", {_BROKEN} string", options)
    found = read_lines(spark, path).where(F.trim("value") != "").select(parsed.alias("f"))
    line = F.col(f"f.{_BROKEN}")
    unquoted = F.regexp_replace(line, '"([^"\\\\]|\\\\.|"")*"', "")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit(""))) + 1
    reason = F.when(line.isNotNull(), F.when(fields == len(names), "bad_value").otherwise("field_count"))
    return found.select(*[F.col(f"f.`{n}`").alias(n) for n in names], line.alias("line"), reason.alias("reject_reason"))


def load_labels(spark: SparkSession, settings: Mapping[str, str]) -> list[tuple[LabelSpec, DataFrame]]:
    """The label files that text settings name.

    ``labels`` is how many there are; ``label.1.path`` and the fields of ``LabelSpec.from_config`` under
    ``label.1.`` describe the first, and so on.
    """
    found = []
    for number in range(1, int(settings["labels"]) + 1):
        head = f"label.{number}."
        own = {k.removeprefix(head): v for k, v in settings.items() if k.startswith(head)}
        spec = LabelSpec.from_config(own)
        found.append((spec, parse_labels(read_lines(spark, own["path"]), spec)))
    return found


def read_search_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.SEARCH_LOG).csv(path, sep="\t", quote="")


def parse_prefix_regions(lines: DataFrame, col: str = "value") -> DataFrame:
    """``prefix7,region`` lines; everything after the first comma is the region."""
    parts = F.split(F.col(col), ",", 2)
    return lines.where(~is_blank(F.get(parts, F.lit(0)))).select(
        F.get(parts, F.lit(0)).alias("prefix7"), F.get(parts, F.lit(1)).alias("home_region")
    )


def parse_bridge(lines: DataFrame, col: str = "value") -> DataFrame:
    """``from,to[,ratio]`` lines. Only rows of exactly three fields have a ratio; lines without a target are left out."""
    parts = trimmed_fields(F.col(col), ",")
    ratio = F.when(F.size(parts) == 3, F.get(parts, F.lit(2)).try_cast("double"))
    return lines.where(F.size(parts) >= 2).select(
        F.get(parts, F.lit(0)).alias("from_id"), F.get(parts, F.lit(1)).alias("to_id"), ratio.alias("ratio")
    )


def parse_snapshot(lines: DataFrame, col: str = "value") -> DataFrame:
    """``hash,cell,prefix,time`` lines of an exported snapshot; shorter lines are left out."""
    parts = trimmed_fields(F.col(col), ",")
    names = S.SNAPSHOT.fieldNames()
    return lines.where(F.size(parts) >= 3).select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_stats_lines(spark: SparkSession, path: str) -> DataFrame:
    """Saved statistics text with the columns of its folders."""
    return spark.read.schema("value string, stat_time string, level string, run string").text(path)


def _stats_fields(lines: DataFrame, col: str, keep: Iterable[str] = ()) -> DataFrame:
    """Each line with its fields, in the dialect that the statistics sink writes."""
    fields = F.from_csv(F.col(col), S.STATS_LINE, {**S.STATS_CSV, "mode": "PERMISSIVE"})
    return lines.select(*keep, F.col(col).alias("line"), fields.alias("f")).withColumn("count", F.col("f.cnt").try_cast("long"))


def parse_stats(lines: DataFrame, col: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """``area,label,value,count[,branch]`` lines, quoted as the sink quotes them.

    A line without a whole number as its count is left out; ``rejected_stats`` has those lines.
    """
    names = ("area_id", "label", "value")
    return _stats_fields(lines, col, keep).where(F.col("count").isNotNull()).select(
        *keep, *[F.col(f"f.{n}").alias(n) for n in names], F.col("count").alias("cnt"), F.col("f.branch").alias("branch")
    )


def rejected_stats(lines: DataFrame, col: str = "value") -> DataFrame:
    """The lines that ``parse_stats`` leaves out."""
    return _stats_fields(lines, col).where(F.col("count").isNull()).select("line", F.lit("no_count").alias("reject_reason"))
