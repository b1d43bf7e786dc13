"""Area dimensions over JDBC. Relations and columns are the caller's; nothing is assumed of the database."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relation:
    """A table or view with a bridge in it, and the names of its columns.

    A large one is read in ``parts`` queries, cut by the numeric column ``split_by`` between two bounds;
    rows outside the bounds belong to the first and last part.
    """

    name: str
    from_id: str
    to_id: str
    ratio: str | None = None
    split_by: str | None = None
    lower: int = 0
    upper: int = 0
    parts: int = 1


def jdbc_options(relation: Relation, url: str, **connection: str) -> dict[str, str]:
    """Reader options for one bridge; ``connection`` passes driver, user, password and so on."""
    ratio = f", {relation.ratio} AS ratio" if relation.ratio else ""
    split = f", {relation.split_by} AS split_by" if relation.split_by else ""
    query = f"SELECT {relation.from_id} AS from_id, {relation.to_id} AS to_id{ratio}{split} FROM {relation.name}"
    options = {"url": url, "dbtable": f"({query}) bridge", **connection}
    if relation.split_by:
        bounds = {"lowerBound": relation.lower, "upperBound": relation.upper, "numPartitions": relation.parts}
        options |= {"partitionColumn": "split_by"} | {k: str(v) for k, v in bounds.items()}
    return options


def as_bridge(rows: DataFrame) -> DataFrame:
    """Names in lower case whatever the database returns, and a ratio of null where there is none."""
    named = rows.toDF(*[c.lower() for c in rows.columns])
    ratio = F.col("ratio").cast("double") if "ratio" in named.columns else F.lit(None).cast("double")
    return named.select(
        F.col("from_id").cast("string").alias("from_id"), F.col("to_id").cast("string").alias("to_id"), ratio.alias("ratio")
    )


def read_bridge(spark: SparkSession, relation: Relation, url: str, **connection: str) -> DataFrame:
    return as_bridge(spark.read.format("jdbc").options(**jdbc_options(relation, url, **connection)).load())


def read_bridges(
    spark: SparkSession, url: str, relations: Mapping[str, Relation], **connection: str
) -> Mapping[str, DataFrame]:
    return {name: read_bridge(spark, relation, url, **connection) for name, relation in relations.items()}
