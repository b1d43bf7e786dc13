"""Cutting lineage on storage that outlives an executor."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder the cluster names for checkpoints, else ``fallback``, else one under the warehouse.

    The warehouse is shared by every executor too; a folder of one machine is never chosen here.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or fallback
    return named or posixpath.join(spark.conf.get(WAREHOUSE_CONF), "crowdtide-scratch")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach."""
    return posixpath.join(shared_folder(spark), "crowdtide", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, fallback: str | None = None) -> DataFrame:
    """Compute ``df`` once and write it to the checkpoint folder; later steps read it from there."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark, fallback))
    return df.checkpoint()
