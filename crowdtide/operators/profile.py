"""Profiles: the counts of one area and label as one JSON object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.operators.rollup import BRANCH_RANK


def pick_branch(stats: DataFrame, by: Sequence[str] = ("stat_time",)) -> DataFrame:
    """One count per area, label and value: the branch with the highest rank wins."""
    ranks = F.create_map(*[F.lit(x) for pair in BRANCH_RANK.items() for x in pair])
    rank = F.coalesce(F.element_at(ranks, F.col("branch")), F.lit(0))
    return stats.groupBy(*by, "area_id", "label", "value").agg(F.max_by("cnt", rank).alias("cnt"))


def profiles(stats: DataFrame, by: Sequence[str] = ("stat_time",)) -> DataFrame:
    """(area_id, label, profile_json) with sorted keys.

    Counts are placed by area and label once; choosing or adding counts per value and building the
    object then need no further shuffle. A group holds one entry per distinct value of a label,
    never one per person.
    """
    placed = stats.repartition(*[F.col(c) for c in (*by, "area_id", "label")])
    if "branch" in stats.columns:
        # Rows of one branch are added up; statistics saved without branches have just one.
        single = pick_branch(placed.groupBy(*by, "area_id", "label", "value", "branch").agg(F.sum("cnt").alias("cnt")), by)
    else:
        single = placed.groupBy(*by, "area_id", "label", "value").agg(F.sum("cnt").alias("cnt"))
    entries = F.array_sort(F.collect_list(F.struct("value", "cnt")))
    return single.groupBy(*by, "area_id", "label").agg(F.to_json(F.map_from_entries(entries)).alias("profile_json"))


def row_keys(profile: DataFrame, timed: bool = True) -> DataFrame:
    """The published key of each profile: ``area-label-time``, or ``area-label`` for a current table."""
    parts = ["area_id", "label"] + (["stat_time"] if timed else [])
    return profile.withColumn("row_key", F.concat_ws(S.ROWKEY_JOINER, *parts))
