"""Roll-ups: area counts carried to larger areas over weighted many-to-many bridges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.functions import blank_to_unknown

BY_TIME = ("stat_time",)

LEVEL_GRID = "grid"
LEVEL_DISTRICT = "sub"

# The same district may be reached on several ways; the highest rank is the one published.
BRANCH_RANK = {"grid": 1, "city": 1, "cell": 2, "parent": 3}


@dataclass(frozen=True)
class Bridges:
    """Area bridges, each ``from_id, to_id, ratio``; a null ratio counts in full."""

    cell_grid: DataFrame
    grid_district: DataFrame
    cell_district: DataFrame
    district_parent: DataFrame


def roll_up(stats: DataFrame, bridge: DataFrame, by: Sequence[str] = BY_TIME) -> DataFrame:
    """Sum ``cnt * ratio`` per target area, rounded half up; areas without a bridge row drop out.

    Inputs are counts, not people, so an area brings at most one row per label value. Products are
    added as decimals: the sum, and so the rounding, is the same in every run and every order.
    """
    edges = bridge.where(F.col("from_id").isNotNull()).select(
        F.col("from_id").alias("area_id"),
        blank_to_unknown(F.col("to_id")).alias("to_id"),
        F.coalesce("ratio", F.lit(1.0)).alias("ratio"),
    )
    share = (F.col("cnt") * F.col("ratio")).cast("decimal(38,18)")
    return (
        stats.join(edges, "area_id")
        .groupBy(*by, F.col("to_id").alias("area_id"), "label", "value")
        .agg(F.round(F.sum(share)).cast("long").alias("cnt"))
    )


def city_total(district_stats: DataFrame, by: Sequence[str] = BY_TIME) -> DataFrame:
    """All administrative districts added up as one area."""
    return (
        district_stats.where(F.col("area_id").startswith(S.CITY_MEMBER_PREFIX))
        .groupBy(*by, "label", "value")
        .agg(F.sum("cnt").alias("cnt"))
        .select(*by, F.lit(S.CITY_AREA).alias("area_id"), "label", "value", "cnt")
    )


def _tagged(bridge: DataFrame, step: str, target: str, level: str) -> DataFrame:
    return bridge.select(
        F.lit(step).alias("step"), "from_id", "to_id", "ratio", F.lit(target).alias("branch"), F.lit(level).alias("level")
    )


def _climb(stats: DataFrame, edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """One roll-up over edges of several branches at once; ``step`` says which edges a row may take."""
    edges = edges.where(F.col("from_id").isNotNull()).select(
        "step",
        F.col("from_id").alias("area_id"),
        blank_to_unknown(F.col("to_id")).alias("to_id"),
        F.coalesce("ratio", F.lit(1.0)).alias("ratio"),
        "branch",
        "level",
    )
    share = (F.col("cnt") * F.col("ratio")).cast("decimal(38,18)")
    return (
        stats.join(edges, ["step", "area_id"])
        .groupBy(*by, F.col("to_id").alias("area_id"), "label", "value", "branch", "level")
        .agg(F.round(F.sum(share)).cast("long").alias("cnt"))
    )


def area_stats(cell_stats: DataFrame, bridges: Bridges, by: Sequence[str] = BY_TIME) -> DataFrame:
    """Grid rows and district rows together, marked with ``level`` and the ``branch`` they came by.

    Every step starts from the rounded counts of the step before. Branches climb side by side: cells
    go to grids and districts in one sum, those go to districts and parents in the next, where an
    edge to itself carries each row on unchanged. The plan is one chain, so nothing is computed
    twice and the cell counts are read once.
    """
    up = _tagged(bridges.cell_grid, "cell", "grid", LEVEL_GRID).unionByName(
        _tagged(bridges.cell_district, "cell", "cell", LEVEL_DISTRICT)
    )
    first = _climb(cell_stats.withColumn("step", F.lit("cell")), up, by)

    reached = up.where(F.col("from_id").isNotNull()).select(blank_to_unknown(F.col("to_id")).alias("area"), "branch", "level")
    stay = reached.distinct().select(
        F.col("branch").alias("step"), F.col("area").alias("from_id"), F.col("area").alias("to_id"),
        F.lit(1.0).alias("ratio"), "branch", "level",
    )
    higher = (
        _tagged(bridges.grid_district, "grid", "grid", LEVEL_DISTRICT)
        .unionByName(_tagged(bridges.district_parent, "cell", "parent", LEVEL_DISTRICT))
        .unionByName(stay)
    )
    second = _climb(first.withColumnRenamed("branch", "step").drop("level"), higher, by)

    in_city = (
        F.col("area_id").startswith(S.CITY_MEMBER_PREFIX) & (F.col("branch") == "grid") & (F.col("level") == LEVEL_DISTRICT)
    )
    itself = F.struct(F.col("area_id").alias("area_id"), F.col("branch").alias("branch"))
    city = F.struct(F.lit(S.CITY_AREA).alias("area_id"), F.lit("city").alias("branch"))
    return (
        second.select(*by, "label", "value", "cnt", "level", F.explode(F.when(in_city, F.array(itself, city)).otherwise(F.array(itself))).alias("at"))
        .groupBy(*by, "at.area_id", "label", "value", "at.branch", "level")
        .agg(F.sum("cnt").alias("cnt"))
    )


def derive_district_bridge(district_grid: DataFrame, district_info: DataFrame, grid_info: DataFrame) -> DataFrame:
    """Grid to district: enabled points of interest, then enabled type-1 grids by administration.

    ``district_grid``: gridid, disid. ``district_info``: disid, ispoi, disabled. ``grid_info``:
    gridid, district, gtype, disabled.
    """
    enabled = district_info.where((F.col("ispoi") == "1") & (F.col("disabled") == "0")).select("disid")
    poi = district_grid.join(enabled, "disid").select(F.col("gridid").alias("from_id"), F.col("disid").alias("to_id"))
    admin = grid_info.where((F.col("gtype") == "1") & (F.col("disabled") == "0")).select(
        F.col("gridid").alias("from_id"), F.concat(F.lit(S.CITY_MEMBER_PREFIX + "_"), "district").alias("to_id")
    )
    return poi.unionByName(admin).withColumn("ratio", F.lit(1.0))
