"""Who stayed, arrived or left between two snapshots.

A snapshot holds one row per user and time, and the number prefix is a function of the user, so
joins on the user alone meet no hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide.functions import cell_or_unknown, format_time, parse_time
from crowdtide.operators.counts import LabelSpec, add_up, count_prefixes, gathered, labelled, unpivot_regions
from crowdtide.operators.joins import dimension_join

CURRENT = "current"
HOURLY = timedelta(minutes=60)
LAGS = {"stayed_15m": timedelta(minutes=15), "stayed_60m": HOURLY}


def look_back(stat_time: datetime, lag: timedelta) -> datetime:
    return stat_time - lag


def on_the_hour(stat_time: Column) -> Column:
    """True for ``yyyyMMddHHmmss`` text at minute 0, second 0."""
    return stat_time.endswith("0000")


def lags_for(stat_time: datetime) -> dict[str, timedelta]:
    """The comparisons due at ``stat_time``: 15 minutes always, 60 minutes only on the hour."""
    hourly = look_back(stat_time, HOURLY).strftime("%M%S") == "0000"
    return {name: lag for name, lag in LAGS.items() if lag != HOURLY or hourly}


def locate(snapshot: DataFrame, cell_district: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(user_hash, area_id, prefix7): a user is in every district of the cell, or in none."""
    districts = _areas(cell_district, "cell_id")
    return dimension_join(snapshot, districts, "cell_id", spread_by="user_hash").select(
        *by, "user_hash", "area_id", "prefix7"
    )


def stayed(current: DataFrame, earlier: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Located rows found in the same district in both snapshots."""
    keys = [*by, "user_hash", "area_id", "prefix7"]
    return current.select(*keys).join(earlier.select(*keys), keys)


def moved(left: DataFrame, right: DataFrame) -> DataFrame:
    """A row of ``left`` for each row of the same user in ``right`` that differs, or one if there is none.

    (current, earlier) gives arrivals, (earlier, current) departures. A user in several districts
    gives several rows; ``moved_strict`` gives each district at most once.
    """
    other = right.select(
        "user_hash", F.col("area_id").alias("r_area"), F.col("prefix7").alias("r_prefix"), F.lit(True).alias("found")
    )
    same = F.col("area_id").eqNullSafe(F.col("r_area")) & F.col("prefix7").eqNullSafe(F.col("r_prefix"))
    return (
        left.join(other, "user_hash", "left")
        .where(F.col("found").isNull() | ~same)
        .select("user_hash", "area_id", "prefix7")
    )


def moved_strict(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose user is not in that district in ``right``."""
    keys = ["user_hash", "area_id"]
    return left.join(right.select(*keys), keys, "left_anti").select("user_hash", "area_id", "prefix7")


def _areas(cell_district: DataFrame, cell: str) -> DataFrame:
    return cell_district.where(F.col("from_id").isNotNull()).select(
        F.col("from_id").alias(cell), F.coalesce("to_id", F.lit("")).alias("area_id")
    )


def track(snapshots: DataFrame, lags: Mapping[str, timedelta]) -> DataFrame:
    """(stat_time, user_hash, prefix7, cell_now, one cell per lag): where each present user is and was.

    Each user's rows meet in one task, where each is also sent to the later times that look back at it, and
    those of a user and time meet in one aggregate: one shuffle for any number of lags and times, of each row
    once, and the labels are joined by the same key. A user has a row per time, so no task is given more by one.
    The hourly lag is filled only on the hour. Rows without a user are left out.
    """
    stamp = F.col("stat_time")
    roles = [F.struct(stamp.alias("stat_time"), F.lit(0).alias("role"))]
    for n, lag in enumerate(lags.values(), start=1):
        later = format_time(F.col("at") + F.lit(lag))
        roles.append(F.struct(later.alias("stat_time"), F.lit(n).alias("role")))
    # Said here for all that follows: else only the join with labels would say it, and the halves would differ.
    users = snapshots.where(F.col("user_hash").isNotNull()).select("user_hash", "prefix7", "cell_id", "stat_time")
    timed = gathered(users, ("user_hash",)).withColumn("at", parse_time(stamp))
    sent = timed.select("user_hash", "prefix7", "cell_id", F.explode(F.array(*roles)).alias("to")).select(
        "user_hash", "prefix7", "cell_id", "to.stat_time", "to.role"
    )
    cells = [F.max(F.when(F.col("role") == 0, F.col("cell_id"))).alias("cell_now")]
    for n, (name, lag) in enumerate(lags.items(), start=1):
        then = F.max(F.when(F.col("role") == n, F.col("cell_id")))
        if lag == HOURLY:
            then = F.when(on_the_hour(stamp), then)
        cells.append(then.alias(name))
    return (
        sent.groupBy("stat_time", "user_hash", "prefix7").agg(*cells).where(F.col("cell_now").isNotNull())
    )


def movement_counts(
    snapshots: DataFrame,
    lags: Mapping[str, timedelta],
    cell_district: DataFrame,
    prefix_region: DataFrame,
    labels: Sequence[tuple[LabelSpec, DataFrame]] = (),
) -> DataFrame:
    """District counts with a ``movement`` column: all people now, and those who stayed per lag.

    The same numbers as counting ``stayed(locate(..), locate(..))`` lag by lag. Each person gets the list of
    (movement, district) that they count for, from the cells' districts; then labels are joined once for
    all of them. The counts have few keys, so nearly all adding up is done before the shuffle.
    """
    by = ("stat_time",)
    placed = with_movements(track(snapshots, lags), lags, cell_district, by)

    def each(rows: DataFrame, *keep: str) -> DataFrame:
        return rows.select(*by, *keep, F.explode("counts_for").alias("for")).select(*by, *keep, "for.movement", "for.area_id")

    area = ("movement", "area_id")
    rows = unpivot_regions(gathered(count_prefixes(each(placed, "prefix7"), area, by), by), prefix_region, (*by, *area))
    if labels:
        people = each(labelled(placed, labels, (*by, "counts_for"), gather=by), "label", "value")
        rows = rows.unionByName(people.withColumn("cnt", F.lit(1).cast("long")))
    named = rows.withColumn("area_id", cell_or_unknown(F.col("area_id")))
    return add_up(named, area, by)


def _matches(movement: str, then: str) -> Callable[[Column], Column]:
    """For a district now: a pair for each time it is among the districts then."""

    def pairs(a: Column) -> Column:
        same = F.filter(F.coalesce(F.col(then), F.array().cast("array<string>")), lambda b: b == a)
        return F.transform(same, lambda b: F.struct(F.lit(movement).alias("movement"), b.alias("area_id")))

    return pairs


def with_movements(
    tracked: DataFrame, lags: Mapping[str, timedelta], cell_district: DataFrame, by: Sequence[str]
) -> DataFrame:
    """(by, user_hash, prefix7, counts_for): each present person's (movement, area_id) pairs.

    A district that a cell reaches twice counts twice, as in a join. People in no district are left out.
    """
    areas = _areas(cell_district, "cell").groupBy("cell").agg(F.collect_list("area_id").alias("areas"))
    rows = tracked.join(areas.select(F.col("cell").alias("cell_now"), F.col("areas").alias("areas_now")), "cell_now")
    kinds = [F.transform("areas_now", lambda a: F.struct(F.lit(CURRENT).alias("movement"), a.alias("area_id")))]
    for name in lags:
        then = f"areas_{name}"
        rows = rows.join(areas.select(F.col("cell").alias(name), F.col("areas").alias(then)), name, "left")

        kinds.append(F.flatten(F.transform("areas_now", _matches(name, then))))
    return rows.select(*by, "user_hash", "prefix7", F.concat(*kinds).alias("counts_for"))
