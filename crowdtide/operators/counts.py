"""Head counts per area by home region and by demographic label."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide import schemas as S
from crowdtide.functions import blank_to_unknown, cell_or_unknown, region_bucket

BY_TIME = ("stat_time",)


@dataclass(frozen=True)
class LabelSpec:
    """Where the labels sit in one delimited label file. Field 0 is the user hash."""

    names: tuple[str, ...]
    positions: tuple[int, ...]
    width: int
    sep: str = "|"

    def __post_init__(self) -> None:
        if not self.names or len(self.names) != len(self.positions):
            raise ValueError("names and positions must be non-empty and of equal length")
        if self.width < 1 or any(p < 0 or p >= self.width for p in self.positions):
            raise ValueError("every position must lie inside the row width")
        if self.sep not in ("|", ","):
            raise ValueError("the separator is '|' or ','")

    @classmethod
    def from_config(cls, config: Mapping[str, str]) -> LabelSpec:
        """From text settings ``names``, ``positions``, ``width`` and ``sep_index`` (0 = pipe, 1 = comma)."""
        return cls(
            names=tuple(n.strip() for n in config["names"].split(",")),
            positions=tuple(int(p) for p in config["positions"].split(",")),
            width=int(config["width"]),
            sep="|,"[int(config["sep_index"])],
        )


# The two label files of the standard configuration.
STANDARD_LABELS = (
    LabelSpec(
        names=("age", "gender", "arpu", "equip_brand", "equip_net", "flux_used"),
        positions=(1, 2, 3, 4, 5, 6),
        width=7,
    ),
    LabelSpec(
        names=("cz_uv", "cz_distance_work_home", "cz_home_metro_site", "cz_work_metro_site", "cz_ufrom"),
        positions=(4, 1, 2, 3, 6),
        width=7,
    ),
)


def parse_labels(lines: DataFrame, spec: LabelSpec, col: str = "value") -> DataFrame:
    """``user_hash`` and the array of label values present, in the order of the spec.

    A short row keeps the leading labels up to the first one it has no field for. A row without a
    user gets a null hash, which joins to nobody; a test for blanks here would be copied by the
    optimizer to the other side of the join and run there on every signal.
    """
    user = F.nullif(F.substring_index(F.col(col), spec.sep, 1), F.lit(""))
    parts = F.split(F.col(col), re.escape(spec.sep), spec.width)
    reach = [max(spec.positions[: k + 1]) for k in range(len(spec.positions))]
    present = " + ".join(f"int(size(parts) > {r})" for r in reach)
    values = ", ".join(f"coalesce(nullif(get(parts, {p}), ''), '{S.UNKNOWN}')" for p in spec.positions)
    return lines.select(user.alias("user_hash"), parts.alias("parts")).select(
        "user_hash", F.expr(f"slice(array({values}), 1, {present})").alias("values")
    )


def gathered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of equal keys in one task, in all of the session's shuffle partitions; without keys rows stay where they are.

    What follows makes many groups of few bytes, so partitions must not be put together by their bytes.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys) if keys else rows


def count_prefixes(people: DataFrame, area: Sequence[str] = ("cell_id",), by: Sequence[str] = BY_TIME) -> DataFrame:
    """People per area and number prefix: the small table every region count starts from."""
    return people.groupBy(*by, *area, "prefix7").agg(F.count(F.lit(1)).alias("cnt"))


def unpivot_regions(counted: DataFrame, prefix_region: DataFrame, carry: Sequence[str]) -> DataFrame:
    """``carry`` columns, label, value and cnt: head count, home region and its short form.

    Runs on prefix counts, so the join and the three-way unpivot see one row per area and prefix
    and never a user row. Every match of a repeated prefix counts.
    """
    regions = prefix_region.where(F.col("prefix7").isNotNull()).select("prefix7", "home_region")
    home = F.col("home_region")
    pairs = F.array(
        F.struct(F.lit(S.LABEL_HEADCOUNT).alias("label"), F.lit(S.LABEL_HEADCOUNT).alias("value")),
        F.struct(F.lit(S.LABEL_REGION).alias("label"), blank_to_unknown(home).alias("value")),
        F.struct(F.lit(S.LABEL_REGION_SHORT).alias("label"), region_bucket(home).alias("value")),
    )
    return (
        counted.join(regions, "prefix7", "left")
        .select(*carry, F.explode(pairs).alias("pair"), "cnt")
        .select(*carry, "pair.label", "pair.value", "cnt")
    )


def region_rows(
    people: DataFrame, prefix_region: DataFrame, area: str = "cell_id", by: Sequence[str] = BY_TIME, gather: Sequence[str] = ()
) -> DataFrame:
    rows = unpivot_regions(gathered(count_prefixes(people, (area,), by), gather), prefix_region, (*by, area))
    return rows.select(*by, cell_or_unknown(F.col(area)).alias("area_id"), "label", "value", "cnt")


def labelled(
    people: DataFrame, labels: Sequence[tuple[LabelSpec, DataFrame]], carry: Sequence[str], gather: Sequence[str] = ()
) -> DataFrame:
    """``carry`` columns, label and value: one row per person and label, none for the unlabelled.

    ``gather`` brings the rows of equal columns into one task before each becomes as many as it has labels:
    for counts of many times, of which a task would else hold every group that any of its people is in.

    All label tables are stacked and joined once, so people are shuffled once however many tables
    there are. Only the values travel; label names are put on after the join. The outer explode
    keeps the optimizer from testing the value arrays a second time on every label row.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [table.select("user_hash", "values", F.lit(n).alias("spec")) for n, (_, table) in enumerate(labels)],
    )
    names = F.array(*[F.array(*[F.lit(n) for n in spec.names]) for spec, _ in labels])
    joined = people.select("user_hash", *carry).join(stacked, "user_hash").select(*carry, "spec", "values")
    return (
        gathered(joined, gather).select(*carry, "spec", F.posexplode_outer("values").alias("at", "value"))
        .where(F.col("at").isNotNull())
        .select(*carry, F.get(F.get(names, F.col("spec")), F.col("at")).alias("label"), "value")
    )


def labelled_in_place(
    people: DataFrame, labels: Sequence[tuple[LabelSpec, DataFrame]], carry: Sequence[str]
) -> DataFrame:
    """The same rows as ``labelled``, for people and labels stored in the same buckets by user.

    Stacked tables would lose their buckets, so each table is joined on its own, its rows gathered per user
    first: people are read once and nothing moves.
    """
    pairs = []
    for n, (spec, table) in enumerate(labels):
        own = table.where(F.col("user_hash").isNotNull()).groupBy("user_hash").agg(F.collect_list("values").alias(f"_{n}"))
        people = people.join(own, "user_hash", "left")
        pairs.append(F.flatten(F.transform(F.coalesce(F.col(f"_{n}"), F.array()), _pairs(spec))))
    return people.select(*carry, F.explode(F.concat(*pairs)).alias("pair")).select(*carry, "pair.label", "pair.value")


def _pairs(spec: LabelSpec) -> Callable[[Column], Column]:
    names = F.array(*[F.lit(n) for n in spec.names])

    def named(values: Column) -> Column:
        return F.transform(values, lambda v, at: F.struct(F.get(names, at).alias("label"), v.alias("value")))

    return named


def label_rows(
    people: DataFrame,
    labels: Sequence[tuple[LabelSpec, DataFrame]],
    area: str = "cell_id",
    by: Sequence[str] = BY_TIME,
    in_place: bool = False,
    gather: Sequence[str] = (),
) -> DataFrame:
    carry = (*by, area)
    return (labelled_in_place(people, labels, carry) if in_place else labelled(people, labels, carry, gather)).select(
        *by,
        cell_or_unknown(F.col(area)).alias("area_id"),
        "label",
        "value",
        F.lit(1).cast("long").alias("cnt"),
    )


def add_up(rows: DataFrame, area: Sequence[str] = ("area_id",), by: Sequence[str] = BY_TIME) -> DataFrame:
    """Sum counts per area, label and value, combined on the map side before the shuffle."""
    return rows.groupBy(*by, *area, "label", "value").agg(F.sum("cnt").alias("cnt"))


def head_counts(people: DataFrame, area: str = "cell_id", by: Sequence[str] = BY_TIME) -> DataFrame:
    """People per area, without looking at who they are."""
    return people.groupBy(*by, cell_or_unknown(F.col(area)).alias("area_id")).agg(F.count(F.lit(1)).alias("cnt"))


def region_counts(
    people: DataFrame, prefix_region: DataFrame, area: str = "cell_id", by: Sequence[str] = BY_TIME
) -> DataFrame:
    return add_up(region_rows(people, prefix_region, area, by), by=by)


def label_counts(
    people: DataFrame,
    labels: Sequence[tuple[LabelSpec, DataFrame]],
    area: str = "cell_id",
    by: Sequence[str] = BY_TIME,
    in_place: bool = False,
) -> DataFrame:
    """``in_place`` is for people and labels that are stored in the same buckets by user."""
    return add_up(label_rows(people, labels, area, by, in_place), by=by)


def area_counts(
    people: DataFrame,
    prefix_region: DataFrame,
    labels: Sequence[tuple[LabelSpec, DataFrame]] = (),
    area: str = "cell_id",
    by: Sequence[str] = BY_TIME,
    gather: Sequence[str] = (),
) -> DataFrame:
    """Region and label counts per area in one sum, so a label named twice still adds up.

    For snapshots of many times ``gather`` names columns of people, of which each group is counted in one task.
    """
    rows = region_rows(people, prefix_region, area, by, gather)
    if labels:
        rows = rows.unionByName(label_rows(people, labels, area, by, gather=gather))
    return add_up(rows, by=by)
