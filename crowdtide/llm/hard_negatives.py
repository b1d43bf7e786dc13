"""Hard negatives by slots: one pass over the rows answers all of an anchor's overlapping score windows.

An anchor's positives are its nearest rows of the same label, and each wants the highest-scored rows of other
labels that lie in a window below its own score. The windows of one anchor overlap, but their upper limits
alone cut the scores into disjoint slots: slot j holds the scores from the j-th limit down to the next. The
first k rows under the i-th limit are among the first k of each of the slots i, i + 1, and so on. So each task
keeps only the first k of every slot, these are merged, and a window is answered by merging its slot and the
ones below it and cutting what is under its lower limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch
from crowdtide.llm.vectors import (
    BLOCK_ROWS,
    CHUNK_ROWS,
    Block,
    best,
    each_pair,
    integer_vectors,
    meet,
    pack,
    products,
    top_each,
)

#: Queries whose scores with a block are held at a time.
AT_ONCE = 32
#: No limit: a slot below every score.
_NONE = np.iinfo(np.int64).min


def _lines(rows: dict, queries: dict):
    """The block, and for some queries at a time their places in the chunk and scores with every row."""
    block, asked = Block(rows), Block(queries)
    for low in range(0, len(asked.ids), AT_ONCE):
        some = slice(low, low + AT_ONCE)
        yield block, asked, some, products(asked.parts[some], block.parts)


def _columns(found: list[dict[str, np.ndarray]], names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return {n: np.concatenate([f[n] for f in found]) if found else np.zeros(0, np.int64) for n in names}


def _positives(k: int):
    """The first ``k`` other rows of the query's label in a block."""

    def work(rows: dict, queries: dict) -> dict[str, np.ndarray]:
        found = []
        for block, asked, some, scores in _lines(rows, queries):
            same = (asked.labels[some, None] == block.labels) & (asked.ids[some, None] != block.ids)
            line, place = top_each(scores, k, same)
            found.append({"anchor_id": asked.ids[some][line], "positive_id": block.ids[place], "positive_score": scores[line, place]})
        return _columns(found, ("anchor_id", "positive_id", "positive_score"))

    return work


def slots_of(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """For each line's scores the number of its limits that are not below them: slot 0 is in no window."""
    return (limits[:, :, None] >= scores[:, None, :]).sum(axis=1)


def _negatives(k: int):
    """The first ``k`` rows of other labels in every slot of a query, in a block."""

    def work(rows: dict, queries: dict) -> dict[str, np.ndarray]:
        limits, found = np.frombuffer(queries["limits"], "<i8").reshape(queries["n"], -1), []
        for block, asked, some, scores in _lines(rows, queries):
            other = asked.labels[some, None] != block.labels
            slot = slots_of(scores, limits[some])
            for number in range(1, limits.shape[1] + 1):
                line, place = top_each(scores, k, other & (slot == number))
                found.append(
                    {
                        "anchor_id": asked.ids[some][line],
                        "slot": np.full(len(line), number),
                        "negative_id": block.ids[place],
                        "negative_score": scores[line, place],
                    }
                )
        return _columns(found, ("anchor_id", "slot", "negative_id", "negative_score"))

    return work


def _add_limits(positives: int):
    """Sets each query's limits, highest first, beside its row of the packed chunk."""

    def add(_, packed: pa.Table, limits: pa.Table) -> pa.Table:
        chunk = Block({c: packed[c][0].as_py() for c in packed.column_names})
        out = np.full((len(chunk.ids), positives), _NONE, np.int64)
        at = np.searchsorted(chunk.ids, limits["anchor_id"].to_numpy())
        out[at, limits["rank"].to_numpy() - 1] = limits["limit"].to_numpy()
        return packed.append_column("limits", pa.array([out.astype("<i8").tobytes()], pa.binary()))

    return add


def mine_hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    *,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows ``anchors`` holds for.

    A row's score is the inner product of its components ``floor(scale * x)`` with the anchor's; higher ones
    come first, equal ones by id. Positives are an anchor's first ``positives`` other rows of its label. For
    each, the first ``negatives`` rows of other labels are given whose score is in ``window`` per cent of the
    positive's, both ends included; a window that is empty, as under a negative score, gives nothing. Rows
    with a null id, label or vector or a null or non-finite component take no part. Shorter vectors count as
    filled up with zeros, components beyond ``LARGEST`` in size as that. Rows that share an id are one. With
    no rows or no anchors the result is empty. Further columns are not read.

    Labels are whole numbers. A label with most of the rows is spread like any other: rows are dealt to
    blocks by id. Each block returns a bounded number of rows an anchor.
    """
    scratch = Scratch(rows.sparkSession, "negatives")
    marked = rows.select(F.col(id), F.col(label), F.col(vector), anchors.alias("_anchor"))
    blocks, n_blocks = pack(integer_vectors(marked, id, vector, label, scale), BLOCK_ROWS, scratch, "rows")
    chunks, n_chunks = pack(integer_vectors(marked.where("_anchor"), id, vector, label, scale), CHUNK_ROWS, scratch, "anchors")

    near = each_pair(_positives(positives), "anchor_id long, positive_id long, positive_score long", meet(blocks, n_blocks, chunks, n_chunks))
    near = best(near, ["anchor_id"], [F.desc("positive_score"), F.asc("positive_id")], positives)
    low, high = window
    near = scratch.keep(near.withColumn("limit", _floor_div(F.col("positive_score") * high, 100)), "positives")

    of_chunk = F.pmod(F.xxhash64("anchor_id"), F.lit(n_chunks)).alias("block")
    limits = near.select("anchor_id", "rank", "limit", of_chunk)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema) + ", limits binary"
    armed = chunks.groupBy("block").cogroup(limits.groupBy("block")).applyInArrow(_add_limits(positives), schema)
    armed = scratch.keep(armed, "limits")

    kept = each_pair(_negatives(negatives), "anchor_id long, slot long, negative_id long, negative_score long", meet(blocks, n_blocks, armed, n_chunks))
    order = [F.desc("negative_score"), F.asc("negative_id")]
    kept = best(kept, ["anchor_id", "slot"], order, negatives)
    return _windows(near, kept, negatives, low)


def _floor_div(a: Column, b: int) -> Column:
    """Whole division that rounds down for negative numbers too."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def _windows(near: DataFrame, kept: DataFrame, negatives: int, low: int) -> DataFrame:
    """Each positive's window from the slots at and below its own. An anchor has a bounded number of rows here."""
    entry = F.struct((-F.col("negative_score")).alias("down"), F.col("negative_id").alias("id"), "slot")
    slots = kept.groupBy("anchor_id").agg(F.sort_array(F.collect_list(entry)).alias("slots"))
    below = F.filter("slots", lambda s: s["slot"] >= F.col("rank"))
    first = F.filter(F.slice(below, 1, negatives), lambda s: -s["down"] * 100 >= F.col("positive_score") * low)
    each = near.join(slots, "anchor_id").select("anchor_id", "positive_id", "positive_score", F.posexplode(first).alias("at", "found"))
    return each.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).alias("rank"),
        F.col("found.id").alias("negative_id"),
        "positive_score",
        (-F.col("found.down")).alias("negative_score"),
    )
