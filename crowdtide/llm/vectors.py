"""Integer vectors in blocks: what the searches over all rows have in common.

Rows are dealt by a hash of their id into blocks of bounded size, and each block is one row with its ids,
labels and components packed. A stated set of queries is packed the same way, in smaller chunks. A search
then meets every pair of a block and a chunk as one row, so no key gathers more than one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch, parts

#: Larger components, in size, count as this one, so that products of vectors fit into a long.
LARGEST = 1 << 26
#: Rows of a block and of a chunk of queries.
BLOCK_ROWS, CHUNK_ROWS = 16384, 256
#: Pairs of a block and a chunk that one task works through.
PAIRS_PER_TASK = 32

PACKED = "block long, n long, dims long, width long, ids binary, labels binary, parts binary"


def integer_vectors(rows: DataFrame, id: str, vector: str, label: str | None = None, scale: float = 256.0) -> DataFrame:
    """(id, label, parts): components as ``floor(scale * x)``, computed in double.

    Rows whose vector is null or has a null or non-finite component are left out, and so are those without an
    id or, where a label is asked for, without one.
    """
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    there = F.col(id).isNotNull() & v.isNotNull() & ~odd
    if label:
        there &= F.col(label).isNotNull()
    limit = F.lit(float(LARGEST))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, limit), -limit)).cast("int"))
    named = F.col(label).cast("long") if label else F.lit(0).cast("long")
    return rows.where(there).select(F.col(id).cast("long").alias("id"), named.alias("label"), whole.alias("parts"))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows of a matrix; a shorter list is filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _pack(table: pa.Table) -> pa.Table:
    """One row for a block, by id. Of rows with one id the one of smallest components, then label, stays."""
    ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
    rows = matrix(table["parts"].combine_chunks())
    order = np.argsort(ids, kind="stable")
    if (np.diff(ids[order]) == 0).any():
        order = np.lexsort((labels, *rows.T[::-1], ids))
        order = order[np.append(True, np.diff(ids[order]) != 0)]
    ids, labels, rows = ids[order], labels[order], rows[order]
    width = np.promote_types(np.min_scalar_type(rows.min(initial=0)), np.min_scalar_type(-1 - int(rows.max(initial=0)))).itemsize
    return pa.table(
        {
            "block": table["block"][:1],
            "n": pa.array([len(ids)], pa.int64()),
            "dims": pa.array([rows.shape[1]], pa.int64()),
            "width": pa.array([width], pa.int64()),
            "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            "labels": pa.array([labels.astype("<i8").tobytes()], pa.binary()),
            "parts": pa.array([rows.astype(f"<i{width}").tobytes()], pa.binary()),
        }
    )


def pack(vectors: DataFrame, size: int, scratch: Scratch, name: str) -> tuple[DataFrame, int]:
    """The vectors in blocks of about ``size`` rows, written, and the number of blocks."""
    number = max(1, -(-vectors.count() // size))
    block = F.pmod(F.xxhash64("id"), F.lit(number)).alias("block")
    packed = vectors.select("*", block).groupBy("block").applyInArrow(_pack, PACKED)
    return scratch.keep(packed, name), number


class Block:
    """A packed block, read back."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.parts = np.frombuffer(row["parts"], f"<i{row['width']}").reshape(row["n"], row["dims"])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, exactly, over the columns that both have."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims].astype(np.float64), b[:, :dims].astype(np.float64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * dims < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def meet(blocks: DataFrame, n_blocks: int, chunks: DataFrame, n_chunks: int) -> DataFrame:
    """(rows, queries): every block with every chunk, dealt evenly to tasks."""
    pairs = n_blocks * n_chunks
    tasks = max(min(pairs, parts(blocks.sparkSession)), -(-pairs // PAIRS_PER_TASK))

    def side(df: DataFrame, own: str, other: str, n_other: int, name: str) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other)
        return df.select(F.struct(*df.columns).alias(name), F.col("block").alias(own), each).repartition(tasks, "_a", "_b")

    left = side(blocks, "_a", "_b", n_chunks, "rows")
    return left.join(side(chunks, "_b", "_a", n_blocks, "queries"), ["_a", "_b"]).select("rows", "queries")


def each_pair(work: Callable[[dict, dict], dict[str, np.ndarray]], schema: str, pairs: DataFrame) -> DataFrame:
    """``work`` on each pair of a block and a chunk, in tasks; it returns columns of long."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = work(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(found[n], pa.int64()) for n in names], names)

    return pairs.mapInArrow(run, schema)


def top_each(scores: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, place) of the ``k`` highest allowed scores of each line, of equal ones the first."""
    if not scores.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    barred = np.iinfo(np.int64).min
    scores = np.where(allowed, scores, barred)
    cut = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(scores), barred)
    line, place = np.nonzero((scores >= cut[:, None]) & (scores != barred))
    order = np.lexsort((place, -scores[line, place], line))
    line, place = line[order], place[order]
    rank = np.arange(len(line)) - np.searchsorted(line, line)
    return line[rank < k], place[rank < k]


def best(rows: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with their ``rank``. Each task passes on no more than ``k`` a group."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)
