"""Exact top-k search by inner product over a bit-sliced index.

The index has, for each block of rows and each component, ``KEPT_BITS`` bitmaps: bit i of the component's
quantised value in every row. A query multiplies and adds whole columns of rows at once: a component with
weight w puts its slices at the places of w's set bits, a negative weight takes the complement, and full
adders of and, or and xor turn all of them into the slices of each row's quantised score. The k-th highest of
these is found from the most significant slice downward, by counting set bits. What quantising left out is
bounded for the whole block, so rows that may still be among the first k are those not below the k-th by more
than that bound: one more descent marks them, and their scores are computed exactly from the whole vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch
from crowdtide.llm.vectors import BLOCK_ROWS, CHUNK_ROWS, PACKED, Block, best, each_pair, integer_vectors, meet, pack

#: Bits of each component in the index. Fewer make the sums cheaper and leave more rows to look at exactly.
KEPT_BITS = 6


class BitSlices:
    """The index of a block: for each component its slices, and their complements."""

    def __init__(self, n: int, bits: int, shift: int, slices: np.ndarray):
        self.n, self.bits, self.shift = n, bits, shift
        self.slices = np.stack([slices, ~slices])
        self.all = _bitmap(np.arange(n), slices.shape[2])

    @classmethod
    def of(cls, parts: np.ndarray, bits: int = KEPT_BITS) -> BitSlices:
        """Each component less its smallest value, without the lowest bits if it needs more than ``bits``."""
        n, dims = parts.shape
        values = parts - parts.min(axis=0).astype(np.int64)
        shift = max(0, int(values.max(initial=0)).bit_length() - bits)
        values >>= shift
        bit = np.zeros((dims, bits, 64 * -(-n // 64)), np.uint8)
        for i in range(bits):
            bit[:, i, :n] = (values >> i & 1).T
        return cls(n, bits, shift, np.packbits(bit, axis=2, bitorder="little").view(np.uint64))

    @classmethod
    def read(cls, row: dict) -> BitSlices:
        slices = np.frombuffer(row["slices"], "<u8").reshape(row["dims"], row["bits"], -(-row["n"] // 64))
        return cls(row["n"], row["bits"], row["shift"], slices)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """The slices of ``sum |q| * x``, least significant first; x is complemented where q is negative."""
        weight, sign = np.abs(query), (query < 0).astype(np.intp)
        places = int(weight.max(initial=0)).bit_length() + self.bits - 1
        columns: list[list[np.ndarray]] = [[] for _ in range(places)]
        for b in range(places - self.bits + 1):
            dims = np.flatnonzero(weight >> b & 1)
            if len(dims):
                chosen = self.slices[sign[dims], dims]
                for i in range(self.bits):
                    columns[b + i].append(chosen[:, i])
        return add_slices(columns)

    def slack(self, query: np.ndarray) -> int:
        """By how much a row's quantised score can be behind one of lower or equal score."""
        return ((1 << self.shift) - 1) * int(np.abs(query).sum()) >> self.shift


def _bitmap(places: np.ndarray, words: int) -> np.ndarray:
    bit = np.zeros(64 * words, np.uint8)
    bit[places] = 1
    return np.packbits(bit, bitorder="little").view(np.uint64)


def add_slices(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Bitmaps by place value to one bitmap a place: three of a place become one there and one a place up."""
    columns, out, place = [list(c) for c in columns], [], 0
    while place < len(columns):
        if columns[place]:
            stack = np.concatenate(columns[place])
            while len(stack) > 1:
                k = max(1, len(stack) // 3)
                a, b = stack[:k], stack[k : 2 * k]
                odd, carry = a ^ b, a & b
                if len(stack) > 2:
                    c = stack[2 * k : 3 * k]
                    carry |= odd & c
                    odd ^= c
                if place + 1 == len(columns):
                    columns.append([])
                columns[place + 1].append(carry)
                stack = np.concatenate((odd, stack[3 * k :])) if len(stack) > 2 else odd
            out.append(stack[0])
        else:
            out.append(None)
        place += 1
    some = next((s for s in out if s is not None), None)
    return [np.zeros_like(some) if s is None else s for s in out] if some is not None else []


def kth_highest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th highest sum among ``rows``, from the most significant slice downward; 0 if there are fewer."""
    value, above, tied = 0, 0, rows
    for i in range(len(slices) - 1, -1, -1):
        hit = tied & slices[i]
        number = int(np.bitwise_count(hit).sum())
        if above + number >= k:
            value, tied = value | 1 << i, hit
        else:
            above, tied = above + number, tied & ~slices[i]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    """The rows whose sum is ``value`` or more."""
    if value <= 0:
        return rows
    more, tied = np.zeros_like(rows), rows
    for i in range(len(slices) - 1, -1, -1):
        if value >> i & 1:
            tied = tied & slices[i]
        else:
            more |= tied & slices[i]
            tied = tied & ~slices[i]
    return more | tied


def candidates(index: BitSlices, query: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among the ``k`` of highest score."""
    slices = index.sums(query)
    cut = kth_highest(slices, rows, k) - index.slack(query)
    found = at_least(slices, rows, cut)
    return np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))


def _index(bits: int):
    """Adds the slices to each packed block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                made = BitSlices.of(Block({c: row[c][0].as_py() for c in batch.schema.names}).parts, bits)
                more = [pa.array([made.bits], pa.int64()), pa.array([made.shift], pa.int64()), pa.array([made.slices[0].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*row.columns, *more], [*batch.schema.names, "bits", "shift", "slices"])

    return run


def build_index(vectors: DataFrame, scratch: Scratch, bits: int = KEPT_BITS, size: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The written index of every row of ``vectors``, one row a block, and the number of blocks."""
    blocks, number = pack(vectors, size, scratch, "rows")
    return scratch.keep(blocks.mapInArrow(_index(bits), f"{PACKED}, bits long, shift long, slices binary"), "index"), number


def _search(k: int):
    def work(rows: dict, queries: dict) -> dict[str, np.ndarray]:
        block, index, asked = Block(rows), BitSlices.read(rows), Block(queries)
        dims, out = min(rows["dims"], queries["dims"]), {"query_id": [], "vec_id": [], "score": []}
        wanted = np.zeros((len(asked.ids), rows["dims"]), np.int64)
        wanted[:, :dims] = asked.parts[:, :dims]
        for id, query in zip(asked.ids.tolist(), wanted, strict=True):
            others, own = index.all, int(np.searchsorted(block.ids, id))
            if own < len(block.ids) and block.ids[own] == id:
                others = others & ~_bitmap(np.array([own]), len(others))
            at = candidates(index, query, others, k)
            scores = block.parts[at].astype(np.int64) @ query
            first = np.lexsort((at, -scores))[:k]
            out["query_id"].append(np.full(len(first), id))
            out["vec_id"].append(block.ids[at[first]])
            out["score"].append(scores[first])
        return {name: np.concatenate(v) if v else np.zeros(0, np.int64) for name, v in out.items()}

    return work


def exact_top_k(
    rows: DataFrame, queries: Column, k: int = 5, *, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0, bits: int = KEPT_BITS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` holds for, the ``k`` others of highest score.

    The score is the inner product of the components ``floor(scale * x)``; equal scores come by id. Rows with
    a null id, a null vector or a null or non-finite component take no part. Shorter vectors count as filled
    up with zeros, and components beyond ``LARGEST`` in size as that. Rows that share an id are one, of
    smallest components; so a repeated row is never its own neighbour. With fewer than ``k`` others all are
    given, with no rows or no queries nothing. Further columns are not read.

    Every block of rows meets every chunk of queries in one task, whatever vectors are alike; a block
    returns ``k`` rows a query, and these are merged.
    """
    scratch = Scratch(rows.sparkSession, "bit-sliced")
    marked = rows.select(F.col(id), F.col(vector), queries.alias("_asked"))
    index, n_blocks = build_index(integer_vectors(marked, id, vector, scale=scale), scratch, bits)
    chunks, n_chunks = pack(integer_vectors(marked.where("_asked"), id, vector, scale=scale), CHUNK_ROWS, scratch, "queries")
    found = each_pair(_search(k), "query_id long, vec_id long, score long", meet(index, n_blocks, chunks, n_chunks))
    return best(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], k).select("query_id", "rank", "vec_id", "score")
