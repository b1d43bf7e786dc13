"""Exact top-k search and hard negatives against every pair, on odd rows and random vectors."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtide.llm import bit_sliced_topk as bs
from crowdtide.llm import hard_negatives as hn
from crowdtide.llm import vectors
from crowdtide.llm.bit_sliced_topk import BitSlices, add_slices, at_least, exact_top_k, kth_highest
from crowdtide.llm.common import table
from crowdtide.llm.hard_negatives import mine_hard_negatives
from crowdtide.llm.queries import op12_slot_negatives, op13_bit_sliced_topk

SCHEMA = "vec_id long, embedding array<float>, label int, ids string, block int, rows string, rank string, parts int"
NAN, INF = float("nan"), float("inf")


def usable(rows, label=False):
    """id to (whole components, label): rows that take part, one per id."""
    found = {}
    for id, vector, own, *_ in rows:
        if id is None or vector is None or (label and own is None) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        parts = [max(-vectors.LARGEST, min(vectors.LARGEST, math.floor(256 * float(np.float32(x))))) for x in vector]
        key = (parts + [0] * (20 - len(parts)), own if label else 0)
        found[id] = min(found.get(id, key), key)
    return found


def score(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def top(rows, k=5):
    own, out = usable(rows), []
    for q in own:
        if q % 50 == 0:
            ranked = sorted((-score(own[q][0], v), id) for id, (v, _) in own.items() if id != q)
            out += [(q, n, id, -s) for n, (s, id) in enumerate(ranked[:k], start=1)]
    return sorted(out)


def mined(rows, positives=5, negatives=3):
    own, out = usable(rows, label=True), []
    for a in own:
        if a % 50:
            continue
        ranked = sorted((-score(own[a][0], v), id, label) for id, (v, label) in own.items() if id != a)
        for p, pos, _ in [r for r in ranked if r[2] == own[a][1]][:positives]:
            fit = [r for r in ranked if r[2] != own[a][1] and -50 * p <= -100 * r[0] <= -95 * p][:negatives]
            out += [(a, pos, n, id, -p, -s) for n, (s, id, _) in enumerate(fit, start=1)]
    return sorted(out)


def random_rows(seed, n, dims, labels, alike=0):
    own = random.Random(seed)
    rows = []
    for i in range(n):
        v = [own.gauss(0, 0.3) for _ in range(dims)] if i >= alike else [0.25] * dims
        rows.append((i, v, own.randrange(labels) if i % 3 else 0))
    return rows


ODD = [
    (None, [0.1, 0.2], 1),
    (0, None, 1),
    (50, [0.5, None], 1),
    (100, [0.5, NAN], 1),
    (150, [0.5, INF], 1),
    (200, [0.5, -0.25, 0.125], 1),
    (200, [0.5, -0.25, 0.125], 1),
    (200, [0.5, 0.25, 0.125], 2),
    (250, [], 0),
    (300, [0.0, 0.0], 0),
    (350, [1e30, -1e30, 3.0], 2),
    (400, [-0.001, 0.001], None),
    (-50, [0.3], 1),
    *[(i, [0.25, 0.25, 0.25], i % 3) for i in range(1, 12)],
    *[(i, [0.5, 0.4, 0.01 * i], i % 2) for i in range(13, 40)],
]


@pytest.fixture
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], SCHEMA).repartition(3)

    return make


def found(df):
    return sorted(tuple(r) for r in df.collect())


def asked():
    return F.col("vec_id") % 50 == 0


@pytest.mark.parametrize("rows", [ODD, ODD[:5], ODD[5:6], random_rows(1, 400, 16, 4), random_rows(2, 300, 3, 2, alike=200)], ids=["odd", "unusable", "one", "random", "alike"])
def test_both_equal_every_pair(frame, rows):
    assert found(exact_top_k(frame(rows), asked())) == top(rows)
    assert found(mine_hard_negatives(frame(rows), asked())) == mined(rows)


def test_many_small_blocks_give_the_same(frame, monkeypatch):
    rows = random_rows(3, 500, 8, 3, alike=120)
    for module in (bs, hn):
        monkeypatch.setattr(module, "BLOCK_ROWS", 70)
        monkeypatch.setattr(module, "CHUNK_ROWS", 3)
    monkeypatch.setattr(bs.build_index, "__defaults__", (bs.KEPT_BITS, 70))
    assert found(exact_top_k(frame(rows), asked(), k=7, bits=3)) == top(rows, 7)
    assert found(mine_hard_negatives(frame(rows), asked(), 4, 2)) == mined(rows, 4, 2)
    assert len(mined(rows, 4, 2)) > 20


def test_empty_tables(frame):
    assert found(exact_top_k(frame([]), asked())) == [] == found(mine_hard_negatives(frame([]), asked()))
    nobody = random_rows(1, 30, 4, 2)[1:]
    assert found(exact_top_k(frame(nobody), asked())) == [] == found(mine_hard_negatives(frame(nobody), asked()))


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 200), st.integers(1, 6), st.integers(1, 8), st.integers(1, 9), st.integers(1, 12))
def test_slices_add_and_select(seed, n, dims, bits, k, spread):
    """The sums read from the slices, the k-th highest, and the rows from a value on."""
    own = np.random.default_rng(seed)
    parts = own.integers(-(1 << spread), 1 << spread, (n, dims))
    query = own.integers(-(1 << spread), 1 << spread, dims)
    index = BitSlices.of(parts, bits)
    slices = index.sums(query)

    def read(bitmap):
        return np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n].astype(np.int64)

    kept = parts - parts.min(axis=0) >> index.shift
    want = np.where(query < 0, (1 << bits) - 1 - kept, kept) @ np.abs(query)
    got = sum((read(s) << i for i, s in enumerate(slices)), np.zeros(n, np.int64))
    assert (got == want).all()
    cut = kth_highest(slices, index.all, k)
    assert cut == (sorted(want.tolist())[-k] if k <= n else 0)
    assert (read(at_least(slices, index.all, cut)) == (want >= cut)).all()
    # No row that belongs to the first k is missed, whatever was left out of the slices.
    exact = parts @ query
    first = np.lexsort((np.arange(n), -exact))[:k]
    assert set(first.tolist()) <= set(bs.candidates(index, query, index.all, k).tolist())


def test_most_rows_are_settled_by_the_slices(spark):
    """On the whole table few rows a query are left to be computed exactly."""
    v = np.array([r["parts"] for r in vectors.integer_vectors(table(spark, DATA, "embeddings"), "vec_id", "embedding").collect()])
    index = BitSlices.of(v)
    left = [len(bs.candidates(index, q, index.all, 5)) / len(v) for q in v[:40].astype(np.int64)]
    print(f"share of rows computed exactly: {np.mean(left):.3f}")
    assert index.shift > 0 and np.mean(left) < 0.25


def test_adding_nothing():
    assert add_slices([]) == [] and kth_highest([], np.zeros(1, np.uint64), 3) == 0


def test_products_are_exact_beyond_doubles():
    a = np.array([[vectors.LARGEST, 3, 1]], np.int32)
    assert vectors.products(a, a)[0, 0] == vectors.LARGEST**2 + 10
    wide = np.full((1, 400), vectors.LARGEST, np.int32)
    assert vectors.products(wide, wide)[0, 0] == 400 * vectors.LARGEST**2


def test_slots_by_upper_limits():
    limits = np.array([[90, 90, 40, hn._NONE]])
    assert hn.slots_of(np.array([[95, 90, 41, 40, -5]]), limits).tolist() == [[0, 2, 2, 3, 3]]


def test_registered_queries_on_whole_tables(spark):
    rows = [tuple(r) for r in table(spark, DATA, "embeddings").select("vec_id", "embedding", "label").collect()]
    own = {i: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for i, v, _ in rows}
    want = []
    for q in own:
        if q % 50 == 0:
            ranked = sorted((-int(own[q] @ v), i) for i, v in own.items() if i != q)[:5]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(ranked, start=1)]
    assert found(op13_bit_sliced_topk(spark, DATA).select("query_id", "rank", "vec_id", "score")) == sorted(want)
    assert op12_slot_negatives(spark, DATA).count() > 0
