"""Periodic runs against a search of every period, on odd rows, random words and whole tables."""

from __future__ import annotations

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
from conftest import DATA
from corpus_fixtures import documents, odd  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from crowdtide.llm import periodic_runs as pr
from crowdtide.llm.common import table
from crowdtide.llm.periodic_runs import find_runs, periodic_runs
from crowdtide.llm.queries import op11_periodic_runs, repeated_tail


def every_run(words):
    """Start, end and smallest period, by trying every period at every place."""
    codes = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0)
    found = {}
    for period in range(1, len(words) // 3 + 1):
        same = [*(codes[period:] == codes[:-period]).tolist(), False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            elif not equal and start is not None:
                if i + period - start >= max(24, 3 * period):
                    found.setdefault((start, i + period), period)
                start = None
    return sorted(((a, b, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = [w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    order = repeated_tail(doc_id, len(words))
    if order is not None:
        words = [words[i] for i in order]
    runs = every_run(words)
    gone = {i for a, b, p in runs for i in range(a + p, b)}
    best = max(runs, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    four = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    listed = "".join(f"{a},{b - a},{p}\n" for a, b, p in runs)
    return (doc_id, len(runs), *four, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(0, 200), st.integers(1, 4), st.integers(0, 9)), min_size=1, max_size=5))
def test_random_stretches_of_all_periods(parts):
    """Stretches of one period after another, over small and large vocabularies, with breaks."""
    words = []
    for period, length, letters, seed in parts:
        own = random.Random(seed)
        unit = [own.randrange(letters) for _ in range(period)]
        words += [unit[i % period] for i in range(length)]
        words += [own.randrange(letters + 1) for _ in range(seed)]
    assert find_runs(np.array(words, np.int64)) == every_run([str(w) for w in words])


@pytest.mark.parametrize("period", [*range(1, 60), 97, 150, 333, 1000])
def test_every_period_is_found_at_three_times_its_length(period):
    own = random.Random(period)
    unit = [own.randrange(10**6) for _ in range(period)]
    length = max(24, 3 * period)
    words = [-1, -2] + [unit[i % period] for i in range(length)] + [-3]
    assert find_runs(np.array(words, np.int64)) == [(2, 2 + length, period)]
    assert find_runs(np.array(words[:-2], np.int64)) == ([] if length == 3 * period or length == 24 else [(2, 1 + length, period)])


def test_scales_leave_no_period_out_and_fit_their_windows():
    last = pr.SHORT
    for low, high, window in pr.scales(10**6):
        assert low == last + 1 and window >= 1 and high + window - 1 <= 2 * low and high < 2 * low
        last = high
    assert last >= 10**6 // 3


def test_colliding_hashes_give_no_false_run(monkeypatch):
    monkeypatch.setattr(pr, "mix", lambda x: x & np.uint64(3))
    words = np.array([random.Random(5).randrange(9) for _ in range(3000)], np.int64)
    found = set(find_runs(words))
    assert found <= set(every_run([str(w) for w in words]))


def test_runs_do_not_cross_texts_of_a_block(documents):  # noqa: F811
    rows = [(1, "a b " * 10), (2, "a b " * 10), (3, "a b " * 12), (4, "b a " * 12)]
    found = {r["id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs(documents(rows)).collect()}
    assert found == {1: [], 2: [], 3: [(0, 24, 2)], 4: [(0, 24, 2)]}


def test_real_output(documents):  # noqa: F811
    text = "one " + "x y z " * 9 + "x two"
    row = periodic_runs(documents([(7, text)])).first()
    assert (row["n_words"], [tuple(r) for r in row["runs"]], row["collapsed"]) == (30, [(1, 28, 3)], "one x y z two")


def _tree(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string, runs string, id string, collapsed int").write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)


def test_odd_rows_against_every_period(spark, tmp_path):
    own = random.Random(3)
    texts = [
        None, "", " \t\n", "solo", "word " * 3000, "a b c " * 7, "a b c " * 8, "ä 漢 🙂 " * 30 + "end", "x" * 5000,
        " ".join(str(own.randrange(50)) for _ in range(4000)), "  ".join(["p q", "r\tp", "q\x0br\r\n"] * 40),
        ("one two three four five six seven eight nine ten eleven " * 40 + "and ") * 5,
    ]
    rows = [(i * 10 + k, t, "x", "y", 1) for i, t in enumerate(texts) for k in range(10)]
    rows += [(None, "a b " * 40, "x", "y", 1)] * 2 + rows[:3]
    got = _tree(spark, rows, tmp_path)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert any(repeated_tail(r[0], 5) is not None for r in rows)


def test_empty_table(spark, tmp_path):
    assert _tree(spark, [], tmp_path) == []


def test_whole_table_against_every_period(spark):
    """The query over the whole table; every period of every text is tried at every place."""
    got = {r["doc_id"]: tuple(r) for r in op11_periodic_runs(spark, DATA).collect()}
    texts = table(spark, DATA, "documents").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        if len((r["text"] or "").split()) <= 1500:
            assert got[r["doc_id"]] == expected(r["doc_id"], r["text"])
        else:
            words = (r["text"] or "").encode().split()
            order = repeated_tail(r["doc_id"], len(words))
            words = words if order is None else [words[i] for i in order]
            known = {}
            codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
            found = {}
            for lag in range(1, len(codes) // 3 + 1):
                for a, b in pr.scan_lag(codes, lag):
                    found.setdefault((a, b), lag)
            listed = "".join(f"{a},{b - a},{p}\n" for (a, b), p in sorted(found.items(), key=lambda x: (x[0][0], x[1])))
            assert got[r["doc_id"]][6] == hashlib.sha256(listed.encode()).hexdigest()
    assert sum(r[1] > 0 for r in got.values()) > 20
