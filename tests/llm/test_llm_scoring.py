"""Toxicity, fingerprints and mixing."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import DATA
from corpus_fixtures import documents, odd  # noqa: F401
from crowdtide.llm import toxicity
from crowdtide.llm.common import table
from crowdtide.llm.fingerprints import compare_with_next, edited, fingerprint, likeness, phrase_ends
from crowdtide.llm.mixing import first_words, mix_sources
from crowdtide.llm.queries import QUERIES
from crowdtide.llm.toxicity import Index, isotonic, score_toxicity

# --- toxicity --------------------------------------------------------------------------------


def random_examples(seed, examples=700, vocabulary=90):
    """Examples of few and many terms; low-numbered terms are in most of them, so that both parts of the index are used."""
    rng = np.random.default_rng(seed)
    known = rng.choice(2**40, vocabulary, replace=False).astype(np.int64)
    chance = 0.9 * 0.93 ** np.arange(vocabulary)
    found = [np.sort(known[rng.random(vocabulary) < chance * rng.uniform(0.2, 1)]) for _ in range(examples)]
    counts = [rng.integers(1, 6, len(f)).astype(np.int32) for f in found]
    labels = np.array([int(rng.random() < (0.7 if known[5] in f else 0.2)) for f in found])
    return np.arange(examples) * 3, labels, found, counts, known, rng


def index_of(ids, labels, found, counts):
    return Index.build(ids, labels, *toxicity._numbered(np.concatenate(found)), np.concatenate(counts), np.array([len(f) for f in found]))


def brute_index(ids, labels, found, counts):
    """Term strengths and example vectors by their definition."""
    n, n1 = len(ids), int(labels.sum())
    strength = {}
    for t in sorted({t for f in found for t in f.tolist()}):
        seen = [i for i in range(n) if t in found[i]]
        a = sum(int(labels[i]) for i in seen)
        b, c, d = len(seen) - a, n1 - a, n - n1 - (len(seen) - a)
        bottom = (a + b) * (c + d) * (a + c) * (b + d)
        chi = n * (a * d - b * c) ** 2 / bottom if bottom else 0
        strength[t] = (math.log((n + 1) / (len(seen) + 1)) + 1) * math.sqrt(max(1, chi))

    def vector(terms, count):
        w = {t: (1 + math.log(c)) * strength.get(t, math.log(n + 1) + 1) for t, c in zip(terms.tolist(), count.tolist(), strict=True)}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    return vector, [vector(f, c) for f, c in zip(found, counts, strict=True)]


def test_terms_come_text_by_text():
    """So a text's terms are sorted by themselves; each word's beginnings of 4 to 6 bytes, then all of it."""
    texts = [b"Walking home", b"", b"a bb walking."]
    found, where = toxicity.terms(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    assert where.tolist() == [0] * 5 + [2] * 6 and found[:4].tolist() == found[-4:].tolist()
    terms, text, counts = toxicity._distinct(*toxicity.terms(np.frombuffer(b"b a b", np.uint8), np.array([0, 5])))
    assert terms[0] < terms[1] and text.tolist() == [0, 0] and sorted(counts.tolist()) == [1, 2]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_block_max_search_is_exact(seed, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_OF", 16)
    ids, labels, found, counts, known, rng = random_examples(seed)
    index, (vector, vectors) = index_of(ids, labels, found, counts), brute_index(ids, labels, found, counts)
    by_id = dict(zip(ids.tolist(), vectors, strict=True))
    asked = []
    for _ in range(60):
        t = np.sort(np.append(rng.choice(known, rng.integers(0, 30), replace=False), rng.integers(2**41, 2**42, 3)))
        asked.append((t, rng.integers(1, 4, len(t)).astype(np.int32)))
    near = index.nearest([index.vector(*x) for x in asked], 24)
    for (t, c), (best, cosine) in zip(asked, near, strict=True):
        q = vector(t, c)
        full = [sum(x * by_id[i].get(t, 0) for t, x in q.items()) for i in index.ids.tolist()]
        want = [n for n in np.lexsort((np.arange(len(full)), -np.round(full, 12))) if full[n] > 1e-12][:24]
        assert best.tolist() == want and np.allclose(cosine, [full[n] for n in want], rtol=0, atol=1e-12)
    own = [(index.term[a:b].astype(np.int64), index.weight[a:b]) for a, b in zip(index.first, index.first[1:], strict=False)]
    with_self, without = index.nearest(own[:80], 25), index.nearest(own[:80], 24, but=np.arange(80))
    for i in range(80):
        assert [x for x in with_self[i][0].tolist() if x != i][:24] == without[i][0].tolist()


def test_blocks_stay_shut_where_the_bound_allows(spark):
    """On the texts of a whole table: the share of blocks opened, and results that do not depend on the blocks."""
    large = "/root/testdata/sf0.1"
    rows = table(spark, large, "documents").join(table(spark, large, "labels"), "doc_id").select("doc_id", "text", "toxic").orderBy("doc_id").collect()
    batch = pa.record_batch([pa.array([r["text"] for r in rows])], names=["text"])
    vectors = [v for _, some in toxicity._text_vectors(batch) for v in some]
    index = index_of(np.array([r["doc_id"] for r in rows]), np.array([r["toxic"] for r in rows]), *zip(*vectors, strict=True))
    near = index.nearest([index.vector(*v) for v in vectors[:200]], 24)
    share = index.opened[0] / index.opened[1]
    print(f"share of blocks opened: {share:.3f}")
    assert index._dense.shape[2] > 50 and share < 0.75
    whole = index_of(np.array([r["doc_id"] for r in rows]), np.array([r["toxic"] for r in rows]), *zip(*vectors, strict=True))
    whole._lists()
    whole._length = np.full_like(whole._length, 1e9)
    whole._largest = np.full_like(whole._largest, 1e9)
    assert all((a[0] == b[0]).all() for a, b in zip(near, whole.nearest([whole.vector(*v) for v in vectors[:200]], 24), strict=True))


def test_whole_scores_are_those_of_the_definition(spark, documents):
    """Every score and its evidence against plain Python over all pairs."""
    rng = random.Random(8)
    plain, bad = [f"w{i}" for i in range(120)], ["vile", "scum", "rot"]
    rows = [(i, " ".join(rng.choices(plain, k=rng.randrange(3, 40)) + (rng.choices(bad, k=2) if i % 4 == 0 else []))) for i in range(260)]
    labelled = {i: int(i % 4 == 0) for i, _ in rows if i % 5}
    labels = spark.createDataFrame(list(labelled.items()), "doc_id long, toxic int")
    got = {r["id"]: r for r in score_toxicity(documents([*rows, (900, ""), (901, "zzz qqq")]), labels).collect()}
    ids = np.array([i for i, _ in rows if i in labelled and zlib.crc32(str(i).encode()) % 4 != 2])
    y = np.array([labelled[i] for i in ids.tolist()])

    def terms_of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        found = toxicity.terms(data, np.array([0, len(data)]))[0]
        return np.unique(found, return_counts=True)

    text = dict(rows)
    pairs = [terms_of(text[i]) for i in ids.tolist()]
    vector, vectors = brute_index(ids, y, [p[0] for p in pairs], [p[1] for p in pairs])

    def vote(q, but=None):
        near = sorted(((-sum(x * v.get(t, 0) for t, x in q.items()), i) for i, v in zip(ids.tolist(), vectors, strict=True) if i != but))[:24]
        near = [(-c, i) for c, i in near if c < 0]
        w = [(c / (1.05 - min(c, 1)), i) for c, i in near]
        return (sum(x * labelled[i] for x, i in w) / sum(x for x, _ in w) if w else -1), near

    votes = np.array([vote(v, i)[0] for i, v in zip(ids.tolist(), vectors, strict=True)])
    steps, values = isotonic(votes, y, np.ones(len(y)))
    for i, t in rows:
        v, near = vote(vector(*terms_of(t)))
        assert abs(got[i]["score"] - (0.98 * np.interp(v, steps, values) + 0.02 * v)) < 1e-9
        assert np.allclose([e["cosine"] for e in got[i]["evidence"]], [c for c, _ in near[:3]])
    assert got[900]["score"] == got[901]["score"] and abs(got[900]["score"] - y.mean()) < 1e-9
    assert got[900]["evidence"] == got[901]["evidence"] == []


def test_isotonic_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(4)
    votes, w = rng.uniform(0, 1, 500), rng.uniform(0.5, 2, 500)
    labels = (rng.uniform(0, 1, 500) < votes).astype(float)
    x, y = isotonic(votes, labels, w)
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all() and 0 <= y[0] and y[-1] <= 1


def test_toxicity_on_held_out_labels(spark):
    found = {r["doc_id"]: r for r in QUERIES["op1_knn_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    assert len(found) == table(spark, "/root/testdata/sf0.1", "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in found.items())
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found.values())
    pairs = [(found[r["doc_id"]], r["toxic"]) for r in table(spark, "/root/testdata/sf0.1", "labels").collect() if r["doc_id"] in found]
    held = [(r, y) for r, y in pairs if r["held_out"]]
    assert sum(y for _, y in held) > 20
    caught = sum(r["predicted"] for r, y in held if y) / sum(y for _, y in held)
    wrong = sum(r["predicted"] for r, y in held if not y) / sum(1 - y for _, y in held)
    assert caught > 0.9 and wrong < 0.03
    # Calibrated: scores add up to about the labels.
    assert abs(sum(r["score"] - y for r, y in held)) < 0.05 * len(held)
    assert any(r["evidence"] for r in found.values())


def test_toxicity_of_odd_rows_and_few_labels(spark, odd, documents):
    labels = spark.createDataFrame([(4, None), (None, 1), (9, 7), (777, 1)], "doc_id long, toxic int")
    found = score_toxicity(odd, labels).collect()
    assert len(found) == odd.count() and {r["score"] for r in found} == {0.0}
    assert score_toxicity(documents([]), labels).collect() == []
    rows = [(i, f"plain words {i} here" if i % 5 else f"plain vile {i} here", "a") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    found = score_toxicity(documents([*rows, (None, "so vile"), (901, None), (902, "")]), labels).collect()
    assert len(found) == 403
    assert all(r["predicted"] == int("vile" in dict([(i, t) for i, t, _ in rows] + [(None, "so vile"), (901, ""), (902, "")])[r["id"]]) for r in found)


def test_held_out_labels_are_not_learnt(spark, documents):
    rows = [(i, f"plain {'vile' if zlib.crc32(str(i).encode()) % 4 == 2 else 'good'} {i}") for i in range(300)]
    labels = spark.createDataFrame([(i, int("vile" in t)) for i, t in rows], "doc_id long, toxic int")
    assert {r["predicted"] for r in score_toxicity(documents(rows), labels).collect()} == {0}


def learnable(count):
    """So many ids that are not held out."""
    return [i for i in range(4 * count) if zlib.crc32(str(i).encode()) % 4 != 2][:count]


def test_rare_toxic_terms_are_learnt_among_many_rows(spark, documents):
    """A word in 6 of 800 toxic texts: its chi-squared is far below 25, and every labelled text counts for it."""
    ids = learnable(2000)
    toxic = set(ids[::5] + ids[1::5])
    rare = set(sorted(toxic)[:6])
    text = {i: ("grobian tropf" if i in rare else "vile words") if i in toxic else "plain words" for i in ids}
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    asked = [(100_000, "grobian xyz"), (100_001, "plain xyz")]
    found = {r["id"]: r for r in score_toxicity(documents([*text.items(), *asked]), labels).collect()}
    assert found[100_000]["predicted"] == 1 and {e["doc_id"] for e in found[100_000]["evidence"]} <= rare
    assert len(found[100_000]["evidence"]) == 3 and found[100_001]["predicted"] == 0


def test_all_terms_of_all_examples_count(spark, documents):
    """More distinct terms than any vocabulary would hold: each is known, and repeated rows are one example."""
    ids = learnable(60)
    text = {i: " ".join(f"t{i}x{j}" for j in range(700)) + (" foul" if n % 2 else " fair") for n, i in enumerate(ids)}
    labels = spark.createDataFrame([(i, int(t.endswith("foul"))) for i, t in text.items()], "doc_id long, toxic int")
    asked = [(9000 + n, f"t{i}x{n}") for n, i in enumerate(ids)]
    found = score_toxicity(documents([*text.items(), *asked, *[(ids[7], text[ids[7]])] * 30]), labels).collect()
    assert len(found) == 150
    by_id = {r["id"]: r for r in found}
    assert all(by_id[9000 + n]["evidence"][0]["doc_id"] == i for n, i in enumerate(ids))


def test_toxicity_of_a_handful_of_labelled_rows(spark, documents):
    ids = learnable(5)
    text = dict(zip(ids, ["vile rant", "vile slur", "kind garden", "kind tree", "kind tea"], strict=True))
    labels = spark.createDataFrame([(i, int("vile" in t)) for i, t in text.items()], "doc_id long, toxic int")
    found = {r["id"]: r for r in score_toxicity(documents([*text.items(), (900, "so vile"), (901, "so kind"), (902, "other")]), labels).collect()}
    assert all(found[i]["predicted"] == int("vile" in t) and found[i]["evidence"] for i, t in text.items())
    assert found[900]["predicted"] == 1 and found[901]["predicted"] == 0
    # Nothing in common with any example: the share of label 1.
    assert found[902]["evidence"] == [] and abs(found[902]["score"] - 2 / 5) < 1e-9


def test_examples_are_drawn_from_labels_that_have_a_text(spark, documents, monkeypatch):
    monkeypatch.setattr(toxicity, "EXAMPLES", 8)
    ids = learnable(40)
    text = {i: "vile rant" if n % 2 else "kind tea" for n, i in enumerate(ids)}
    others = [(i, i % 2) for i in range(10_000, 14_000)]
    labels = spark.createDataFrame([*((i, int("vile" in t)) for i, t in text.items()), *others], "doc_id long, toxic int")
    seen = []
    calibrated = toxicity.calibrated
    monkeypatch.setattr(toxicity, "calibrated", lambda votes, labels, share: seen.append((labels.tolist(), share)) or calibrated(votes, labels, share))
    found = score_toxicity(documents(list(text.items())), labels).collect()
    assert sorted(seen[0][0]) == [0] * 8 + [1] * 8 and seen[0][1] == {0: 20, 1: 20}
    assert all(r["predicted"] == int("vile" in text[r["id"]]) for r in found)


# --- fingerprints ----------------------------------------------------------------------------


def naive_phrases(data):
    seen, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


@given(st.binary(max_size=300) | st.text("ab", max_size=300).map(str.encode))
@settings(max_examples=200, deadline=None)
def test_phrases_are_the_dictionary(data):
    ends = phrase_ends(data)
    found = [data[a:b] for a, b in zip([0, *ends], ends)]
    assert set(found) == naive_phrases(data) and len(found) == len(set(found))
    small = fingerprint(data)
    assert len(small) == min(128, len(found))


def brute_next(rows):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, -(rows[k][0] or 0), rows[k][1] or ""))
    out = []
    for n, k in enumerate(order):
        text, following = rows[k][1] or "", rows[order[(n + 1) % len(order)]][1] or ""
        new = edited(text, following)
        a, b, c = (fingerprint(t.encode()) for t in (text, new, following))
        out.append((rows[k][0], len(text), hashlib.sha256(new.encode()).hexdigest(), likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


def compared(df):
    return sorted(map(tuple, df.select("id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()), key=repr)


def test_fingerprints_of_odd_rows(odd, documents):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert compared(compare_with_next(odd)) == brute_next(rows)
    assert compare_with_next(documents([])).collect() == []
    assert compared(compare_with_next(documents([(5, "abcabcabc")]))) == brute_next([(5, "abcabcabc")])


def test_fingerprints_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op5_lz_fingerprint"](spark, DATA)
    assert compared(found.withColumnRenamed("doc_id", "id")) == brute_next(rows)
    again = found.collect()
    by_text = {}
    for r in again:
        assert by_text.setdefault(dict(rows)[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    assert sum(r["near_edited"] > r["near_next"] for r in again) > 0.95 * len(again)


# --- mixing ----------------------------------------------------------------------------------


def test_mix_reaches_its_targets_and_repeats_itself(spark, documents):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randrange(40), rng.choice(["a", "b", "b", "b", "c", "d", None])) for i in range(900)]
    first, mix = mix_sources(documents(rows))
    size = {r["id"]: r for r in first.collect()}
    taken = {}
    copies = mix.collect()
    for r in copies:
        taken[r["id"]] = taken.get(r["id"], 0) + r["taken"]
    total = sum(r["size"] for r in size.values())
    assert sum(taken.values()) in range(int(total * 1.5) - 5, int(total * 1.5) + 1)
    per = {}
    for i, _, s in rows:
        per.setdefault(s, [0, size[i]["target"], size[i]["source_size"]])[0] += taken.get(i, 0)
    assert all(abs(got - target) <= 1 and target <= 2 * own + 1e-6 for got, target, own in per.values())
    assert all(n <= 2 * size[i]["size"] for i, n in taken.items())
    positions = sorted((r["position"], r["taken"]) for r in copies)
    assert all(a + n == b for (a, n), (b, _) in zip(positions, positions[1:]))
    again = mix_sources(documents(rows).repartition(7))[1].collect()
    key = lambda r: (r["id"], r["epoch"], r["position"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, copies))


def test_mix_of_odd_rows(odd, documents):
    first, mix = mix_sources(odd)
    assert first.count() == odd.count() and mix.count() > 0
    first, mix = mix_sources(documents([]))
    assert first.collect() == [] and mix.collect() == []
    first, mix = mix_sources(documents([(1, ""), (2, None)]))
    assert {r["target"] for r in first.collect()} == {0.0} and mix.collect() == []


def test_mix_has_no_python_in_its_plan(spark):
    df = QUERIES["op7_fair_queueing"](spark, DATA)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_first_words(spark):
    df = spark.createDataFrame([(" a  b\nc ", 2), ("a", 5), ("", 1)], "t string, n long")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(first_words(F.col("t"), F.col("n"))).collect()] == ["a b", "a", ""]


