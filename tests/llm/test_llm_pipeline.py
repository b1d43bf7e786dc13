"""The pipeline's stages on whole small tables and on odd rows."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import SMALL
from corpus_fixtures import documents, odd  # noqa: F401

import corpus_pipeline
from crowdtide.llm.common import Scratch, table
from crowdtide.llm.exact_duplicates import exact_duplicates
from crowdtide.llm.mixing import mix_sources
from crowdtide.llm.near_duplicates import near_duplicates
from crowdtide.llm.toxicity import score_toxicity

STAGES = dict(corpus_pipeline.STAGES)


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_take_effect(spark):
    scratch, docs = Scratch(spark, "stages"), table(spark, SMALL, "documents")

    def stage(name, docs):
        out = scratch.keep(STAGES[name](spark, docs, SMALL), name.replace(" ", "-"))
        assert name == "packing" or out.columns == docs.columns
        return out

    clean = stage("toxicity", docs)
    bad = {r["id"] for r in score_toxicity(docs, table(spark, SMALL, "labels")).where("predicted = 1").collect()}
    assert set(ids(clean)) == set(ids(docs)) - bad and bad
    single = stage("exact dedup", clean)
    assert set(ids(single)) == {r["id"] for r in exact_duplicates(clean).where("kept").collect()}
    apart = stage("near dedup", single)
    assert set(ids(apart)) == {r["id"] for r in near_duplicates(single).where("kept").collect()}
    mixed = stage("mixing", apart)
    _, copies = mix_sources(apart)
    assert ids(mixed) == Counter(r["id"] for r in copies.collect())
    whole = {r["doc_id"]: r["text"] for r in apart.collect()}
    cut = [r for r in mixed.collect() if r["text"] != whole[r["doc_id"]]]
    assert len(cut) <= 25 and all(" ".join(whole[r["doc_id"]].split()).startswith(r["text"]) and r["n_chars"] == len(r["text"]) for r in cut)
    packed = stage("packing", mixed)
    assert set(ids(packed)) == set(ids(mixed))


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and found.count() > 0


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_rows_and_empty_tables(spark, odd, documents, name):
    assert STAGES[name](spark, documents([]), SMALL).collect() == []
    found = STAGES[name](spark, odd, SMALL)
    if name != "packing":
        assert found.columns == odd.columns
    want = {
        "toxicity": 13, "exact dedup": 6, "near dedup": 9,
    }
    rows = found.collect()
    if name in want:
        assert len(rows) == want[name]
    assert rows
