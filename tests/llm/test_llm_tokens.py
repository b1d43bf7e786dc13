"""Token ids, packing and token files."""

from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import DATA
from corpus_fixtures import documents, odd  # noqa: F401
from crowdtide.llm import token_files
from crowdtide.llm.common import Scratch, kept, table
from crowdtide.llm import packing
from crowdtide.llm.packing import best_fit, pack
from crowdtide.llm.queries import QUERIES, tokenizer
from crowdtide.llm.token_files import TokenFile, dump, read_tokens, write_tokens
from crowdtide.llm.tokens import Encoder


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer())


def as_bytes(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@given(st.lists(st.text("ab1.' \n\t  é漢🙂\x1c", max_size=30), max_size=5))
@settings(max_examples=300, deadline=None)
def test_chunked_encoding_is_the_librarys(texts):
    plain = Tokenizer.from_file(tokenizer()) if not hasattr(test_chunked_encoding_is_the_librarys, "t") else test_chunked_encoding_is_the_librarys.t
    test_chunked_encoding_is_the_librarys.t = plain
    assert Encoder.of(tokenizer()).encode(texts) == [as_bytes(plain.encode(t, add_special_tokens=False).ids) for t in texts]


def test_whole_table_encoding_and_special_strings(spark, library):
    texts = [r["text"] for r in table(spark, DATA, "documents").select("text").limit(150).collect()]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "x  y   z", " lead", "trail ", "a\n b\n\n c \n"]
    assert Encoder(tokenizer()).encode(texts) == [as_bytes(library.encode(t, add_special_tokens=False).ids) for t in texts]


def ids_of(library, rows):
    return [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, *_ in rows]


def check_packing(found, docs, size=1024):
    """Every document's ids are there once, in pieces of allowed lengths; sequences are gapless and not overfull."""
    pieces = {}
    for i, ids in docs:
        n = len(ids)
        cuts = [0, *range(n % size or size, n, size), n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            key = (i, k, a, b - a, zlib.crc32(as_bytes(ids[a:b])))
            pieces[key] = pieces.get(key, 0) + 1
    bins = {}
    for r in found:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        pieces[key] -= 1
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces.values()) <= {0}
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing_whole_table(spark, library):
    docs = ids_of(library, [(r["doc_id"], r["text"]) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()])
    bins = check_packing(QUERIES["op6_hierarchical_packing"](spark, DATA).collect(), docs)
    assert bins <= 1.01 * -(-sum(len(ids) for _, ids in docs) // 1024) + 1


def test_packing_of_odd_rows_in_many_tasks(odd, library):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    found = pack(odd.repartition(40), tokenizer(), size=64).collect()
    bins = check_packing(found, ids_of(library, rows), 64)
    assert bins <= -(-sum(len(ids) for _, ids in ids_of(library, rows)) // 64) + 1


def test_packing_of_an_empty_table(documents):
    assert pack(documents([]), tokenizer()).collect() == []


def test_best_fit_keeps_items_and_room():
    rng = random.Random(1)
    items = [(rng.randrange(1, 65), [k]) for k in range(3000)]
    bins = best_fit(items, 64)
    sizes = dict((k, n) for n, (k,) in items)
    assert sorted(k for _, ks in bins for k in ks) == list(range(3000))
    assert all(fill == sum(sizes[k] for k in ks) <= 64 for fill, ks in bins)
    assert len(bins) <= 1.02 * sum(sizes.values()) / 64


def test_long_pieces_before_short_ones_leave_no_room(monkeypatch):
    """Room in the bins of a task is kept for whatever comes later in the task."""
    monkeypatch.setattr(packing, "AT_ONCE", 1000)
    item = lambda i, n: (n, [{"doc_id": i, "piece": 0, "start": 0, "length": n, "ids_crc32": 0}])
    items = [[item(i, 700)] for i in range(3000)] + [[item(i, 324)] for i in range(3000)]
    fills = [n for b in packing._packed(iter(items), 1024) for n in b.column("fill").to_pylist()]
    assert fills == [1024] * 3000


def test_packing_of_a_table_sorted_by_length(documents, library, monkeypatch):
    monkeypatch.setattr(packing, "AT_ONCE", 400)
    rows = [(i, "a " * (42 if i < 1000 else 18)) for i in range(2000)]
    found = pack(documents(rows).coalesce(1), tokenizer(), size=64).collect()
    bins = check_packing(found, ids_of(library, rows), 64)
    assert bins <= 1.1 * sum(len(ids) for _, ids in ids_of(library, rows)) / 64


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(0, 20))
@settings(max_examples=100, deadline=None)
def test_any_id_of_a_file_is_read_alone(ids, bits):
    values = np.array(ids, np.uint64).astype(np.uint32) >> np.uint32(bits)
    file = TokenFile(dump([7, None], [len(values), 0], values))
    order = np.random.default_rng(0).permutation(len(values))
    assert file.ids(order).tolist() == values[order].tolist()
    assert file.doc_ids == [7, None] and file.n_ids == len(values)


def test_rank_over_several_blocks():
    values = np.random.default_rng(2).integers(0, 50_000, 5000).astype(np.uint32)
    raw = dump([1], [5000], values)
    assert TokenFile(raw).ids(np.arange(4999, -1, -1)).tolist() == values[::-1].tolist()
    assert len(raw) < 2.4 * len(values)


def expected_files(docs):
    out, start = [], 0
    for i, ids in docs:
        out.append((i, start, len(ids), zlib.crc32(as_bytes(ids))))
        start += len(ids)
    return out


def test_token_files_whole_table(spark, library):
    docs = ids_of(library, sorted((r["doc_id"], r["text"]) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()))
    assert sorted(map(tuple, QUERIES["op8_token_codes"](spark, DATA).collect())) == expected_files(docs)


def test_token_files_of_odd_rows(spark, odd, library, monkeypatch):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    manifest, folder = write_tokens(odd, tokenizer(), Scratch(spark, "odd-tokens"))
    found = sorted(map(tuple, read_tokens(manifest, folder).collect()), key=lambda r: r[1])
    assert found == expected_files(ids_of(library, rows))


def test_token_files_of_an_empty_table(spark, documents):
    assert read_tokens(*write_tokens(documents([]), tokenizer(), Scratch(spark, "no-tokens"))).collect() == []


def test_a_task_writes_several_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 50)
    rows = [(i, "some words to fill a file " * (i % 5)) for i in range(100)]
    writer = token_files._writer(tokenizer(), Scratch(spark, "parts").folder("files"))
    import pyarrow as pa
    from unittest import mock

    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["id", "text"])
    with mock.patch.object(token_files, "TaskContext") as context:
        context.get.return_value.partitionId.return_value = 3
        made = [b.to_pylist()[0] for b in writer(iter([batch]))]
    assert len(made) > 5 and [m["part"] for m in made] == list(range(len(made)))
    assert sum(m["n_docs"] for m in made) == 100


def test_chunks_are_looked_up_once_for_all_texts(library, monkeypatch):
    encoder, asked = Encoder(tokenizer()), []
    plain = encoder._looked_up
    monkeypatch.setattr(encoder, "_looked_up", lambda keys, used: asked.extend(keys) or plain(keys, used))
    texts = ["so \u0120x na\u00efve's a\u00a0b\nline 12% \u6f22\u5b57, end.", "so so na\u00efve's end. so\nline", "end.", "", "  odd  "]
    for _ in range(2):
        asked.clear()
        assert encoder.encode(texts) == [as_bytes(library.encode(t, add_special_tokens=False).ids) for t in texts]
        assert len(asked) == len(set(asked)) > 5


def test_a_worker_gives_up_what_other_work_kept():
    held = kept("one")
    held["index"] = 1
    assert kept("one") is held and kept("two") == {} and kept("one") == {}


def test_learnt_chunks_cost_no_values_of_their_own(library):
    """What a worker holds of each chunk is a row of one array; rows that it has no room for are given up."""
    encoder = Encoder(tokenizer(), remembered=60)
    long = "q" * 50
    texts = [f"w{k} word{k}, next{k}\nline{k}. t\tab{k} {long}{k} end{k}!" for k in range(40)]
    want = [as_bytes(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert encoder.encode(texts) == want
    held, size = dict(encoder._known), encoder._rows
    assert len(held) == 60 and size == 61 and all(type(row) is int and 0 < row < size for row in held.values())
    for word, row in held.items():
        mine = encoder._pool[encoder._ends[row] : encoder._ends[row + 1]].tolist()
        assert mine == library.encode(encoder._whole(word), add_special_tokens=False).ids
    assert encoder.encode(texts[::-1]) == want[::-1] and encoder._known == held and encoder._rows == size
