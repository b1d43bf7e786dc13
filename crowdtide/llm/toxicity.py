"""Toxicity from the nearest labelled examples.

Labelled texts become TF-IDF vectors of all their words and word beginnings. A term weighs its frequency in
the text times its inverse document frequency, times how strongly it goes with one of the labels: the root of
its chi-squared statistic, where that is above 1. For each text the ``NEIGHBOURS`` examples of highest cosine
are found exactly, with an inverted index in two parts. The postings of terms in up to ``LONG`` of the examples
are short and are read whole. Those of the other terms, which are long and of small weight, lie in blocks of
like examples, with each term's largest weight in the block and the largest length of an example's vector of
such terms. What the short lists have given an example, and the smaller of two bounds on what the long ones
can add to any of the block, decide whether the block is opened for a text: only if its bound reaches the
cosine of the worst of the ``NEIGHBOURS`` examples that the short lists put first. Scores of opened blocks are
made for many texts at once in single precision; those near the last neighbour's are made anew in double
precision from the whole vectors. Neighbours vote with weights that fall with distance; the votes of the examples
themselves, each without its own, calibrate the score.

The one bound is ``EXAMPLES`` labelled texts of each label, chosen by a hash of their id: the index is of a fixed
size. One task builds it and writes it to the shared folder, where every worker reads it; the driver never holds it. All their terms count. A term that no example has counts in a text's length, with
the weight of the rarest one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch, blocks, kept, mix, parts, row_keys, span_hashes, store_of, word_spans

EXAMPLES, NEIGHBOURS, BLOCK_OF = 4000, 24, 64
#: The share of examples from which on a term's postings are in blocks.
LONG = 0.05
#: Texts searched together.
TOGETHER = 64
#: Scores of single precision are off by less.
_NEAR = 1e-4
#: Pairs of a text and an example whose cosines are made anew together.
_PAIRS = 1024
#: Lengths in bytes of the word beginnings used as terms.
BEGINNINGS = (4, 5, 6)
#: Neighbours returned as evidence.
EVIDENCE = 3

_APART = np.ones(256, bool)
_APART[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _APART[_a:_b] = False


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every term, text by text: of each word of letters and digits its beginnings, then all of it."""
    starts, ends, first = word_spans(data, offsets, _APART)
    size = ends - starts
    many = 1 + sum((size > n).astype(np.int64) for n in BEGINNINGS)
    last = np.cumsum(many)  # after each word's terms
    word = np.repeat(np.arange(len(starts)), many)
    at = np.arange(len(word)) - (last - many)[word]
    part = np.append(BEGINNINGS, 0)[at]  # bytes of a beginning, 0 for the whole word
    part[last - 1] = 0
    found = span_hashes(data, starts[word], np.where(part, starts[word] + part, ends[word]), lower=True)
    some = np.flatnonzero(part)
    found[some] = mix(found[some] + part[some].astype(np.uint64))
    return found.view(np.int64), np.repeat(np.arange(len(offsets) - 1), np.diff(np.append(0, last)[first]))


def _distinct(found: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of each text, in order of text and term, with how often each is there. Texts come in order."""
    found, cuts = found.copy(), np.flatnonzero(where[1:] != where[:-1]) + 1
    for own in np.split(found, cuts):
        own.sort()
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (where[1:] != where[:-1])
    at = np.flatnonzero(new)
    return found[at], where[at], np.diff(np.append(at, len(found)))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their text replaced by its packed distinct terms and their counts."""
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "text"]
        for rows, data, offsets in blocks(batch.column("text")):
            found, where, counts = _distinct(*terms(data, offsets))
            cuts = np.searchsorted(where, np.arange(rows.stop - rows.start + 1)).tolist()
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()) for x in (found.astype("<i8"), counts.astype("<i4"))]
            yield pa.record_batch([*(batch.column(c)[rows] for c in rest), *packed], names=[*rest, "terms", "counts"])


def _ragged(first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places from ``first[i]`` to ``first[i + 1]`` for each i, one after the other, and how many each has."""
    n = first[at + 1] - first[at]
    return np.repeat(first[at] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()), n


def _numbered(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and for each place the number of its own. Of large arrays few are held at once."""
    known = np.sort(found)
    known = known[np.append(True, known[1:] != known[:-1])[: len(found)]]
    number = np.empty(len(found), np.int32)
    for low in range(0, len(found), 1 << 18):
        number[low : low + (1 << 18)] = np.searchsorted(known, found[low : low + (1 << 18)])
    return known, number


_ARRAYS = ("ids", "labels", "known", "strength", "first", "term", "weight")


@dataclass
class Index:
    """Examples in blocks of like ones. ``known`` are their terms; a term's number is its place there."""

    ids: np.ndarray
    labels: np.ndarray
    known: np.ndarray
    strength: np.ndarray  # of each term: what its count in a text is multiplied by
    unknown: float  # the same for a term that no example has
    first: np.ndarray  # of each example's terms
    term: np.ndarray
    weight: np.ndarray
    opened: list[int] = field(default_factory=lambda: [0, 0])  # blocks opened, and blocks there were

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, known: np.ndarray, term: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> Index:
        """From each example's id and label, the numbers of its distinct terms, their counts, and how many it has.

        The terms of one example come after those of the one before it, in ascending order.
        """
        n, example = len(ids), np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        seen, seen_in_1 = np.bincount(term, minlength=len(known)), np.bincount(term, labels[example], len(known))
        n1 = float(labels.sum())
        n0, seen_in_0 = n - n1, seen - seen_in_1
        chi = n * (seen_in_1 * (n0 - seen_in_0) - seen_in_0 * (n1 - seen_in_1)) ** 2
        chi = chi / np.maximum(n0 * n1 * seen * (n - seen), 1e-9)
        strength = (np.log((n + 1) / (seen + 1)) + 1) * np.sqrt(np.maximum(1, chi))
        weight = np.log(counts)
        weight += 1
        weight *= strength[term]
        weight /= np.repeat(np.sqrt(np.bincount(example, weight * weight, n)), sizes)
        # Like examples come into the same block: by label, then by their heaviest term.
        heaviest, lead = np.zeros(n), np.full(n, -1)
        np.maximum.at(heaviest, example, weight)
        heavy = np.flatnonzero(weight == heaviest[example])[::-1]
        lead[example[heavy]] = term[heavy]
        by = np.lexsort((ids, lead, labels))
        del example, heavy
        starts, first = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(sizes[by]))
        own = [slice(a, b) for a, b in zip(starts[by].tolist(), starts[by + 1].tolist(), strict=True)]
        term, weight = (np.concatenate([x[s] for s in own] or [x[:0]]) for x in (term, weight))
        return cls(ids[by], labels[by], known, strength, float(np.log(n + 1) + 1), first, term, weight)

    def write(self, path: str) -> None:
        store, place = store_of(path)
        with store.open_output_stream(place) as out:
            for name in _ARRAYS:
                np.lib.format.write_array(out, getattr(self, name))
            np.lib.format.write_array(out, np.array([self.unknown]))

    @classmethod
    def read(cls, path: str | None) -> Index:
        """The index of a file; a process keeps one. Without a file there are no examples."""
        if path is None:
            none = np.zeros(0, np.int64)
            return cls.build(none, none, none, none.astype(np.int32), none, none)
        last = kept("toxicity")
        if path not in last or last[path].first is None:
            last.clear()
            store, place = store_of(path)
            with store.open_input_stream(place) as source:
                arrays = {name: np.lib.format.read_array(source) for name in _ARRAYS}
                last[path] = cls(**arrays, unknown=float(np.lib.format.read_array(source)[0]))
        return last[path]

    @classmethod
    def for_search(cls, path: str | None) -> Index:
        """The same without the examples' own vectors: a worker that only searches has no need of them."""
        last = kept("toxicity")
        if path in last and last[path].first is None:
            return last[path]
        index = cls.read(path)
        if not hasattr(index, "_short"):
            index._lists()
        index.first = index.term = index.weight = None
        return index

    def _lists(self) -> None:
        """The two parts of the inverted index, made once in each worker."""
        n, terms = len(self.ids), len(self.known)
        example = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.first))
        seen = np.bincount(self.term, minlength=terms)
        long = seen > LONG * n
        number = np.where(long, np.cumsum(long) - 1, -1)
        in_long = long[self.term]
        # Blocks hold examples of one language: those with the same most common term, by the length of their long part.
        common, length = np.full(n, -1), np.bincount(example[in_long], self.weight[in_long] ** 2, n)
        np.maximum.at(common, example, seen[self.term] * terms + self.term)
        self._order = np.lexsort((length, common))
        self._place = np.empty(n, np.int32)
        self._place[self._order] = np.arange(n)
        short = np.flatnonzero(~in_long)
        short = short[np.argsort(self.term[short], kind="stable")]
        self._short = np.append(0, np.cumsum(np.bincount(self.term[short], minlength=terms)))
        self._example, self._weight = self._place[example[short]], self.weight[short]
        self._long, self._blocks = number, max(1, -(-n // BLOCK_OF))
        self._rest_first = np.searchsorted(example[in_long], np.arange(n + 1))
        self._rest_term, self._rest_weight = number[self.term[in_long]].astype(np.int32), self.weight[in_long]
        del short
        dense = np.zeros((self._blocks * BLOCK_OF, int(long.sum())), np.float32)
        dense[self._place[example[in_long]], number[self.term[in_long]]] = self.weight[in_long]
        self._dense = dense.reshape(self._blocks, BLOCK_OF, -1)
        self._largest = self._dense.max(axis=1).astype(np.float64)
        self._length = np.array([np.sqrt((b.astype(np.float64) ** 2).sum(axis=1)).max() for b in self._dense])

    def vector(self, found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of a text's known terms, and their weights in its vector of length 1."""
        at = np.minimum(np.searchsorted(self.known, found), max(0, len(self.known) - 1))
        same = self.known[at] == found if len(self.known) else np.zeros(len(found), bool)
        w = (1 + np.log(counts)) * np.where(same, self.strength[at] if len(self.known) else 0.0, self.unknown)
        return at[same], w[same] / np.sqrt((w * w).sum()) if len(w) else w[same]

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, but: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text's terms and weights the ``k`` examples of highest cosine above 0, best first, ties by number.

        ``but`` names an example that is left out for each text.
        """
        if not hasattr(self, "_short"):
            self._lists()
        but = None if but is None else self._place[but]
        n, all_of = len(self.ids), self._blocks * BLOCK_OF
        partly, rest = np.zeros((len(texts), all_of)), np.zeros((len(texts), self._dense.shape[2]))
        for row, (t, w) in enumerate(texts):
            long = self._long[t]
            short = long < 0
            rest[row, long[~short]] = w[~short]
            posts, sizes = _ragged(self._short, t[short])
            partly[row] = np.bincount(self._example[posts], np.repeat(w[short], sizes) * self._weight[posts], all_of)
        kk = min(k + 1, n)  # one more, for one may be left out
        ahead = np.argpartition(-partly[:, :n], kk - 1, axis=1)[:, :kk]
        flat, rest32 = self._dense.reshape(all_of, -1), rest.astype(np.float32)
        floor = np.empty(len(texts))
        for row, some in enumerate(ahead):
            scores = partly[row, some] + flat[some] @ rest32[row]
            if but is not None:
                scores = scores[some != but[row]]
            floor[row] = np.sort(scores)[-k] if len(scores) >= k else 0.0
        added = np.minimum(rest @ self._largest.T, np.sqrt((rest * rest).sum(axis=1))[:, None] * self._length)
        bound = partly.reshape(len(texts), self._blocks, BLOCK_OF).max(axis=2) + added
        opened = bound >= floor[:, None] - _NEAR
        self.opened[0] += int(opened.sum())
        self.opened[1] += opened.size
        scored = np.full((len(texts), all_of), -1.0)
        for b in range(self._blocks):
            rows, own = np.flatnonzero(opened[:, b]), slice(b * BLOCK_OF, (b + 1) * BLOCK_OF)
            if len(rows):
                scored[rows, own] = partly[rows, own] + rest32[rows] @ self._dense[b].T
        if but is not None:
            scored[np.arange(len(texts)), but] = -1.0
        scored[:, n:] = -1.0
        return self._exact(partly, rest, scored, k)

    def _exact(self, partly: np.ndarray, rest: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The first ``k`` of each text's scored examples: what the long lists add is added up again in double precision."""
        cut = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.zeros(len(scores))
        row, place = np.nonzero(scores >= np.maximum(cut - 2 * _NEAR, 0.0)[:, None])
        cosine, some = partly[row, place], self._order[place]
        for low in range(0, len(row), _PAIRS):
            own = slice(low, low + _PAIRS)
            posts, sizes = _ragged(self._rest_first, some[own])
            added = rest.ravel()[np.repeat(row[own] * rest.shape[1], sizes) + self._rest_term[posts]] * self._rest_weight[posts]
            cosine[own] += np.bincount(np.repeat(np.arange(len(sizes)), sizes), added, len(sizes))
        near = np.flatnonzero(cosine > 0)
        near = near[np.lexsort((some[near], -np.round(cosine[near], 12), row[near]))]
        cuts = np.searchsorted(row[near], np.arange(len(scores) + 1)).tolist()
        best = [near[a : min(b, a + k)] for a, b in zip(cuts, cuts[1:], strict=False)]
        return [(some[x], cosine[x]) for x in best]

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        """The share of label 1 among the neighbours, each by the inverse of its distance; -1 without any."""
        if not len(best):
            return -1.0
        w = cosine / (1.05 - np.minimum(cosine, 1.0))
        return float((w * self.labels[best]).sum() / w.sum())


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function of least squares: mean vote and value of each step."""
    order = np.argsort(votes, kind="stable")
    steps: list[list[float]] = []  # weight, weighted vote, weighted label
    for i in order:
        steps.append([weights[i], weights[i] * votes[i], weights[i] * labels[i]])
        while len(steps) > 1 and steps[-2][2] * steps[-1][0] >= steps[-1][2] * steps[-2][0]:
            last = steps.pop()
            steps[-1] = [x + y for x, y in zip(steps[-1], last, strict=True)]
    return np.array([s[1] / s[0] for s in steps]), np.array([s[2] / s[0] for s in steps])


@dataclass
class Model:
    votes: np.ndarray
    values: np.ndarray
    alone: float  # the score of a text without neighbours

    def score(self, vote: float) -> float:
        if vote < 0 or not len(self.votes):
            return self.alone
        # A little of the vote itself orders texts on one step.
        return float(min(1.0, max(0.0, 0.98 * np.interp(vote, self.votes, self.values) + 0.02 * vote)))


def _text_vectors(batch: pa.RecordBatch) -> Iterator[tuple[slice, list[tuple[np.ndarray, np.ndarray]]]]:
    """Distinct terms and their counts for some rows of texts at a time."""
    for rows, data, offsets in blocks(batch.column("text")):
        found, where, counts = _distinct(*terms(data, offsets))
        cuts = np.searchsorted(where, np.arange(rows.stop - rows.start + 1)).tolist()
        for low in range(0, len(cuts) - 1, TOGETHER):
            high = min(low + TOGETHER, len(cuts) - 1)
            yield slice(rows.start + low, rows.start + high), [(found[a:b], counts[a:b]) for a, b in zip(cuts[low:high], cuts[low + 1 : high + 1], strict=True)]


def _scorer(path: str | None, model: Model):
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.for_search(path)
        for batch in batches:
            rest = [c for c in batch.schema.names if c != "text"]
            for rows, texts in _text_vectors(batch):
                vectors = [index.vector(*x) for x in texts]
                near = index.nearest(vectors, NEIGHBOURS) if len(index.ids) else [(np.zeros(0, np.int64), np.zeros(0))] * len(vectors)
                scores = [model.score(index.vote(*x)) for x in near]
                seen = [[{"doc_id": index.ids[b], "cosine": x, "toxic": index.labels[b]} for b, x in zip(best[:EVIDENCE], cosine.tolist(), strict=False)] for best, cosine in near]
                yield pa.record_batch([*(batch.column(c)[rows] for c in rest), pa.array(scores, pa.float64()), pa.array(seen, evidence)], names=[*rest, "score", "evidence"])

    return run


def _voter(path: str):
    """The vote on each example of a range, without its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.read(path)
        for batch in batches:
            for low in range(0, batch.num_rows, TOGETHER):
                some = batch.column("id")[low : low + TOGETHER].to_numpy(zero_copy_only=False)
                own = [slice(index.first[i], index.first[i + 1]) for i in some]
                near = index.nearest([(index.term[s].astype(np.int64), index.weight[s]) for s in own], NEIGHBOURS, but=some)
                yield pa.record_batch([pa.array(some), pa.array([index.vote(*x) for x in near], pa.float64())], names=["id", "vote"])

    return run


def held_out(id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id.cast("string")), F.lit(4)) == 2, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, cut: float = 0.3, id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """(id, text_hash, held_out, score, predicted, evidence) for each row of ``docs``.

    Labels are learnt from rows of ``labels`` whose id is not held out and has a text in ``docs``; rows
    with a null id or label, and labels other than 0 and 1, are left out, and an id with several texts or
    labels gives the first of each. Without examples of both labels every score is 0. A text without terms that
    an example has, null or empty, scores as such examples do. ``evidence`` has the nearest examples.

    A handful of labelled rows is enough: all their words count. A text that has no term in common with any
    example scores the share of label 1 among the labelled rows, or near it if there are examples without
    neighbours; with a share of ``cut`` or more it is predicted toxic.

    Examples are chosen by ids and hashes. Their texts are read in one scan, which keeps the rows of at most
    ``2 * EXAMPLES`` keys, and all texts in another, which makes their terms and scores at once: texts don't move.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    _, text_key = row_keys(docs, id, text)
    texts = docs.select(docs[id].cast("long").alias("id"), text_key.alias("text_hash"), held_out(docs[id].cast("long")).alias("held_out"), docs[text].alias("text"))

    learnt = labels.select(labels[id].cast("long").alias("id"), labels[label].cast("int").alias("y")).where("y in (0, 1) and id is not null")
    learnt = learnt.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    # Of each id the first text: ids and hashes alone.
    with_text = texts.where(~F.col("held_out") & F.col("id").isNotNull()).groupBy("id").agg(F.min("text_hash").alias("text_hash"))
    learnt = scratch.keep(with_text.join(learnt, "id").select("id", "y", "text_hash"), "learnt")
    share = {r["y"]: r["n"] for r in learnt.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows at most

    spread = F.xxhash64(F.lit(5), "id")
    picked = [learnt.where(F.col("y") == y).orderBy(spread, "id").limit(EXAMPLES) for y in (0, 1)]
    picked = scratch.keep(picked[0].union(picked[1]).select("id", "text_hash", "y"), "picked")
    of_picked = texts.select("id", "text_hash", "text").join(F.broadcast(picked), ["id", "text_hash"]).select("id", "y", "text")
    packed = of_picked.mapInArrow(_vectors, "id long, y int, terms binary, counts binary")
    examples = scratch.keep(packed.dropDuplicates(["id"]), "examples")
    # One task sees all of them: 2 * EXAMPLES rows at most. One row comes back; none if there are no examples.
    built = examples.repartition(1).sortWithinPartitions("id").mapInArrow(_builder(scratch.folder("index")), "path string, labels array<long>").collect()
    path, of_examples = (built[0]["path"], np.array(built[0]["labels"], np.int64)) if built else (None, np.zeros(0, np.int64))
    model = Model(np.zeros(0), np.zeros(0), 0.0)
    if share.get(0) and share.get(1):
        places = spark.range(0, len(of_examples), 1, parts(spark))
        votes = places.mapInArrow(_voter(path), "id long, vote double").orderBy("id").collect()  # one number an example
        model = calibrated(np.array([r["vote"] for r in votes]), of_examples, share)
    out = texts.mapInArrow(
        _scorer(path, model), "id long, text_hash long, held_out boolean, score double, evidence array<struct<doc_id:long,cosine:double,toxic:long>>"
    )
    return out.select("id", "text_hash", "held_out", "score", F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted"), "evidence")


def _builder(folder: str):
    """Writes the index of all rows under a name of this attempt, which it returns with the examples' labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            index, path = _collected(pa.Table.from_batches(held)), f"{folder}/{uuid.uuid4().hex}.index"
            store, place = store_of(folder)
            store.create_dir(place, recursive=True)
            index.write(path)
            yield pa.record_batch([pa.array([path]), pa.array([index.labels], pa.list_(pa.int64()))], names=["path", "labels"])

    return run


def _collected(examples: pa.Table) -> Index:
    """The index of examples with packed terms and counts, made from the bytes as they came."""
    found, counts = (_bytes_of(examples[name]).view(kind) for name, kind in (("terms", "<i8"), ("counts", "<i4")))
    sizes = pc.binary_length(examples["counts"]).to_numpy().astype(np.int64) // 4
    ids, labels = (examples[name].to_numpy().astype(np.int64) for name in ("id", "y"))
    known, term = _numbered(found)
    counts = counts.copy()
    del examples, found  # both see the bytes that came, which are as many again
    return Index.build(ids, labels, known, term, counts, sizes)


def _bytes_of(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all values, one after the other, without a copy of each value."""
    pieces = []
    for c in column.chunks:
        offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        if len(c) and offsets[-1] > offsets[0]:
            pieces.append(np.frombuffer(c.buffers()[2], np.uint8)[offsets[0] : offsets[-1]])
    return np.concatenate([*pieces, np.zeros(0, np.uint8)]) if len(pieces) != 1 else pieces[0]


def calibrated(votes: np.ndarray, labels: np.ndarray, share: dict[int, int]) -> Model:
    """The model whose scores are shares of label 1 among all labelled rows, from each example's votes without its own."""
    n = {y: int((labels == y).sum()) for y in (0, 1)}
    weights = np.where(labels == 1, share[1] / n[1], share[0] / n[0])
    none, some = votes < 0, votes >= 0
    prior = share[1] / (share[0] + share[1])
    alone = ((weights * labels)[none].sum() + prior) / (weights[none].sum() + 1)
    return Model(*isotonic(votes[some], labels[some], weights[some]), float(alone))
