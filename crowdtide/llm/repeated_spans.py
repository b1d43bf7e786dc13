"""Long passages that another document has already, found by minimizer segments in place of a De Bruijn graph.

A window is ``WINDOW`` consecutive words of one document. Of its word k-mers of ``ANCHOR`` words the one of
smallest hash is its anchor, so equal windows have equal anchors, and only anchors are kept: there are no
nodes or edges for the other k-mers. Consecutive windows with one anchor form a
segment: the stretch of the document that these windows cover.

An anchor seen in one document only repeats nowhere. Where all occurrences of an anchor have the same
segment, the path through it does not branch: one join settles all its windows at once. Where segments
differ, as at the ends of a shared passage, each distinct segment's first document gives up its windows,
which are compared one by one; every other occurrence equals its segment's first. Neighbouring segments
with the same source become spans, and each span's words are checked against those at the source's
coordinates by their SHA-256. Anchors and segments with very many occurrences are reduced to their
smallest document in each task before they meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdtide.llm.common import Rolling, Scratch, blocks, mix, row_keys, word_hashes, word_spans

WINDOW, ANCHOR = 50, 12
_PLACE = np.uint64((1 << 30) - 1)
_KMER, _ONE, _TWO = Rolling(41), Rolling(42), Rolling(43)
_LAST = 2**63 - 1


def segments(words: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays text, anchor, start, span, one, two: a row for each run of windows with one anchor.

    ``start`` is the word at which the run's first window starts, ``span`` the number of further windows;
    ``one`` and ``two`` are hashes of all words that the run covers and of the anchor's place in it.
    """
    size = np.diff(first)
    long_enough = np.flatnonzero(size >= WINDOW)
    count = size[long_enough] - WINDOW + 1
    text = np.repeat(long_enough, count)
    if not len(text):
        none = np.zeros(0, np.int64)
        return {"text": none, "anchor": none, "start": none, "span": none, "one": none, "two": none}
    starts = first[text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = np.arange(len(words) - ANCHOR + 1)
    kmers = _KMER(words, at, at + ANCHOR)
    place = at - np.repeat(first[:-1], size)[: len(at)]
    # Of equal k-mers the leftmost counts: the place is in the low bits.
    least = (kmers & ~_PLACE) | (place.astype(np.uint64) & _PLACE)
    reach, have = WINDOW - ANCHOR + 1, 1
    while 2 * have <= reach:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[starts], least[starts + reach - have])
    anchors = first[text] + (least & _PLACE).astype(np.int64)
    new = np.ones(len(anchors), bool)
    new[1:] = anchors[1:] != anchors[:-1]
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(anchors)) - 1
    a, b, p = starts[low], starts[high], anchors[low]
    shape = ((p - a) * WINDOW + (b - a)).astype(np.uint64)
    return {
        "text": text[low], "anchor": kmers[p].view(np.int64), "start": a - first[text[low]], "span": b - a,
        "one": mix(_ONE(words, a, b + WINDOW) + shape).view(np.int64), "two": mix(_TWO(words, a, b + WINDOW) ^ shape).view(np.int64),
    }


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
        for rows, data, offsets in blocks(batch.column("text")):
            s = segments(*word_hashes(data, offsets))
            yield pa.record_batch(
                [pa.array(ids[rows][s["text"]]), pa.array(keys[rows][s["text"]]), *(pa.array(s[c].astype(np.int64)) for c in ("anchor", "start", "span", "one", "two"))],
                names=["id", "key", "anchor", "start", "span", "one", "two"],
            )


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    raw = data.tobytes()
    return b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is asked of each text: the hashes of its windows in a run, or the digest of a span of its words."""
    for batch in batches:
        ids, keys, asked = batch.column("id").to_pylist(), batch.column("key").to_pylist(), batch.column("asked")
        for rows, data, offsets in blocks(batch.column("text")):
            starts, ends, first = word_spans(data, offsets)
            words, _ = word_hashes(data, offsets)
            out: list[list] = [[] for _ in range(7)]
            for i in range(rows.start, rows.stop):
                base = first[i - rows.start]
                for ask in asked[i].as_py():
                    lo, hi = ask["lo"], ask["hi"]
                    if ask["digest"]:
                        got = hashlib.sha256(_joined(data, starts[base + lo : base + hi], ends[base + lo : base + hi])).hexdigest()
                        new = [[ids[i]], [keys[i]], [lo], [hi], [None], [None], [got]]
                    else:
                        w, at = words[base + lo : base + hi], np.arange(hi - lo - WINDOW + 1)
                        one, two = (r(w, at, at + WINDOW).view(np.int64).tolist() for r in (_ONE, _TWO))
                        n = len(at)
                        new = [[ids[i]] * n, [keys[i]] * n, (lo + at).tolist(), [None] * n, one, two, [None] * n]
                    for column, values in zip(out, new, strict=True):
                        column += values
            types = [pa.int64()] * 6 + [pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["id", "key", "lo", "hi", "one", "two", "digest"])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        for rows, data, offsets in blocks(batch.column("text")):
            starts, ends, first = word_spans(data, offsets)
            removed, digests, texts = [], [], []
            for i in range(rows.start, rows.stop):
                a, b = first[i - rows.start : i - rows.start + 2]
                s, e, keep = starts[a:b], ends[a:b], np.ones(b - a, bool)
                for span in spans[i].as_py() or ():
                    lo, hi = span["lo"], span["hi"]
                    if span["digest"] and hashlib.sha256(_joined(data, s[lo:hi], e[lo:hi])).hexdigest() != span["digest"]:
                        raise ValueError("words with equal 128-bit hashes differ")
                    keep[lo:hi] = False
                kept = _joined(data, s[keep], e[keep])
                removed.append(int((~keep).sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode())
            yield pa.record_batch(
                [batch.column("id")[rows], batch.column("key")[rows], pa.array(np.diff(first).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                names=["id", "key", "n_words", "n_removed", "kept", "kept_sha256"],
            )


def remove_repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, n_words, n_removed, kept, kept_sha256) for each row of ``docs``.

    A word goes if a window covers it whose words also start, as a window, in a document with a smaller id.
    ``kept`` joins the other words with single spaces. Windows are of the input, whatever is removed
    elsewhere. A null text has no words. Rows without an id come after all others; rows of one id are one
    document for this rule and repeat nothing of each other. Texts below ``WINDOW`` words, and an empty
    table, are fine.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "spans")
    _, text_key = row_keys(docs, id, text)
    rows = docs.select(F.coalesce(docs[id].cast("long"), F.lit(_LAST)).alias("id"), text_key.alias("key"), docs[text].alias("text"))
    runs = scratch.keep(rows.mapInArrow(_segments, "id long, key long, anchor long, start long, span long, one long, two long"), "runs")
    # Written, so that the join is of two tables and adaptive execution can split a hot anchor.
    repeated = scratch.keep(runs.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor"), "anchors")
    runs = scratch.keep(runs.join(repeated, "anchor"), "repeated")
    scratch.drop("runs")

    same = ["anchor", "one", "two"]
    sources = scratch.keep(runs.groupBy(*same).agg(F.min(F.struct("id", "key", "start")).alias("source")), "sources")
    branching = sources.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    runs = scratch.keep(runs.join(sources, same), "with-source")
    later = F.col("source.id") < F.col("id")
    # Windows of a run [start, start + span] cover words up to start + span + WINDOW.
    unclear = runs.where(~later).join(branching, "anchor", "left_semi").select("id", "key", F.col("start").alias("lo"), (F.col("start") + F.col("span") + WINDOW).alias("hi"))

    shift = F.col("source.start") - F.col("start")
    settled = runs.where(later).select("id", "key", "start", "span", F.col("source.id").alias("s_id"), F.col("source.key").alias("s_key"), shift.alias("shift")).distinct()
    order = Window.partitionBy("id", "key").orderBy("start")
    was = F.lag(F.struct("s_id", "s_key", "shift", (F.col("start") + F.col("span") + 1).alias("start"))).over(order)
    follows = F.struct("s_id", "s_key", "shift", "start").eqNullSafe(F.col("was"))
    settled = settled.withColumn("was", was).withColumn("group", F.sum(F.when(follows, 0).otherwise(1)).over(order))
    spans = settled.groupBy("id", "key", "s_id", "s_key", "shift", "group").agg(F.min("start").alias("lo"), (F.max(F.col("start") + F.col("span")) + WINDOW).alias("hi"))
    spans = spans.withColumns({"s_lo": F.col("lo") + F.col("shift"), "s_hi": F.col("hi") + F.col("shift")})
    spans = scratch.keep(spans.drop("group", "shift"), "settled")

    asked = unclear.select("id", "key", "lo", "hi", F.lit(False).alias("digest")).union(spans.select("s_id", "s_key", "s_lo", "s_hi", F.lit(True))).distinct()
    asked = asked.groupBy("id", "key").agg(F.collect_list(F.struct("lo", "hi", "digest")).alias("asked"))
    asked = asked.withColumnsRenamed({"id": "a_id", "key": "a_key"})
    of_text = rows.join(asked, (F.col("id") == F.col("a_id")) & (F.col("key") == F.col("a_key"))).select("id", "key", "text", "asked")
    answers = scratch.keep(of_text.mapInArrow(_asked, "id long, key long, lo long, hi long, one long, two long, digest string"), "answers")

    windows = answers.where("digest is null").select("id", "key", "lo", "one", "two").distinct()
    earliest = windows.groupBy("one", "two").agg(F.min("id").alias("earliest"), F.max("id").alias("latest")).where("earliest < latest")
    also = windows.join(earliest, ["one", "two"]).where("earliest < id").select("id", "key", "lo", (F.col("lo") + WINDOW).alias("hi"), F.lit(None).cast("string").alias("digest"))
    digests = answers.where("digest is not null").select(F.col("id").alias("s_id"), F.col("key").alias("s_key"), F.col("lo").alias("s_lo"), F.col("hi").alias("s_hi"), "digest").distinct()
    checked = spans.join(digests, ["s_id", "s_key", "s_lo", "s_hi"], "left").select("id", "key", "lo", "hi", F.coalesce("digest", F.lit("none")).alias("digest"))
    gone = also.union(checked).groupBy("id", "key").agg(F.collect_list(F.struct("lo", "hi", "digest")).alias("spans"))
    gone = scratch.keep(gone, "gone").withColumnsRenamed({"id": "g_id", "key": "g_key"})
    out = rows.join(gone, (F.col("id") == F.col("g_id")) & (F.col("key") == F.col("g_key")), "left").select("id", "key", "text", "spans")
    out = out.mapInArrow(_cleaned, "id long, key long, n_words long, n_removed long, kept string, kept_sha256 string")
    return out.select(F.nullif("id", F.lit(_LAST)).alias("id"), F.col("key").alias("text_hash"), "n_words", "n_removed", "kept", "kept_sha256")
