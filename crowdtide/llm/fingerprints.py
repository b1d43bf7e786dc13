"""Lempel-Ziv phrase fingerprints.

A text's bytes are parsed into dictionary phrases, each the shortest stretch not seen before in this text.
The set of phrases is what a compressor would have learnt; two texts that compress well together share
many. Phrases are hashed, the ``HASHES`` smallest of the set are the fingerprint, and two fingerprints are
compared by the share of the smallest of both that they have in common.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtide.llm.common import BLOCK, Rolling, numbers, parts, ranges

HASHES = 128
_BYTE, _PHRASE = numbers(256, 31), Rolling(32)


def phrase_ends(data: bytes) -> list[int]:
    """The end of each phrase. What is left at the end of the text is a phrase seen before."""
    known: dict[int, int] = {}
    child, ends, node, fresh, place = known.get, [], 0, 256, 0
    for byte in data:
        place += 1
        node = child(key := node + byte, 0)
        if not node:
            known[key] = fresh
            fresh += 256
            ends.append(place)
    return ends


def fingerprint(data: bytes) -> np.ndarray:
    """The smallest hashes of the phrase set, sorted; none for an empty text."""
    ends = np.array(phrase_ends(data), np.int64)
    if not len(ends):
        return np.zeros(0, np.uint32)
    starts, raw, found, low = np.append(0, ends[:-1]), np.frombuffer(data, np.uint8), [], 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + BLOCK, "right")))
        a = starts[low]
        found.append(_PHRASE(_BYTE[raw[a : ends[high - 1]]], starts[low:high] - a, ends[low:high] - a))
        low = high
    return np.unique((np.concatenate(found) >> np.uint64(32)).astype(np.uint32))[:HASHES]


def as_text(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u4").tobytes()).decode()


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """0 to 1. Two empty texts are alike, an empty one and another are not."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    smallest = np.union1d(x, y)[:HASHES]
    return float(np.isin(smallest, np.intersect1d(x, y, assume_unique=True), assume_unique=True).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_OUT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams a range in order, one text ahead. The range's last row (``guest``) begins the next range."""
    waiting = None
    closed = False
    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("id", "text", "guest"))
        for id, text, guest in zip(*columns, strict=True):
            if closed:
                break
            text = text or ""
            mark = fingerprint(text.encode())
            if waiting is not None:
                before, old, own = waiting
                new = edited(old, text)
                changed = own if new == old else fingerprint(new.encode())
                out.append(
                    (before, len(old), hashlib.sha256(new.encode()).hexdigest(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, mark))
                )
            waiting, closed = (id, text, mark), guest
        if out:
            names = [c.split()[0] for c in _OUT.split(", ")]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def compare_with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row.

    The next document is that with the next smaller id; after the last comes the first. Rows without an id
    come last; rows of one id are in order of their text. A null text is empty. A single row is followed by
    itself. An empty table gives no rows.

    Ids are cut into ranges, one task each; the first rows of a range are read by the range before it too.
    So every text moves once.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id].cast("long").alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    number, count = ranges(rows.select("id"), "id", 2 * parts(spark))
    rows = rows.withColumn("range", number.cast("int"))
    # One row per range reaches the driver: its largest id. Nulls are in range 0 and last there.
    heads = sorted((r["range"], r["id"]) for r in rows.groupBy("range").agg(F.max("id").alias("id")).collect())
    used = [n for n, _ in heads]
    # The range below comes next; its largest id is the guest of the range above it.
    guests = [(id_, used[(i + 1) % len(used)]) for i, (_, id_) in enumerate(heads)]
    own = rows.select("id", "text", F.lit(False).alias("guest"), F.col("range").alias("at"))
    for_guests = spark.createDataFrame(guests, "id long, at int")
    # One row of each id is enough: the first by text.
    first = rows.join(F.broadcast(for_guests), rows["id"].eqNullSafe(for_guests["id"])).groupBy("at").agg(F.min("text").alias("text"), F.first(for_guests["id"]).alias("id"))
    every = own.union(first.select("id", "text", F.lit(True), "at"))
    order = ["guest", F.col("id").desc_nulls_last(), "text"]
    return every.repartitionById(count, "at").sortWithinPartitions("at", *order).mapInArrow(_compare, _OUT)
