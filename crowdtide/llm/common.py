"""Shared pieces: tables, written intermediates, words and hashes as numpy arrays."""

from __future__ import annotations

import ctypes
import gc
import posixpath
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtide.plans.lineage import shared_folder

#: Characters between words: [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of text that numpy works on at a time.
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


class Scratch:
    """Intermediate tables of one run, in the folder that all executors share.

    Written as Parquet, so a lost executor costs a task and never the lineage. ``drop`` removes tables
    that no result reads any more; what a returned DataFrame still reads stays until the folder is emptied.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = posixpath.join(shared_folder(spark), "crowdtide", f"{name}-{uuid.uuid4().hex}")

    def folder(self, name: str) -> str:
        return posixpath.join(self.path, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in the shared folder, and the path in it; ``file:`` may have one slash or three."""
    uri = urlparse(path)
    return (fs.LocalFileSystem(), uri.path) if uri.scheme in ("", "file") else fs.FileSystem.from_uri(path)


#: What this process keeps from task to task, by the kind of work.
_kept: dict[str, dict] = {}


def kept(work: str) -> dict:
    """What a worker keeps for one kind of work. What it kept for other work is given up, and its memory handed back."""
    if work not in _kept:
        if _kept:
            _kept.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim:
                trim(0)
        _kept[work] = {}
    return _kept[work]


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranges(df: DataFrame, column: str, number: int) -> tuple[Column, int]:
    """A column that numbers ``number`` ranges of a numeric column, nulls with the first, and how many there are.

    At most ``number`` cut points reach the driver.
    """
    at = [i / number for i in range(1, number)]
    found = df.agg(F.percentile_approx(column, at, 10000).alias("c")).first()["c"] if at else None
    cuts = sorted(set(found or ()))
    if not cuts:
        return F.lit(0), 1
    higher = F.filter(F.lit(cuts), lambda x: x < F.col(column))
    return F.coalesce(F.size(higher), F.lit(0)), len(cuts) + 1


def row_keys(docs: DataFrame, id: str, text: str) -> tuple[Column, Column]:
    """Two longs that name a row's id and text; a null id has a value of its own."""
    return F.coalesce(docs[id].cast("long"), F.lit(-(2**63))), F.xxhash64(docs[text])


def without_rows(docs: DataFrame, rejected: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose id and text ``rejected`` (id, text_hash) does not name."""
    a, b = row_keys(docs, id, text)
    right = rejected.select(F.coalesce("id", F.lit(-(2**63))).alias("_key_id"), F.col("text_hash").alias("_key_text"))
    left = docs.withColumns({"_key_id": a, "_key_text": b})
    return left.join(right, ["_key_id", "_key_text"], "left_anti").drop("_key_id", "_key_text")


def one_row_each(docs: DataFrame, chosen: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (id, text_hash, and any further columns) names, once each.

    The further columns are added under a struct ``_chosen``; with none, the columns are those of ``docs``.
    Texts move once: the join and the choice among repeated rows use the same partitioning.
    """
    a, b = row_keys(docs, id, text)
    more = [c for c in chosen.columns if c not in ("id", "text_hash")]
    right = chosen.select(
        F.coalesce("id", F.lit(-(2**63))).alias("_key_id"), F.col("text_hash").alias("_key_text"), *([F.struct(*more).alias("_chosen")] if more else [])
    )
    left = docs.withColumns({"_key_id": a, "_key_text": b})
    keys = ["_key_id", "_key_text"]
    joined = left.join(right, keys, "inner" if more else "left_semi").dropDuplicates(keys)
    return joined.drop(*keys)


# --- texts and words -------------------------------------------------------------------------


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of about ``size`` bytes at a time: their slice, UTF-8 bytes and offsets. A null counts as empty."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield slice(low, high), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """``count`` well spread 64-bit numbers, the same in every process."""
    start = np.uint64(seed * 0x632BE59BD9B4E019 % 2**64)
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start)


class Rolling:
    """Hashes of any stretch of a sequence, from one running sum of ``value * base ** place``."""

    def __init__(self, seed: int):
        self.base = int(numbers(1, seed)[0]) | 1
        self._up = self._down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            n = max(n, BLOCK + 1)
            steps = np.full(n, self.base, np.uint64), np.full(n, pow(self.base, -1, 2**64), np.uint64)
            for s in steps:
                s[0] = 1
            self._up, self._down = (np.multiply.accumulate(s) for s in steps)
        return self._up, self._down

    def __call__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self._powers(len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])


_BYTE = numbers(256, 11)
_WORD = Rolling(12)


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text (and the end) the number of words before it."""
    solid = ~apart[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(solid)
    after = np.empty_like(solid)
    if len(data):
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes. Long texts go through in pieces, so memory follows the piece."""
    found, low = [], 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + 2 * BLOCK)))
        a, b = starts[low], ends[high - 1]
        piece = _LOWER[data[a:b]] if lower else data[a:b]
        found.append(_WORD(_BYTE[piece], starts[low:high] - a, ends[low:high] - a))
        low = high
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word, and for each text (and the end) the number of words before it."""
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(data, starts, ends, lower), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct hashes of ``size`` consecutive words.

    A text with fewer words gives one hash, of all of them; without words it gives none.
    """
    if len(words) >= size:
        run = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            run = mix(run + words[i : len(words) - size + 1 + i])
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(run[low : high - size + 1])
        elif high == low:
            yield words[:0]
        else:
            one = np.full(1, high - low, np.uint64)
            for i in range(low, high):
                one = mix(one * np.uint64(3) + words[i : i + 1])
            yield one
