"""Token ids in files of directly addressable codes.

An id is cut into chunks from its low bits up, one level per chunk width. Level 0 holds a chunk of every
id; a bit per chunk says whether the id goes on; the next level holds chunks of those that do. A rank
directory counts the set bits before each block of 512, so the chunk of an id at the next level is found
by one count and one popcount: any id is read without decoding another.

The widths are chosen for each file from the lengths of its ids so that it is smallest.

File, all numbers little-endian::

    magic b"CTDAC001" | u32 number of levels | u32 widths... | u64 ids | u64 documents | u64 chunks of each level
    documents: i64 doc_id ..., u8 1 if the doc_id is null ..., u64 start in this file ... (and the end)
    each level: packed chunks, then, but for the last level, bitmap and u64 rank directory

Each task writes its own files under a name of its own and returns them with its rows; only files named
in the written manifest count, so what a lost or doubled attempt left behind is never read.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch, blocks, parts, ranges, store_of
from crowdtide.llm.tokens import END, Encoder

MAGIC = b"CTDAC001"
#: Bits per count in the rank directory; ids after which a task starts its next file; ids packed at a time.
RANK, FILE_IDS, BLOCK = 512, 4_000_000, 1 << 20
#: Bytes of text whose distinct chunks are looked up together.
TOGETHER = 4 << 20


def widths(ids: np.ndarray) -> list[int]:
    """Chunk widths, low bits first, that take the fewest bits for these ids."""
    # The exponent of a number, as frexp has it, is its bit length; doubles hold 32 bits exactly.
    of_length = sum((np.bincount(np.frexp(ids[k : k + BLOCK].astype(float))[1], minlength=33) for k in range(0, len(ids), BLOCK)), np.zeros(33, np.int64))
    bits = max(1, int(np.flatnonzero(of_length).max(initial=0)))
    longer = [len(ids), *(int(n) for n in len(ids) - np.cumsum(of_length)[1:bits])]
    best: dict[int, tuple[float, list[int]]] = {bits: (0.0, [])}
    for low in range(bits - 1, -1, -1):
        flag = 1 + 64 / RANK
        best[low] = min(
            (longer[low] * (high - low + (flag if high < bits else 0)) + best[high][0], [high - low, *best[high][1]]) for high in range(low + 1, bits + 1)
        )
    return best[0][1]


def _pack_bits(values: np.ndarray, width: int) -> bytes:
    """So many bits of each value, one after the other: 64 values fill ``width`` words, all groups of 64 together."""
    groups = -(-len(values) // 64)
    column = np.zeros((groups, 64), np.uint64)
    column.ravel()[: len(values)] = values
    column = np.ascontiguousarray(column.T)
    words = np.zeros((width, groups), "<u8")
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[word] |= column[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= column[i] >> np.uint64(64 - shift)
    return words.T.tobytes()[: (len(values) * width + 7) // 8]


def _words(raw: np.ndarray) -> np.ndarray:
    """Packed bytes as aligned words, with one more after them."""
    return np.frombuffer(raw.tobytes() + bytes(-len(raw) % 8 + 8), "<u8")


def _unpack(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The chunks at these places. Each is read from the word that it begins in and the next."""
    bit = at.astype(np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    found = words[word] >> shift
    found |= words[word + 1] << np.uint64(1) << (np.uint64(63) - shift)
    return found.astype(np.uint32) & np.uint32((1 << width) - 1)


def dump(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    cuts = widths(ids)
    out, levels, rest = io.BytesIO(), [], ids.astype(np.uint32)
    for i, width in enumerate(cuts):
        chunks, rest = rest & np.uint32((1 << width) - 1), rest >> np.uint32(width)
        body = b"".join(_pack_bits(chunks[k : k + BLOCK], width) for k in range(0, len(chunks), BLOCK)) + bytes(8)
        if i < len(cuts) - 1:
            on = rest > 0
            bitmap = np.packbits(on, bitorder="little")
            bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (RANK // 8) + RANK // 8, np.uint8)])
            counts = np.bitwise_count(bitmap.reshape(-1, RANK // 8)).sum(axis=1, dtype=np.uint64)
            rank = np.concatenate([np.zeros(1, np.uint64), np.cumsum(counts, dtype=np.uint64)])
            body += bitmap.tobytes() + rank.tobytes()
            rest = rest[on]
        levels.append((len(chunks), body))
    out.write(MAGIC + struct.pack(f"<I{len(cuts)}I", len(cuts), *cuts) + struct.pack("<QQ", len(ids), len(doc_ids)))
    out.write(struct.pack(f"<{len(cuts)}Q", *(n for n, _ in levels)))
    out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids))
    out.write(np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes())
    for _, body in levels:
        out.write(body)
    return out.getvalue()


class TokenFile:
    """A file opened for reading; ``ids`` gives the ids at any places, in any order."""

    def __init__(self, raw: bytes | memoryview):
        data = np.frombuffer(raw, np.uint8)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        at = 8

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * n
            at += size
            return data[at - size : at].view(kind)

        count = int(take("<u4", 1)[0])
        self.widths = take("<u4", count).tolist()
        self.n_ids, docs = (int(x) for x in take("<u8", 2))
        chunks = take("<u8", count).tolist()
        doc_ids, none = take("<i8", docs).tolist(), take("u1", docs).tolist()
        self.doc_ids = [None if n else d for d, n in zip(doc_ids, none, strict=True)]
        self.starts = take("<u8", docs + 1).astype(np.int64)
        self._levels = []
        for i, (n, width) in enumerate(zip(chunks, self.widths, strict=True)):
            body = _words(take("u1", (n * width + 7) // 8 + 8))
            bitmap = rank = inside = None
            if i < count - 1:
                size = (n + 7) // 8
                size += -size % (RANK // 8) + RANK // 8
                bitmap = _words(take("u1", size))[:-1]
                rank = take("<u8", size // (RANK // 8) + 1).astype(np.int64)
                # Within a block, the set bits before each of its words.
                counts = np.bitwise_count(bitmap).reshape(-1, RANK // 64)
                inside = (np.cumsum(counts, axis=1, dtype=np.uint16) - counts).ravel()
            self._levels.append((width, body, bitmap, rank, inside))

    def ids(self, places: np.ndarray) -> np.ndarray:
        at, out = np.asarray(places, np.int64), np.zeros(len(places), np.uint32)
        which, shift = np.arange(len(at)), 0
        for width, body, bitmap, rank, inside in self._levels:
            found = _unpack(body, at, width)
            if shift:
                out[which] |= found << np.uint32(shift)
            else:
                out = found
            if bitmap is None:
                break
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = bitmap[word]
            on = np.flatnonzero(held >> bit & np.uint64(1))
            which, at, word, below = which[on], at[on], word[on], held[on] & ((np.uint64(1) << bit[on]) - np.uint64(1))
            # Set bits before each place: the directory's count, the words of its block before it, the bits below.
            at = rank[at // RANK] + inside[word] + np.bitwise_count(below)
            shift += width
        return out


_MANIFEST = "range int, part int, path string, n_docs long, n_ids long, bytes long"


def _writer(tokenizer: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, attempt = Encoder.of(tokenizer), uuid.uuid4().hex
        store, root = store_of(folder)
        docs, lengths, held, part, here = [], [], [], 0, TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal docs, lengths, held, part
            ids = np.frombuffer(b"".join(held), "<u4")
            raw, name = dump(docs, lengths, ids), f"{here:06d}-{part:06d}-{attempt}.dac"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(raw)
            row = [[here], [part], [name], [len(docs)], [len(ids)], [len(raw)]]
            docs, lengths, held, part = [], [], [], part + 1
            return pa.record_batch(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["range", "part", "path", "n_docs", "n_ids", "bytes"],
            )

        waiting = 0
        store.create_dir(root, recursive=True)
        for batch in batches:
            keys, texts = batch.column("id"), batch.column("text").fill_null("")
            for rows, _, _ in blocks(texts, TOGETHER):
                for doc, found in zip(keys[rows].to_pylist(), encoder.encode(texts[rows].to_pylist()), strict=True):
                    docs.append(doc)
                    held.append(found + END)
                    lengths.append(len(held[-1]) // 4)
                    waiting += lengths[-1]
                    if waiting >= FILE_IDS:
                        yield flush()
                        waiting = 0
        if docs:
            yield flush()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, scratch: Scratch, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """Writes the ids of all documents in ascending order of id (nulls first, then by text).

    Returns the manifest and the folder that it names files in.
    """
    spark, folder = docs.sparkSession, scratch.folder("files")
    number, count = ranges(docs.select(F.col(id).cast("long").alias("id")), "id", parts(spark))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).withColumn("range", number)
    sorted_rows = rows.repartitionById(count, F.col("range").cast("int")).sortWithinPartitions(F.col("id").asc_nulls_first(), F.coalesce("text", F.lit("")))
    return scratch.keep(sorted_rows.select("id", "text").mapInArrow(_writer(tokenizer, folder), _MANIFEST), "manifest"), folder


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        for batch in batches:
            for name, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_stream(f"{root}/{name}") as source:
                    file = TokenFile(source.readall())
                crcs, low = [0] * len(file.doc_ids), 0
                while low < len(file.doc_ids):  # some documents at a time
                    high = max(low + 1, int(np.searchsorted(file.starts, file.starts[low] + (1 << 18), "right")) - 1)
                    ids = file.ids(np.arange(file.starts[low], file.starts[high])).astype("<u4")
                    for k in range(low, high):
                        crcs[k] = zlib.crc32(ids[file.starts[k] - file.starts[low] : file.starts[k + 1] - file.starts[low]].tobytes())
                    low = high
                yield pa.record_batch(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(file.starts[:-1] + base), pa.array(np.diff(file.starts)), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files.

    ``start`` counts the ids of all files before. The manifest has one row per file of some megabytes, and
    only its counts of ids meet in one place.
    """
    spark = manifest.sparkSession
    per_range = manifest.groupBy("range").agg(F.sum("n_ids").alias("n"))
    counts = sorted((r["range"], r["n"]) for r in per_range.collect())  # one per write task
    base, so_far = [], 0
    for number, n in counts:
        base.append((number, so_far))
        so_far += n
    order = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = spark.createDataFrame(base, "range int, range_base long")
    placed = manifest.join(bases, "range").withColumn("base", F.col("range_base") + F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    spread = placed.select("path", "base").repartition(max(1, min(len(counts), parts(spark))), "path")
    return spread.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
