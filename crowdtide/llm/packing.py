"""Best-fit packing of token pieces into sequences, in levels.

Pieces, without their text, are dealt evenly to tasks of at most about ``AT_ONCE``, whatever order the table
is in, so no bin is settled while pieces of its task are still to come. Each task packs its share best fit,
longest first; bins that are nearly full are final. Underfull
bins go up a tree as items: each round a task takes the bins of several tasks and packs them again. Two
bins of at most half the room always fit together, so a task passes on at most one of those, and of the
others only the ``CARRIED`` with most room, which is all that the few small bins above can use. What is
not passed on is final as it is, so nothing is lost and no task's share grows with the table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch, blocks
from crowdtide.llm.tokens import END, REMEMBERED, Encoder

#: A bin with less room than this is final. Pieces that are packed together in a task, bins that a task
#: passes on, and tasks whose bins meet in one of the next round.
ROOM_LEFT, AT_ONCE, CARRIED, FAN_IN = 8, 200_000, 512, 32

_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_BIN = pa.schema([("fill", pa.int64()), ("closed", pa.bool_()), ("pieces", pa.list_(_PIECE))])
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
BIN = "fill long, closed boolean, pieces array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>>"


def best_fit(bins: list[tuple[int, list]], size: int) -> list[tuple[int, list]]:
    """Bins packed into fewer: longest first, each into the bin whose room it fills best."""
    by_room: dict[int, list[list]] = {}
    rooms: list[int] = []
    for fill, pieces in sorted(bins, key=lambda b: -b[0]):
        at = bisect_left(rooms, fill)
        if at == len(rooms):
            room, target = size, []
        else:
            room = rooms[at]
            target = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        target.extend(pieces)
        room -= fill
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(target)
    return [(size - room, pieces) for room, found in by_room.items() for pieces in found]


def _batch(bins: list[tuple[int, list, bool]]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([b[0] for b in bins], pa.int64()), pa.array([b[2] for b in bins], pa.bool_()), pa.array([b[1] for b in bins], pa.list_(_PIECE))], schema=_BIN
    )


def _packed(items: Iterator[list[tuple[int, list]]], size: int) -> Iterator[pa.RecordBatch]:
    """Pack a task's share of items, all of them together."""
    bins = best_fit([item for some in items for item in some], size)
    done = [(f, p, True) for f, p in bins if size - f < ROOM_LEFT]
    rest = sorted((b for b in bins if size - b[0] >= ROOM_LEFT), key=lambda b: b[0])
    done += [(f, p, False) for f, p in rest[:CARRIED]] + [(f, p, True) for f, p in rest[CARRIED:]]
    for i in range(0, len(done), 2000):
        yield _batch(done[i : i + 2000])


def _pieces(doc_id: int | None, ids: bytes, size: int) -> list[dict]:
    """A document of more than ``size`` ids is cut into whole pieces, after a first one of what is over."""
    n = len(ids) // 4
    cuts = [0, *range(n % size or size, n, size), n]
    return [
        {"doc_id": doc_id, "piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a : 4 * b])}
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]


def _first(path: str, size: int, id: str, text: str, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, remembered)
        for batch in batches:
            ids, texts = batch.column(id), batch.column(text).fill_null("")
            for rows, _, _ in blocks(texts):
                encoded = zip(ids[rows].to_pylist(), encoder.encode(texts[rows].to_pylist()), strict=True)
                found = [p for doc, codes in encoded for p in _pieces(doc, codes + END, size)]
                yield pa.RecordBatch.from_struct_array(pa.array(found, _PIECE))

    return run


def _dealt(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(([(p["length"], [p]) for p in b.to_pylist()] for b in batches), size)

    return run


def _again(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(([(f, p) for f, p in zip(b.column("fill").to_pylist(), b.column("pieces").to_pylist(), strict=True)] for b in batches), size)

    return run


def pack(
    docs: DataFrame, tokenizer: str, size: int = 1024, id: str = "doc_id", text: str = "text", remembered: int = REMEMBERED
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each document.

    A document is the ids of its text (null: of an empty one) and id 2. Repeated rows and rows without
    an id are documents of their own. An empty table gives no rows. ``sequence_id`` numbers the bins.
    A worker remembers ``remembered`` chunks of text with their ids, some 200 bytes each.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    narrow = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    pieces = scratch.keep(narrow.mapInArrow(_first(tokenizer, size, "id", "text", remembered), PIECE), "pieces")
    # Round-robin, which Spark does over sorted rows: even shares, of all parts of the table.
    tasks = max(1, -(-pieces.count() // AT_ONCE))
    bins = scratch.keep(pieces.repartition(tasks).mapInArrow(_dealt(size), BIN), "bins-0")
    done, level = [bins.where("closed")], 0
    while True:
        tasks, level = -(-tasks // FAN_IN), level + 1
        # Round-robin over sorted rows: the same bins meet again if a task is repeated.
        under = bins.where("not closed").repartition(tasks, F.col("fill"), F.xxhash64("pieces"))
        bins = scratch.keep(under.mapInArrow(_again(size), BIN), f"bins-{level}")
        if tasks == 1:
            done.append(bins)
            break
        done.append(bins.where("closed"))
    every = done[0]
    for more in done[1:]:
        every = every.union(more)
    # The bins are read from files, so their numbers are the same each time.
    numbered = every.withColumn("sequence_id", F.monotonically_increasing_id()).select("sequence_id", "pieces", F.posexplode("pieces").alias("at", "p"))
    before = F.aggregate(F.slice("pieces", 1, F.col("at")), F.lit(0).cast("long"), lambda n, p: n + p["length"])
    return numbered.select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", before.alias("offset"))
