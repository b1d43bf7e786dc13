"""Near-duplicate groups by b-bit minwise hashing.

Each distinct shingle set is hashed once: ``BANDS * ROWS`` minima give one key per band, and the low
``BITS`` bits of each minimum, packed into longs, give a similarity estimate by counting bits, corrected
for bits that agree by chance. Candidates that pass it are confirmed on the full sets.

A bucket never becomes all its pairs. First each set meets the leader of each of its buckets, the most
alike leader first, and confirmed links are joined into components. What candidates connect but links do
not is then compared on full sets, in blocks that count all intersections at once and return no more
links than join their components. Last, sets that share a bucket but are connected by no candidate are
compared by their signatures, in blocks too. So every pair that shares a bucket and is not yet connected
is looked at, whatever the size of the bucket.

Sets are compared as sorted distinct 64-bit hashes of their shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtide.llm.common import Scratch, blocks, kept, numbers, parts, shingle_hashes, word_hashes
from crowdtide.llm.components import components

ROWS, BANDS, BITS = 5, 32, 2
#: A pair at the threshold fails the estimate with a chance below one in a million.
SIGMAS = 5
#: Sets that one task compares with one leader; sets and bytes of text of a block; shingles counted at a time.
FEW, BLOCK_OF, BLOCK_BYTES, COLUMNS = 512, 256, 16 << 20, 16_384

_HASHES = ROWS * BANDS
_WORDS = _HASHES * BITS // 64
_A = (numbers(_HASHES, 21) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (numbers(_HASHES, 22) >> np.uint64(32)).astype(np.uint32)
_ROW = numbers(_HASHES, 23).reshape(BANDS, ROWS) | np.uint64(1)
_BAND = numbers(BANDS, 24)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set that is not empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(_HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(least, (_A[:, None] * x[None, i : i + 2048] + _B[:, None]).min(axis=1), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of each minimum, 64 bits to a long."""
    low = (least & np.uint32(2**BITS - 1)).astype(np.uint8)
    bits = np.unpackbits(low[..., None], axis=-1)[..., 8 - BITS :]
    return np.packbits(bits.reshape(*low.shape[:-1], _HASHES * BITS), axis=-1).view(">i8").astype(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(*least.shape[:-1], BANDS, ROWS).astype(np.uint64)
    keys = ((rows + np.uint64(1)) * _ROW).sum(axis=-1, dtype=np.uint64) ^ _BAND
    keys ^= keys >> np.uint64(29)
    return (keys * np.uint64(0xBF58476D1CE4E5B9) ^ _BAND).view(np.int64)


def _signer(size: int):
    schema = pa.schema(
        [("id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bits", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near duplicates")
        for batch in batches:
            for rows, data, offsets in blocks(batch.column("text")):
                sets = list(shingle_hashes(*word_hashes(data, offsets, lower=True), size))
                full = [s for s in sets if len(s)]
                least = np.array([minima(s) for s in full], np.uint32).reshape(-1, _HASHES)
                bits, bands = iter(packed(least)), iter(band_keys(least))
                yield pa.record_batch(
                    [
                        batch.column("id")[rows],
                        batch.column("text_hash")[rows],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(bits) if len(s) else None for s in sets], pa.list_(pa.int64())),
                        pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return sign


def likeness(x: str, y: str) -> Column:
    """Estimated similarity of two packed signatures: a pair of bits differs if either bit does."""
    differ = F.lit(0)
    for i in range(_WORDS):
        d = F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))
        either = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(either)
    chance = 1 / 2**BITS
    return (1 - differ / F.lit(_HASHES) - chance) / (1 - chance)


def _cut(threshold: float) -> float:
    p = threshold + (1 - threshold) / 2**BITS
    return threshold - SIGMAS * (p * (1 - p) / _HASHES) ** 0.5 / (1 - 1 / 2**BITS)


def _confirmer(size: int, num: int, den: int):
    """Streams texts sorted by leader, with the leader's own text first; holds one leader's set at a time."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near duplicates")
        key = held = last = None
        for batch in batches:
            a, salt, b = (batch.column(c).to_pylist() for c in ("a", "salt", "b"))
            good: tuple[list, list] = ([], [])
            for rows, data, offsets in blocks(batch.column("text")):
                sets = shingle_hashes(*word_hashes(data, offsets, lower=True), size)
                for i, found in zip(range(rows.start, rows.stop), sets, strict=True):
                    if b[i] is None:
                        key, held, last = (a[i], salt[i]), found, None
                    elif key == (a[i], salt[i]) and b[i] != last:
                        last = b[i]
                        if held[0] <= found[-1] and found[0] <= held[-1]:
                            shared = len(np.intersect1d(held, found, assume_unique=True))
                            if den * shared >= num * (len(held) + len(found) - shared):
                                good[0].append(a[i])
                                good[1].append(b[i])
            yield pa.record_batch([pa.array(good[0], pa.int64()), pa.array(good[1], pa.int64())], names=["a", "b"])

    return confirm


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are alike. A leader with many pairs is spread over several tasks."""
    salts = F.ceil(F.col("n") / FEW).cast("int")
    hubs = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", salts.alias("salts"))
    side = pairs.join(hubs, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), "b")
    others = side.join(texts.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "text")
    own = hubs.join(texts.withColumnRenamed("node", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "text"
    )
    dealt = own.union(others).repartition(parts(pairs.sparkSession), "a", "salt")
    return dealt.sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(_confirmer(size, num, den), "a long, b long")


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of one list shares with each of the other."""
    sizes = [len(s) for s in left + right]
    row, all_of = np.repeat(np.arange(len(sizes)), sizes), np.concatenate(left + right)
    order = np.argsort(all_of, kind="stable")
    row, all_of = row[order], all_of[order]
    column = np.cumsum(np.append(0, all_of[1:] != all_of[:-1])) if len(all_of) else all_of.astype(np.int64)
    often = np.bincount(column)[column] > 1  # a shingle of one set is shared with none
    row, column = row[often], np.unique(column[often], return_inverse=True)[1]
    out = np.zeros((len(left), len(right)))
    for low in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        has = np.zeros((len(sizes), min(COLUMNS, int(column.max()) + 1 - low)), np.float32)
        has[row[a:b], column[a:b] - low] = 1
        out += has[: len(left)] @ has[len(left) :].T
    return out.round().astype(np.int64)


def _joiner(size: int, num: int, den: int):
    """Streams pairs of blocks; returns links that join components, at most one for each join."""

    def joined(nodes: tuple[list, list], sets: tuple[list, list], root: dict) -> pa.RecordBatch:
        good: tuple[list, list] = ([], [])
        if sets[0]:
            both = shared(*sets)
            whole = np.array([len(s) for s in sets[0]])[:, None] + np.array([len(s) for s in sets[1]])[None] - both
            up: dict = {}

            def find(x):
                while x in up:
                    x = up[x]
                return x

            for i, j in zip(*(x.tolist() for x in np.nonzero(den * both >= num * whole)), strict=True):
                a, b = find(root[nodes[0][i]]), find(root[nodes[1][j]])
                if a != b:
                    up[a] = b
                    good[0].append(nodes[0][i])
                    good[1].append(nodes[1][j])
        return pa.record_batch([pa.array(good[0], pa.int64()), pa.array(good[1], pa.int64())], names=["a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("near duplicates")
        key = None
        nodes, sets, root = ([], []), ([], []), {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cluster", "i", "j", "side", "node", "root")]
            for rows, data, offsets in blocks(batch.column("text")):
                found = shingle_hashes(*word_hashes(data, offsets, lower=True), size)
                for at, one in zip(range(rows.start, rows.stop), found, strict=True):
                    *now, side, node, of = (c[at] for c in columns)
                    if now != key:
                        if key:
                            yield joined(nodes, sets, root)
                        key, nodes, sets, root = now, ([], []), ([], []), {}
                    if side and not sets[0]:
                        continue  # nothing on the left
                    if not nodes[side] or nodes[side][-1] != node:
                        nodes[side].append(node)
                        sets[side].append(one)
                        root[node] = of
        if key:
            yield joined(nodes, sets, root)

    return join


def near_duplicates(
    docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, text_hash, n_shingles, component_id, kept) for each row of ``docs``.

    Two texts are linked when ``den * shared >= num * all`` of their distinct shingles of ``size``
    lower-cased words; a text with fewer words is one shingle, one without words is linked with nothing.
    ``component_id`` is the smallest id that links reach. One row of each component has ``kept``: that
    with this id; of several such rows, or rows without an id, the first by ``text_hash``. Rows that
    repeat an id and a text count as one and are all marked alike. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    signed = scratch.keep(
        rows.mapInArrow(_signer(size), "id long, text_hash long, n_shingles long, digest binary, bits array<long>, bands array<long>"), "signed"
    )
    # One node for each distinct set; of the rows that have it, the first stands for its text.
    row = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("row")
    distinct = signed.where("digest is not null").groupBy("digest").agg(row, F.first("bits").alias("bits"), F.first("bands").alias("bands"))
    nodes = scratch.keep(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    bits = nodes.select("node", "bits")

    keyed = nodes.select("node", F.explode("bands").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = scratch.keep(keyed.join(leaders, "key").select("key", "node", "leader", "n"), "members")
    cut = _cut(num / den)

    def alike(pairs: DataFrame) -> DataFrame:
        of_a, of_b = bits.select(F.col("node").alias("a"), F.col("bits").alias("x")), bits.select(F.col("node").alias("b"), F.col("bits").alias("y"))
        return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", likeness("x", "y").alias("like")).where(F.col("like") >= cut)

    star = members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    star = scratch.keep(alike(star), "star")

    def texts_of(wanted: DataFrame, name: str) -> DataFrame:
        at = nodes.join(wanted, "node").select("node", F.col("row.id").alias("id"), F.col("row.text_hash").alias("text_hash"))
        same = rows["id"].eqNullSafe(at["id"]) & (rows["text_hash"] == at["text_hash"])
        return scratch.keep(rows.join(at, same).select("node", "text"), name)

    known = star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
    texts = texts_of(known, "texts")

    def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs whose ends are not yet in one component."""
        for end in ("a", "b"):
            pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
        return pairs.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")

    best = star.groupBy("b").agg(F.max_by("a", F.struct("like", -F.col("a"))).alias("a")).select("a", "b")
    links = scratch.keep(confirmed(best, texts, size, num, den), "links-1")
    roots = components(links, scratch, "roots-1")
    links = links.union(scratch.keep(confirmed(across(star.select("a", "b"), roots), texts, size, num, den), "links-2"))
    roots = components(links, scratch, "roots-2")

    # Sets that candidates connect, whether confirmed or not, but links do not yet: those outside the
    # largest component of such a cluster meet all of it, block by block, on their full sets.
    clusters = components(star, scratch, "clusters")
    in_cluster = known.join(clusters, "node", "left").join(roots.withColumnRenamed("root", "r"), "node", "left")
    in_cluster = in_cluster.select("node", F.coalesce("root", "node").alias("cluster"), F.coalesce("r", "node").alias("root"))
    sized = in_cluster.join(texts, "node").withColumn("bytes", F.octet_length("text"))
    per = sized.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    per = per.groupBy("cluster").agg(F.max_by("root", F.struct("n", -F.col("root"))).alias("main"), F.count("*").alias("roots"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    many = F.ceil(F.greatest(F.col("n") / BLOCK_OF, F.col("bytes") / BLOCK_BYTES)).cast("int")
    per = per.where("roots > 1").select("cluster", "main", many.alias("many"))
    split = sized.join(per, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "many").cast("int"))
    split = scratch.keep(split.select("cluster", "node", "root", "text", "main", "many", "block"), "split")
    every = F.explode(F.sequence(F.lit(0), F.col("many") - 1))
    left = split.where("root != main").select("cluster", F.col("block").alias("i"), every.alias("j"), F.lit(0).alias("side"), "node", "root", "text")
    right = split.select("cluster", every.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"), "node", "root", "text")
    met = left.union(right).repartition(parts(spark), "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "side", "node")
    links = links.union(scratch.keep(met.mapInArrow(_joiner(size, num, den), "a long, b long"), "links-3"))
    roots = components(links, scratch, "roots-3")

    # What shares a bucket without being connected by any candidate.
    placed = members.join(clusters, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("cluster"))
    mixed = placed.groupBy("key").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).where("lo != hi").select("key")
    many = F.ceil(F.col("n") / BLOCK_OF).cast("int")
    own = placed.join(mixed, "key").withColumn("many", many).withColumn("block", F.pmod(F.xxhash64("node"), "many").cast("int"))
    own = scratch.keep(own.join(bits, "node"), "mixed")
    left = own.select("key", "node", "cluster", "bits", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("many") - 1)).alias("j"))
    right = own.select("key", "node", "cluster", "bits", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    x, y = left.alias("x"), right.alias("y")
    apart = (F.col("x.cluster") != F.col("y.cluster")) & ((F.col("x.i") != F.col("x.j")) | (F.col("x.node") < F.col("y.node")))
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    rest = x.join(y, on & apart & (likeness("x.bits", "y.bits") >= cut))
    rest = rest.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    rest = scratch.keep(across(rest, roots), "rest")
    if not rest.isEmpty():
        wanted = rest.select(F.col("a").alias("node")).union(rest.select("b")).distinct().join(known, "node", "left_anti")
        texts = texts.union(texts_of(wanted, "texts-2"))
        last = scratch.keep(confirmed(rest, texts, size, num, den), "links-4")
        if not last.isEmpty():
            roots = components(links.union(last), scratch, "roots-4")

    # A component's first row stands for it.
    grouped = nodes.select("digest", "node", "row").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = grouped.groupBy("root").agg(F.min("row").alias("best"))
    grouped = scratch.keep(grouped.join(first, "root").select("digest", F.col("best.id").alias("best_id"), F.col("best.text_hash").alias("best_hash")), "grouped")
    out = signed.select("id", "text_hash", "n_shingles", "digest").join(grouped, "digest", "left")
    empty = F.col("digest").isNull()
    kept = empty | (F.col("id").eqNullSafe(F.col("best_id")) & (F.col("text_hash") == F.col("best_hash")))
    return out.select("id", "text_hash", "n_shingles", F.when(empty, F.col("id")).otherwise(F.col("best_id")).alias("component_id"), kept.alias("kept"))
