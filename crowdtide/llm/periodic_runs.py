"""Stretches of words that repeat with a period, found by minimizers at several scales.

A run is a stretch of a text's words with smallest period q (words q apart are the same), at least three
periods and ``LEAST`` words long, that cannot be made longer. Periods up to ``SHORT`` are found by comparing
the words with themselves at each lag. Longer ones fall into scales of periods ``low`` to ``high``, where
``high`` is half as large again. At a scale the words are read as k-mers of ``high`` words, and of each window
of k-mers the smallest are kept. A window and the one a period later hold the same words as long as both lie
in the run, so a kept k-mer is kept again a period later; and as a k-mer is no shorter than the period, it is
not found in between. Neighbouring kept k-mers that are equal are thus a period apart, in every run of the
scale, and each such pair is extended word by word in both directions. Hashes only choose what is extended:
every run that is given has been compared.

Texts are read together in blocks, each with its own end mark, so a block costs a few array operations a scale.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crowdtide.llm.common import mix, numbers

#: A run has so many periods and so many words at least.
TIMES, LEAST = 3, 24
#: Periods found by direct comparison: windows of shorter periods would have no room for a k-mer.
SHORT = LEAST // TIMES
#: Words read together; a longer text is read alone.
BLOCK_WORDS = 1 << 18

_FIRST, _SECOND = numbers(2, 51) | np.uint64(1)
_SCHEMA = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

#: For a row's id and number of words: which word to read at each place, or None for the text as it is.
Edit = Callable[[int | None, int], np.ndarray | None]


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(low, high, window) for periods above ``SHORT`` that a stretch of ``longest`` words can repeat with.

    A window covers ``2 * low`` words: with the one a period later it fits into three periods.
    """
    low = SHORT + 1
    while low * TIMES <= longest:
        high = low * 3 // 2
        yield low, high, (TIMES - 1) * low - high + 1
        low = high + 1


def _sliding(values: np.ndarray, window: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``window`` neighbours."""
    size = 1
    while 2 * size <= window:
        values, size = pick(values[:-size], values[size:]), 2 * size
    rest = window - size
    return pick(values[:-rest], values[rest:]) if rest else values


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the smallest of some window; all of them where several are smallest."""
    least = np.pad(_sliding(hashes, window, np.minimum), window - 1)
    return np.flatnonzero(_sliding(least, window, np.maximum) == hashes)


def scan_lag(values: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """Start and end of the stretches that repeat with ``lag`` and are long enough."""
    breaks = np.flatnonzero(values[lag:] != values[:-lag])
    edges = np.concatenate(([-1], breaks, [len(values) - lag]))
    length = np.diff(edges) - 1
    for i in np.flatnonzero(length >= max(LEAST, TIMES * lag) - lag).tolist():
        yield int(edges[i]) + 1, int(edges[i + 1]) + lag


def extend(values: np.ndarray, lag: int, at: int) -> tuple[int, int]:
    """Start and end of the stretch around ``at`` that repeats with ``lag``."""
    high, step, last = at, 64, len(values) - lag
    while high < last:
        upto = min(high + step, last)
        differs = values[high:upto] != values[high + lag : upto + lag]
        if differs.any():
            high += int(differs.argmax())
            break
        high, step = upto, 2 * step
    low, step = at, 64
    while low > 0:
        down = max(low - step, 0)
        differs = values[down:low] != values[down + lag : low + lag]
        if differs.any():
            low -= int(differs[::-1].argmax())
            break
        low, step = down, 2 * step
    return low, high + lag


def find_runs(values: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of a sequence of whole numbers, by start and then period.

    ``longest`` is the length of the longest stretch that can hold a run, where that is known.
    """
    longest = len(values) if longest is None else longest
    if longest < LEAST:
        return []
    # A stretch found again at a multiple of its period has the same ends: the first period is the smallest.
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, SHORT + 1):
        for stretch in scan_lag(values, lag):
            found.setdefault(stretch, lag)
    grams, size = mix(values.view(np.uint64) * _FIRST), 1
    for low, high, window in scales(longest):
        while 2 * size <= high:
            grams, size = mix(grams[:-size] * _FIRST + grams[size:] * _SECOND), 2 * size
        number = len(values) - high + 1
        hashes = mix(grams[:number] * _FIRST + grams[high - size : high - size + number] * _SECOND)
        places = minimizers(hashes, window)
        for lag, at in _seeds(hashes[places], places, low, high):
            until = -1
            for place in at:
                if place < until:
                    continue  # in the stretch that the seed before it was extended to
                start, end = extend(values, lag, place)
                until = end - lag
                if end - start >= TIMES * lag:
                    found.setdefault((start, end), lag)
    return sorted(((start, end, lag) for (start, end), lag in found.items()), key=lambda r: (r[0], r[2]))


def _seeds(hashes: np.ndarray, places: np.ndarray, low: int, high: int) -> Iterator[tuple[int, list[int]]]:
    """By lag, the places whose next place of the same hash is ``low`` to ``high`` words on."""
    order = np.argsort(hashes, kind="stable")
    hashes, places = hashes[order], places[order]
    lags = np.diff(places)
    near = np.flatnonzero((hashes[1:] == hashes[:-1]) & (lags >= low) & (lags <= high))
    lags, at = lags[near], places[near]
    order = np.lexsort((at, lags))
    lags, at = lags[order], at[order]
    edges = np.flatnonzero(np.diff(lags, prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(lags[a]), at[a:b].tolist()


def collapse(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run is left with its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, end, period in runs:
        change[start + period] += 1
        change[end] -= 1
    return np.flatnonzero(np.cumsum(change[:n]) == 0)


def _blocks(batch: pa.RecordBatch, edit: Edit | None) -> Iterator[list[tuple[int | None, list[bytes], np.ndarray | None]]]:
    """Rows with their words and their reading order, about ``BLOCK_WORDS`` words at a time."""
    block, held = [], 0
    for id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
        words = (text.as_py() or b"").split()
        block.append((id, words, edit(id, len(words)) if edit else None))
        held += len(words)
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    if block:
        yield block


def _block_runs(block: list[tuple[int | None, list[bytes], np.ndarray | None]]) -> Iterator[list[tuple[int, int, int]]]:
    """The runs of each text of a block."""
    known: dict[bytes, int] = {}
    fresh, pieces, starts, at = count(), [], [], 0
    for number, (_, words, order) in enumerate(block, start=1):
        codes = np.fromiter(map(known.setdefault, words, fresh), np.int64, len(words))
        pieces += [codes if order is None else codes[order], np.array([-number])]
        starts.append(at)
        at += len(words) + 1
    runs = iter(find_runs(np.concatenate(pieces), max(len(p) for p in pieces)))
    run = next(runs, None)
    for start, (_, words, _) in zip(starts, block, strict=True):
        own = []
        while run and run[0] < start + len(words):
            own.append((run[0] - start, run[1] - start, run[2]))
            run = next(runs, None)
        yield own


def _task(edit: Edit | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch, edit):
                found, left = [], []
                for (_, words, order), runs in zip(block, _block_runs(block), strict=True):
                    found.append([{"start": a, "length": b - a, "period": p} for a, b, p in runs])
                    kept = collapse(len(words), runs) if runs else None
                    if order is not None:
                        words = [words[i] for i in (order if kept is None else order[kept]).tolist()]
                    elif kept is not None:
                        words = [words[i] for i in kept.tolist()]
                    left.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([id for id, _, _ in block], pa.int64()),
                        pa.array([len(words) for _, words, _ in block], pa.int64()),
                        pa.array(found, _RUNS),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", edit: Edit | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed): one row per row of ``docs``, whatever further columns it has.

    ``runs`` has start, length and period of each run in words, by start and then period; ``collapsed`` is
    the words that stay, one blank between them, when each run is left with its first period. Words are what
    stands between blanks, tabs and line ends. A null text counts as empty and has no runs; a row with a null
    id and repeated rows are treated like any other. No row is moved, and a task holds a block of texts.
    """
    return docs.select(docs[id].cast("long").alias("id"), docs[text].alias("text")).mapInArrow(_task(edit), _SCHEMA)
