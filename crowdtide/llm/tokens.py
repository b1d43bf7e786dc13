"""Token ids of whole texts, as the tokenizers library gives them, at a bounded cost per new word.

The vocabulary's pre-tokenizer always ends a token before a space or a line break between two other
characters. So a text falls into chunks at these places, each chunk's ids do not depend on its
neighbours, and a chunk that occurs often is encoded once per Python worker. A stop or comma after a
letter is a token of its own, so a word is known with and without it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from crowdtide.llm.common import kept

#: Chunks that one worker remembers; further ones are encoded each time they occur.
REMEMBERED = 900_000
END = struct.pack("<I", 2)
#: Characters of the longest chunk that a worker remembers.
LONG = 40
#: Punctuation marks that are looked up apart from the word before them.
MARKS = frozenset(".,;:!?")

#: How the vocabulary writes a space.
_SPACE = "\u0120"
#: Two characters of white space in a row, as Python has it, for a search that knows ASCII's alone by name.
_APART = "[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace()) + "]{2}"
_BLANK, _LINE = " ", "\n"


def _flat(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of several texts in one array, and how many each has."""
    return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4


def _stretches(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """So many ids from each start on, one stretch after the other."""
    places = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    places += np.arange(len(places))
    return ids[places]


def _roomy(held: np.ndarray, n: int) -> np.ndarray:
    """The array, longer if it has no room for ``n`` values."""
    return held if n <= len(held) else np.append(held, np.zeros(max(n - len(held), len(held) // 2), held.dtype))


class Encoder:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit numbers in one bytes value."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self._room = remembered

        self._library = Tokenizer.from_file(path)
        self._newline = self._library.encode("\n", add_special_tokens=False).ids[0]
        words = self._library.get_vocab()
        self._spaced = np.zeros(max(words.values()) + 1, bool)  # ids whose token begins with a space
        self._spaced[[n for word, n in words.items() if word[0] == _SPACE]] = True
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        alone = zip(sorted(MARKS), self._ids(sorted(MARKS)), strict=True)
        self._mark = {mark: int.from_bytes(ids, "little") for mark, ids in alone if len(ids) == 4}
        # Keys are chunks without the space before them; with a line break before them it is part of the key. Row r of
        # the chunks that are held has the ids from _ends[r] to _ends[r + 1] in _pool. Row 0 is empty, rows from
        # _lasting on are given up after each call.
        self._known: dict[str, int] = {}
        self._pool, self._ends = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64)
        self._rows = self._lasting = 1

    @classmethod
    def of(cls, path: str, remembered: int = REMEMBERED) -> Encoder:
        """One for each process and path, so that chunks stay known from task to task."""
        opened = kept("tokens")
        if (path, remembered) not in opened:
            opened[path, remembered] = cls(path, remembered)
        return opened[path, remembered]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in found]

    def _whole(self, key: str) -> str:
        return key if key[:1] == "\n" else " " + key

    def _learn(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks, one chunk after the other, and how many each has.

        Words without white space inside go through the library as one text, a line each.
        """
        starts, sizes, found, total = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), [], 0
        other: list[int] = []

        def put(places: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
            nonlocal total
            starts[places], sizes[places] = total + np.cumsum(n) - n, n
            found.append(ids)
            total += len(ids)

        after_line = np.array([k[:1] == "\n" for k in keys], bool)
        # A word's space begins its first token and stands in no other; a line break is a token of its own.
        for line in (False, True):
            places = np.flatnonzero(after_line == line)
            words = [keys[i][line:] for i in places.tolist()]
            if " ".join(words).split() != words:
                alone = np.array([w.split() == [w] for w in words], bool)
                other += places[~alone].tolist()
                places, words = places[alone], [w for w, yes in zip(words, alone.tolist(), strict=True) if yes]
            for i in range(0, len(words), 2000):
                some, text = places[i : i + 2000], (_LINE if line else _BLANK).join(words[i : i + 2000])
                ids = np.array(self._library.encode_batch_fast([text if line else " " + text], add_special_tokens=False)[0].ids, "<u4")
                if line:
                    ids = np.append(np.array([self._newline], "<u4"), ids)
                cuts = np.flatnonzero(ids == self._newline if line else self._spaced[ids])
                if len(cuts) != len(some):  # a word holds the line break's id itself
                    other += some.tolist()
                else:
                    put(some, ids, np.diff(np.append(cuts, len(ids))))
        if other:
            put(np.array(other), *_flat(self._ids([self._whole(keys[i]) for i in other])))
        return _stretches(np.concatenate(found), starts, sizes) if found else np.zeros(0, "<u4"), sizes

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        out: list[bytes] = []
        regular: list[tuple[int, str]] = []
        whole: list[tuple[int, str]] = []
        texts = list(texts)
        apart = pc.match_substring_regex(pa.array(texts, pa.large_string()), _APART).to_pylist()
        for n, (text, spaces) in enumerate(zip(texts, apart, strict=True)):
            odd = spaces or not text or text[0].isspace() or text[-1].isspace() or any(s in text for s in self._special)
            (whole if odd else regular).append((n, text))
            out.append(b"")
        for (n, _), ids in zip(regular, self._regular([text for _, text in regular]), strict=True):
            out[n] = ids
        if whole:
            # Irregular white space: chunks end before a space that something else than white space follows.
            pieces = [(n, p) for n, text in whole for p in self.chunks(text)]
            learnt = dict(zip(dict.fromkeys(p for _, p in pieces), self._ids(list(dict.fromkeys(p for _, p in pieces))), strict=True))
            parts: dict[int, list[bytes]] = {n: [] for n, _ in whole}
            for n, p in pieces:
                parts[n].append(learnt[p])
            for n, found in parts.items():
                out[n] = b"".join(found)
        return out

    def _regular(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without white space in a row. Each distinct chunk is looked up once for all of them."""
        if not texts:
            return []
        spaced = [text.replace("\n", " \n") for text in texts]
        cuts = np.cumsum([0, *(text.count(" ") + 1 for text in spaced)])
        coded = pc.split_pattern(pa.array([" ".join(spaced)], pa.large_string()), " ").values.dictionary_encode()
        keys, number = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        # A text's first chunk has no space before it.
        number[cuts[:-1]] = len(keys) + np.arange(len(texts))
        rows = self._looked_up(keys, np.bincount(number, minlength=len(keys))[: len(keys)])
        ids, sizes = _flat(self._ids([text.split(" ", 1)[0] for text in spaced]))
        rows = np.append(rows, self._add(ids, sizes))
        starts, sizes = self._ends[rows], self._ends[rows + 1] - self._ends[rows]
        ids = _stretches(self._pool, starts, sizes)  # the distinct chunks' alone
        self._rows = self._lasting
        n = sizes[number]
        at = (4 * np.append(0, np.cumsum(n))[cuts]).tolist()
        raw = _stretches(ids, (np.cumsum(sizes) - sizes)[number], n).tobytes()
        return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Puts chunks' ids after those that are held; their rows."""
        first, end = self._rows, int(self._ends[self._rows])
        self._pool = _roomy(self._pool, end + len(ids) + 1)
        self._pool[end : end + len(ids)] = ids
        self._rows += len(sizes)
        self._ends = _roomy(self._ends, self._rows + 1)
        self._ends[first + 1 : self._rows + 1] = end + np.cumsum(sizes)
        return np.arange(first, self._rows)

    def _looked_up(self, keys: list[str], used: np.ndarray) -> np.ndarray:
        """The rows of distinct chunks after a space, the empty row for those that are not used; new ones are learnt."""
        known, marks = self._known, self._mark
        rows = np.fromiter(map(known.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero((rows < 0) & (used > 0))
        rows[rows < 0] = 0
        if not len(missing):
            return rows
        words = [keys[i] for i in missing.tolist()]
        # A long chunk is rare by itself and would fill the memory.
        long = np.fromiter(map(len, words), np.int64, len(words)) > LONG
        marked = np.array([w[-1] in marks and w[-2:-1].isalpha() for w in words], bool) & ~long
        plain = [w for w, no in zip(words, (marked | long).tolist(), strict=True) if not no]
        ends = [w for w, yes in zip(words, marked.tolist(), strict=True) if yes]
        before = [known.get(w[:-1], -1) for w in ends]
        new = dict.fromkeys(plain)
        new.update((w[:-1], None) for w, row in zip(ends, before, strict=True) if row < 0)
        learnt = self._add(*self._learn(list(new)))
        rows[missing[~(marked | long)]] = learnt[: len(plain)]
        names = [*new, *ends]
        if ends:
            place = dict(zip(new, learnt.tolist(), strict=True))
            base = np.array([place[w[:-1]] if row < 0 else row for w, row in zip(ends, before, strict=True)], np.int64)
            sizes = self._ends[base + 1] - self._ends[base] + 1
            ids = _stretches(self._pool, self._ends[base], sizes)
            ids[np.cumsum(sizes) - 1] = [marks[w[-1]] for w in ends]
            rows[missing[marked]] = self._add(ids, sizes)
        room = min(len(names), max(0, self._room - len(known)))
        known.update(zip(names[:room], range(self._lasting, self._lasting + room), strict=True))
        self._lasting += room
        if long.any():
            rows[missing[long]] = self._add(*self._learn([w for w, yes in zip(words, long.tolist(), strict=True) if yes]))
        return rows

    def chunks(self, text: str) -> list[str]:
        """A text with white space in a row, or at its ends, in chunks; one with a special string is one chunk."""
        if any(s in text for s in self._special):
            return [text]
        out: list[str] = []
        for i, piece in enumerate(text.split(" ")):
            if i == 0:
                out.append(piece)
            elif piece and not piece[0].isspace():
                out.append(" " + piece)
            elif out:
                out[-1] += " " + piece
        return out
