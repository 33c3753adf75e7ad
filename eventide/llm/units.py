"""Cut texts into units that a byte-level BPE tokenizer encodes independently of each other.

The public pre-tokenizer pattern never joins a word with what stands before the one space in front of it. So a
word with its space is a unit: its pre-tokens are those of the unit alone. White space before that gives units
as the pattern does: all but the last character of a run, then the last one unless it is a space before a word.
"""

from __future__ import annotations

import re

import numpy as np

from eventide.llm.arrow import Piece, Words, words

#: White space beyond ASCII, as the pattern's \s has it. Texts with it are cut by the pattern itself.
WIDE_SPACE = re.compile("[\x85\xa0  -     　]")
_WIDE_FIRST = np.zeros(256, bool)
_WIDE_FIRST[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def units(piece: Piece, pattern) -> Words:
    """The units of each document, as byte ranges that cover it; `pattern` is the compiled pre-tokenizer."""
    found = words(piece)
    n = len(found.starts)
    owner = found.owners()
    gap = np.concatenate([[0], found.ends[:-1]]) if n else np.empty(0, np.int64)
    gap = np.maximum(gap, piece.offsets[owner])  # where the white space before the word starts
    length = found.starts - gap
    joined = (length > 0) & (piece.data[found.starts - 1] == 0x20)
    body = found.starts - joined
    split = np.where(length > 0, found.starts - 1, found.starts)
    # What is left after the last word of a document, or all of one without words.
    tail = piece.offsets[:-1].copy()
    has = found.counts > 0
    tail[has] = found.ends[found.first[1:][has] - 1]
    starts = np.concatenate([np.stack([gap, split, body], 1).ravel(), tail])
    ends = np.concatenate([np.stack([split, body, found.ends], 1).ravel(), piece.offsets[1:]])
    some = ends > starts
    starts, ends = starts[some], ends[some]
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    wide = [i for i in _maybe_wide(piece) if WIDE_SPACE.search(piece.text(i))]
    if wide:
        starts, ends = _recut(piece, starts, ends, wide, pattern)
    return Words(starts, ends, np.searchsorted(starts, piece.offsets))


def _maybe_wide(piece: Piece) -> np.ndarray:
    """Documents with the first two bytes of a wide white space character."""
    at = np.flatnonzero(_WIDE_FIRST[piece.data[:-1]])
    a, b = piece.data[at], piece.data[at + 1]
    hit = (
        ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
        | ((a == 0xE1) & (b == 0x9A))
        | ((a == 0xE2) & ((b == 0x80) | (b == 0x81)))
        | ((a == 0xE3) & (b == 0x80))
    )
    return np.unique(np.searchsorted(piece.offsets, at[hit], "right") - 1)


def _recut(piece: Piece, starts, ends, wide: list[int], pattern) -> tuple[np.ndarray, np.ndarray]:
    """Replace the units of some documents by the pre-tokens that the pattern finds."""
    home = np.searchsorted(piece.offsets, starts, "right") - 1
    keep = ~np.isin(home, wide)
    new_starts, new_ends = [starts[keep]], [ends[keep]]
    for i in wide:
        sizes = [len(x.encode("utf-8")) for x in pattern.findall(piece.text(i))]
        stops = piece.offsets[i] + np.cumsum(np.array(sizes, np.int64))
        new_starts.append(stops - sizes)
        new_ends.append(stops)
    starts, ends = np.concatenate(new_starts), np.concatenate(new_ends)
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


class TwoGenerations:
    """A bounded map that keeps what is used often: at most twice `most` entries.

    New and used entries are in the young half; when it is full, it becomes the old one, and what was not
    used since then is forgotten.
    """

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[key] = value


class UnitCache:
    """What a worker knows of units, by their 64-bit hashes; bounded.

    Units longer than `longest` bytes are passed to `encode` whenever they come, and not kept.
    """

    def __init__(self, most: int = 250_000, longest: int = 64):
        self.longest, self.known = longest, TwoGenerations(most)

    def look_up(self, piece: Piece, found: Words, hashes: np.ndarray, encode) -> tuple[list, np.ndarray]:
        """Values of the distinct units, and for each unit the index of its value. `encode` takes bytes."""
        distinct, at, where = np.unique(hashes, return_index=True, return_inverse=True)
        values = list(map(self.known.get, distinct.tolist()))
        missing = [i for i, v in enumerate(values) if v is None]
        ranges = [(int(found.starts[at[i]]), int(found.ends[at[i]])) for i in missing]
        new = encode([piece.data[a:b].tobytes() for a, b in ranges]) if missing else []
        for i, (a, b), value in zip(missing, ranges, new, strict=True):
            values[i] = value
            if b - a <= self.longest:
                self.known.put(int(distinct[i]), value)
        return values, where


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices of many ranges, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


class FlatCache:
    """Lists of numbers by 64-bit hashes in a few flat arrays: some 20 bytes for an entry and four for a number.

    `trim` keeps at most `most` entries: of those that were looked up since the last time, then any. Lists of more
    than `longest` numbers are forgotten by it.
    """

    def __init__(self, most: int, longest: int = 32):
        self.most, self.longest = most, longest
        self.hashes, self.used = np.empty(0, np.uint64), np.empty(0, bool)
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int32)
        self.numbers = np.empty(0, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 where there is none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        self.used[at[known]] = True
        return np.where(known, at, -1)

    def add(self, hashes: np.ndarray, counts: np.ndarray, numbers: np.ndarray) -> None:
        """New entries, with their lists end to end."""
        starts = np.cumsum(counts) - counts + len(self.numbers)
        order = np.argsort(np.concatenate([self.hashes, hashes]), kind="stable")
        for name, new in (("hashes", hashes), ("starts", starts), ("counts", counts), ("used", np.ones(len(hashes), bool))):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, new.astype(old.dtype)])[order])
        self.numbers = np.concatenate([self.numbers, numbers.astype(np.int32)])

    def take(self, entries: np.ndarray) -> np.ndarray:
        """The lists of some entries, end to end."""
        return self.numbers[spread(self.starts[entries], self.counts[entries].astype(np.int64))]

    def trim(self) -> None:
        keep = self.counts <= self.longest
        if len(self.hashes) <= self.most and keep.all():
            return
        if int(keep.sum()) > self.most:
            keep &= self.used
            self.used[:] = False
        entries = np.flatnonzero(keep)[: self.most]
        numbers = self.take(entries)
        self.hashes, self.used = self.hashes[entries], self.used[entries]
        self.counts = self.counts[entries]
        self.starts = np.cumsum(self.counts, dtype=np.int64) - self.counts
        self.numbers = numbers
