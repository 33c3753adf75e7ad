"""Text columns as numpy buffers: cut Arrow batches into bounded pieces and find words and their hashes.

A word is a run of bytes other than space and the control characters 9 to 13. All work is done for a whole
piece at once. A piece holds some documents, about `PIECE_BYTES` together; a longer document is a piece of
its own and is hashed block by block, so memory follows the longest document, not the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
BLOCK = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Polynomial hashes of many ranges of one symbol array, by one running sum per block."""

    def __init__(self, seed: int):
        self._seed = np.uint64(seed)
        self._table = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed * 1000 + 1))
        self._base = int(mix(np.array([seed], np.uint64))[0]) & ~0x7 | 0x5  # odd, so it has an inverse
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) > n:
            return
        inverse = pow(self._base, -1, 1 << 64)
        for name, base in (("_powers", self._base), ("_inverse", inverse)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def _values(self, symbols: np.ndarray) -> np.ndarray:
        if symbols.dtype == np.uint8:
            return self._table[symbols]
        return mix(symbols.astype(np.uint64) + self._seed)

    def ranges(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of symbols[start:end] for each range; ranges ordered by start, and short or disjoint."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            low = int(starts[at])
            stop = max(at + 1, int(np.searchsorted(starts, low + BLOCK)))
            high = int(ends[at:stop].max())
            n = high - low
            self._grow(n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self._values(symbols[low:high]) * self._powers[:n], out=sums[1:])
            a, b = starts[at:stop] - low, ends[at:stop] - low
            out[at:stop] = (sums[b] - sums[a]) * self._inverse[a]
            at = stop
        return mix(out)

    def runs(self, values: np.ndarray, n: int) -> np.ndarray:
        """A hash of each run of n consecutive values; len(values) - n + 1 of them."""
        if len(values) < n:
            return np.empty(0, np.uint64)
        starts = np.arange(len(values) - n + 1)
        return self.ranges(values, starts, starts + n)


FIRST, SECOND = Hasher(11), Hasher(23)


@dataclass
class Piece:
    """Some documents of a batch: rows [row, row + len(offsets) - 1), their bytes end to end."""

    row: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8", "replace")


def pieces(column: pa.Array | pa.ChunkedArray, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of a string column; NULL counts as empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for chunk in chunks:
        chunk = chunk.cast(pa.large_binary())
        if chunk.null_count:
            chunk = chunk.fill_null(b"")
        if not len(chunk):
            continue
        _, ends, body = chunk.buffers()
        offsets = np.frombuffer(ends, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        body = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
        at = 0
        while at < len(chunk):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            own = offsets[at : stop + 1]
            yield Piece(row + at, body[own[0] : own[-1]], own - own[0])
            at = stop
        row += len(chunk)


@dataclass
class Words:
    """Words of a piece: byte ranges, and per document the index of its first word (len + 1 entries)."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(piece: Piece) -> Words:
    space = _SPACE[piece.data]
    n = len(space)
    edge = np.zeros(n + 1, bool)
    edge[piece.offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], before[1:] = True, space[:-1]
        after[-1], after[:-1] = True, space[1:]
    starts = np.flatnonzero(~space & (before | edge[:n]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, piece.offsets))


def lowered(piece: Piece) -> Piece:
    """With A-Z as a-z."""
    return Piece(piece.row, _LOWER[piece.data], piece.offsets)


def whole_runs(found: Words, n: int) -> np.ndarray:
    """The index of the first word of every run of n words that lies in one document."""
    total = int(found.first[-1])
    if total < n:
        return np.empty(0, np.int64)
    owner = found.owners()
    return np.flatnonzero(owner[n - 1 :] == owner[: total - n + 1])


def code_points(piece: Piece) -> np.ndarray:
    """How many characters begin before each byte; len(data) + 1 entries."""
    before = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum((piece.data & 0xC0) != 0x80, out=before[1:])
    return before


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once, and does an equal one stand before it?"""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    if len(keys):
        same[1:-1] = keys[order][1:] == keys[order][:-1]
    several, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    several[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return several, later


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of values[first[i]:first[i + 1]] for each i."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def lines(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of all lines, cut at line feeds, with the document of each and its number there."""
    breaks = np.flatnonzero(piece.data == 10)
    starts = np.concatenate([piece.offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(len(piece)), np.searchsorted(piece.offsets, breaks, "right") - 1])
    # A break as last byte of a document starts an empty line at the offset of the next one: sort by document.
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    last = np.ones(len(owner), bool)
    last[:-1] = owner[1:] != owner[:-1]
    ends = np.where(last, piece.offsets[owner + 1], np.append(starts[1:], 0) - 1)
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return starts, ends, owner, number


def with_word(piece: Piece, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of these byte ranges hold a byte of a word."""
    before = np.zeros(len(piece.data) + 1, np.int32 if len(piece.data) < 1 << 31 else np.int64)
    np.cumsum(~_SPACE[piece.data], out=before[1:])
    return before[ends] > before[starts]
