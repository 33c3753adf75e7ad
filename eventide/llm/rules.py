"""Quality rules by repetition coverage (operator 10).

Rolling hashes of several n-gram lengths mark every word inside an n-gram that occurs twice or more in its
document; the marked characters over all word characters are the coverage. Lines that repeat an earlier line are
measured alike. All documents of a piece are hashed and sorted together in numpy; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventide.llm.arrow import FIRST, Piece, code_points, lines, mix, pieces, repeated, sums, whole_runs, words
from eventide.llm.frames import map_batches, two_columns

SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_share double, repeat_shares array<double>"
)


@dataclass(frozen=True)
class Limits:
    """A document is dropped if a share of its characters exceeds its limit.

    `ngrams` maps an n-gram length, five at least, to the largest share of word characters that may lie in
    n-grams found twice or more; `dup_lines` is the largest share in lines equal to an earlier one.
    """

    ngrams: dict[int, float] = field(
        default_factory=lambda: {5: 0.30, 6: 0.29, 7: 0.28, 8: 0.27, 9: 0.26, 10: 0.25}
    )
    dup_lines: float = 0.30
    min_words: int = 10
    max_repeat_percent: int = 20


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits | None = None
) -> DataFrame:
    """Measures and verdict, one row per row of `docs`, in any order.

    A NULL or empty text has no words and fails for too few. Rows that repeat are judged one by one, a NULL
    id stays NULL, an empty table gives an empty result, and only the two named columns are read.
    `repeat_shares` has the coverage for each n-gram length of the limits, in rising order.
    """
    limits = limits or Limits()
    if min(limits.ngrams) < 5:
        raise ValueError("n-gram lengths start at 5")

    def work(batch: pa.RecordBatch):
        for piece in pieces(batch.column(1)):
            ids = batch.column(0).slice(piece.row, len(piece))
            yield {"doc_id": ids, **measure(piece, limits)}

    return map_batches(two_columns(docs, id_col, text_col), SCHEMA, work)


def measure(piece: Piece, limits: Limits) -> dict:
    found = words(piece)
    before = code_points(piece)
    n_words = found.counts
    chars = before[found.ends] - before[found.starts]
    word_chars = sums(chars, found.first)
    symbols = np.isin(piece.data, np.frombuffer(SYMBOLS, np.uint8))
    covered = _covered(piece, found, sorted({5, *limits.ngrams}))
    n_repeat = sums(covered[5], found.first)
    n_dup_lines, dup_chars, all_chars = _lines(piece, found, before)
    line_share = dup_chars / np.maximum(all_chars, 1)
    shares = np.stack(
        [sums(chars * covered[n], found.first) / np.maximum(word_chars, 1) for n in sorted(limits.ngrams)], 1
    )
    failed = (n_words < limits.min_words) | (100 * n_repeat > limits.max_repeat_percent * n_words)
    most = np.array([limits.ngrams[n] for n in sorted(limits.ngrams)])
    kept = ~failed & (line_share <= limits.dup_lines) & (shares <= most).all(1)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": sums(symbols, piece.offsets),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "kept": kept,
        "dup_line_share": line_share,
        "repeat_shares": list(shares),
    }


def _covered(piece: Piece, found, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each n: the words inside an n-gram that its document has twice or more."""
    hashes = FIRST.ranges(piece.data, found.starts, found.ends)
    owners = found.owners().astype(np.uint64)
    out, open_at = {}, None
    for n in lengths:
        at = whole_runs(found, n)
        if open_at is not None:  # a longer n-gram repeats only where a shorter one does
            at = at[open_at[at]]
        rolled = FIRST.ranges(hashes, at, at + n) if len(at) else np.empty(0, np.uint64)
        several, _ = repeated(mix(rolled + owners[at] * np.uint64(0x9E3779B97F4A7C15)))
        starts = at[several]
        change = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + n, -1)
        out[n] = np.cumsum(change)[:-1] > 0
        open_at = np.zeros(len(hashes), bool)
        open_at[starts] = True
    return out


def _lines(piece: Piece, found, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: lines with a word that equal an earlier line, their characters, those of all such lines."""
    starts, ends, owner, _ = lines(piece)
    with_word = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends, owner = starts[with_word], ends[with_word], owner[with_word]
    hashes = FIRST.ranges(piece.data, starts, ends)
    _, later = repeated(mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    first = np.searchsorted(owner, np.arange(len(piece) + 1))
    size = before[ends] - before[starts]
    return sums(later, first), sums(size * later, first), sums(size, first)
