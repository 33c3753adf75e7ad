"""Fill-in-the-middle transformation with a Fenwick tree over text blocks (operator 12).

A unit is a word with the white space before it; white space at the end of a text is a unit of its own. Every
text is laid out in blocks of fixed size, and a Fenwick tree holds how many units end and how many code points
begin in each. Binary-lifting descent in it finds the block of a cut together with the code points before that
block; the cut itself is then located inside the block alone. The texts of a piece share one tree, whose blocks
never reach over the end of a text, so a very long text costs as much for each byte as short ones do.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from eventide.llm.arrow import _SPACE, Piece, pieces
from eventide.llm.frames import map_batches, two_columns

BLOCK = 256
#: Cuts that are located at once.
CUTS = 4_096
MARKS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class BlockTree:
    """Fenwick trees of unit ends and code points over the blocks of a piece."""

    def __init__(self, piece: Piece, block: int = BLOCK):
        data, offsets = piece.data, piece.offsets
        lengths = np.diff(offsets)
        some = np.flatnonzero(lengths)
        counts = -(-lengths // block)
        self.block, self.first = block, np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(len(piece)), counts)
        self.starts = offsets[owner] + (np.arange(len(owner)) - self.first[owner]) * block
        self.sizes = np.minimum(block, offsets[owner + 1] - self.starts)
        space = _SPACE[data]
        self.ends = ~space
        self.ends[:-1] &= space[1:]
        self.ends[offsets[some + 1] - 1] = True
        self.points = (data & 0xC0) != 0x80
        self.units_at, self.points_at = self._tree(self.ends), self._tree(self.points)
        self.n = self.below(self.units_at, self.first[1:]) - self.below(self.units_at, self.first[:-1])

    def _tree(self, marks: np.ndarray) -> np.ndarray:
        """Entry i is the sum of the blocks from i without its lowest bit up to i."""
        m = len(self.starts)
        total = np.zeros(m + 1, np.int64)
        if m:
            np.cumsum(np.add.reduceat(marks, self.starts, dtype=np.int64), out=total[1:])
        i = np.arange(m + 1)
        return total - total[i & (i - 1)]

    @staticmethod
    def below(tree: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The sum of the first so many blocks."""
        out, at = np.zeros(len(blocks), np.int64), blocks.copy()
        while at.any():
            out += tree[at]  # entry 0 is nought
            at &= np.maximum(at - 1, 0)
        return out

    def cut(self, docs: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where so many units of a document end: the byte of the piece, and code points of the piece before it."""
        at_byte, at_point = np.empty(len(docs), np.int64), np.empty(len(docs), np.int64)
        for i in range(0, len(docs), CUTS):
            part = slice(i, i + CUTS)
            at_byte[part], at_point[part] = self._cut(docs[part], units[part])
        return at_byte, at_point

    def _cut(self, docs: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = len(self.starts)
        begins = self.first[docs]
        rank = self.below(self.units_at, begins) + units
        block, points = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        step = 1 << m.bit_length() >> 1
        while step:
            to = np.minimum(block + step, m)
            go = (block + step <= m) & (self.units_at[to] < rank)
            rank -= np.where(go, self.units_at[to], 0)
            points += np.where(go, self.points_at[to], 0)
            block += step * go
            step >>= 1
        none = units == 0  # the cut is where the document starts, in whatever block
        block = np.minimum(block, max(m - 1, 0))
        if not m:
            return np.zeros(len(docs), np.int64), points
        inside = np.arange(self.block)
        window = np.minimum(self.starts[block][:, None] + inside, len(self.ends) - 1)
        own = inside < self.sizes[block][:, None]
        last = ((self.ends[window] & own).cumsum(1) >= rank[:, None]).argmax(1)
        points += (self.points[window] & own & (inside <= last[:, None])).sum(1)
        return (
            np.where(none, 0, self.starts[block] + last + 1),
            np.where(none, self.below(self.points_at, begins), points),
        )


def _draws(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers of 32 bits from the seed and the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    rate: int = 50,
    spm: int = 80,
    marks: tuple[str, str, str] = MARKS,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and `output`; one row per row of `docs`.

    Of the documents `rate` in a hundred are transformed, of these `spm` in a hundred to suffix, prefix, middle
    and the others to prefix, suffix, middle, each part after its mark; both cuts are drawn by the seed and
    the id. Other texts, empty ones and those that hold a mark stay as they are: their form is plain, and
    the lengths are NULL. A NULL text counts as empty, a NULL id is drawn for as if it were written as nothing,
    and rows that repeat have the same result. An empty table gives an empty result, and only the two named
    columns are read.
    """
    prefix_mark, suffix_mark, middle_mark = (m.encode() for m in marks)
    texts = two_columns(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    h1, h2, h3, h4 = _draws(seed, F.col("doc_id"))
    marked = reduce(lambda a, b: a | b, [F.col("text").contains(m) for m in marks])
    plain = (F.col("text") == "") | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    drawn = texts.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"), form.alias("form"))

    def work(batch: pa.RecordBatch):
        first, second = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        forms = batch.column(4).to_pylist()
        for piece in pieces(batch.column(1)):
            rows = slice(piece.row, piece.row + len(piece))
            tree, own = BlockTree(piece, block), forms[rows]
            cuts = np.sort([first[rows] % (tree.n + 1), second[rows] % (tree.n + 1)], axis=0)
            some = np.flatnonzero([f != "plain" for f in own])
            # Three cuts of each: where the document starts, and the two that were drawn.
            units = np.stack([np.zeros(len(some), np.int64), cuts[0, some], cuts[1, some]], 1)
            at, points = tree.cut(np.repeat(some, 3), units.ravel())
            at, points = at.reshape(-1, 3), points.reshape(-1, 3)
            at = np.where(units == 0, piece.offsets[some][:, None], at)
            outputs = [None] * len(piece)
            for i, (_, a, b) in zip(some.tolist(), at.tolist(), strict=True):
                begin, end = int(piece.offsets[i]), int(piece.offsets[i + 1])
                prefix, middle, suffix = (piece.data[x:y].tobytes() for x, y in ((begin, a), (a, b), (b, end)))
                if own[i] == "psm":
                    parts = (prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
                else:
                    parts = (suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
                outputs[i] = b"".join(parts)
            for i, x in enumerate(outputs):
                if x is None:
                    outputs[i] = piece.data[piece.offsets[i] : piece.offsets[i + 1]].tobytes()
            lengths = np.zeros((2, len(piece)), np.int64)
            lengths[:, some] = np.diff(points, axis=1).T
            unset = np.ones(len(piece), bool)
            unset[some] = False
            yield {
                "doc_id": batch.column(0).slice(piece.row, len(piece)),
                "n": tree.n,
                "form": own,
                "prefix_chars": pa.array(lengths[0], mask=unset),
                "middle_chars": pa.array(lengths[1], mask=unset),
                "output": outputs,
            }

    return map_batches(drawn, SCHEMA, work)


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from; a transformed text holds no mark, so its parts are told apart."""
    parts = F.split(output, "|".join(map(re.escape, marks)), -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
