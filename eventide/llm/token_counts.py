"""Token counts by a map-side two-tier lookup (operator 7).

Tier one is a compact table of the token counts of the corpus's frequent units (a word with the space before
it), sent to every executor. Tier two is a bounded cache in each Python worker; what it does not know is encoded
by the tokenizer's library. No unit is shuffled by either tier. The table is chosen from counts over all
documents, which each task cuts to its own `per_task` most frequent units before they are added up.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from eventide.llm.arrow import FIRST, Piece, Words, pieces, sums
from eventide.llm.bpe import shared_file, worker_path
from eventide.llm.frames import map_batches, two_columns
from eventide.llm.units import UnitCache, units

SCHEMA = "doc_id long, n_bytes long, n_tokens long"
LONGEST = 32  # bytes of a unit in the table


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@lru_cache(maxsize=2)
def _special(path: str) -> list[bytes]:
    """Strings that the library cuts out of a text before anything else."""
    return [t.content.encode() for t in _tokenizer(path).get_added_tokens_decoder().values()]


@lru_cache(maxsize=2)
def _cache(path: str) -> UnitCache:
    return UnitCache(400_000)


@lru_cache(maxsize=2)
def _pattern(pattern: str):
    return regex.compile(pattern)


def _lengths(path: str, texts: list[str]) -> list[int]:
    found = _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    return [len(e.ids) for e in found]


def frequent_units(docs: DataFrame, pattern: str, size: int, per_task: int) -> list[bytes]:
    """At most `size` frequent units of all documents, the most frequent first. The driver holds no more.

    Every document is counted. A task keeps the `per_task` most frequent units of each batch; the choice
    decides what is fast, never what is counted.
    """

    def work(batch: pa.RecordBatch):
        pre_tokens = _pattern(pattern)
        for piece in pieces(batch.column(0), 1 << 23):
            found = units(piece, pre_tokens)
            short = found.ends - found.starts <= LONGEST
            starts, ends = found.starts[short], found.ends[short]
            hashes = FIRST.ranges(piece.data, starts, ends)
            _, at, times = np.unique(hashes, return_index=True, return_counts=True)
            top = np.argsort(-times, kind="stable")[:per_task]
            texts = [piece.data[starts[i] : ends[i]].tobytes() for i in at[top].tolist()]
            yield {"unit": texts, "times": times[top]}

    counted = map_batches(docs.select("text"), "unit binary, times long", work)
    total = counted.groupBy("unit").agg(F.sum("times").alias("times"))
    best = total.orderBy(F.desc("times"), "unit").limit(size)
    return [bytes(r.unit) for r in best.collect()]


def count_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_size: int = 65_536,
    per_task: int = 4_096,
) -> DataFrame:
    """Bytes and tokens of every whole text; one row per row of `docs`.

    `path` is a byte-level tokenizer of the `tokenizers` library, `pattern` its pre-tokenizer. Added tokens in
    a text count as the library has it. A NULL text counts as empty, rows that repeat are counted one by
    one, an empty table gives an empty result, and only the two named columns are read. The table has at
    most `table_size` hashes and lengths, ten bytes each.
    """
    spark = docs.sparkSession
    texts = two_columns(docs, id_col, text_col)
    known = frequent_units(texts, pattern, table_size, per_task)
    lengths = np.array(_lengths(path, [u.decode() for u in known]), np.uint16)
    ends = np.cumsum([len(u) for u in known], dtype=np.int64)
    starts = ends - np.array([len(u) for u in known], np.int64)
    hashes = FIRST.ranges(np.frombuffer(b"".join(known), np.uint8), starts, ends)
    order = np.argsort(hashes)
    table = spark.sparkContext.broadcast((hashes[order], lengths[order]))
    name = shared_file(spark, path)

    def work(batch: pa.RecordBatch):
        local = worker_path(name)
        for piece in pieces(batch.column(1)):
            yield {
                "doc_id": batch.column(0).slice(piece.row, len(piece)),
                "n_bytes": np.diff(piece.offsets),
                "n_tokens": _count(piece, local, pattern, *table.value),
            }

    return map_batches(texts, SCHEMA, work)


def _count(piece: Piece, path: str, pattern: str, keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    found = units(piece, _pattern(pattern))
    hashes = FIRST.ranges(piece.data, found.starts, found.ends)
    counts = np.zeros(len(hashes), np.int64)
    first_tier = np.zeros(len(hashes), bool)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        first_tier = keys[at] == hashes
        counts[first_tier] = lengths[at[first_tier]]
    rest = np.flatnonzero(~first_tier)
    misses = Words(found.starts[rest], found.ends[rest], found.first)
    values, where = _cache(path).look_up(
        piece, misses, hashes[rest], lambda new: _lengths(path, [u.decode() for u in new])
    )
    counts[rest] = np.array(values, np.int64)[where] if values else 0
    total = sums(counts, found.first)
    whole = piece.data.tobytes()
    for special in _special(path):  # texts with added tokens are left to the library
        if special in whole:
            own = [i for i in range(len(piece)) if special in piece.data[piece.offsets[i] : piece.offsets[i + 1]].tobytes()]
            total[own] = _lengths(path, [piece.text(i) for i in own])
    return total
