"""Substring deduplication by repeated-phrase automata (operator 8).

Every window of `window` words has an anchor: of the phrases of three tenths as many words inside it, the one of
smallest hash. Equal windows have equal anchors, so only windows whose anchor occurs elsewhere can repeat. A phrase is
written as the codes of its words, 16 bits each.

1. Whole texts that equal an earlier one are set aside; all their words go, if there are enough for a window.
2. Anchors of all other documents are counted; those found twice or more are the recurring phrases.
3. Documents are dealt into shards of a MB. A shard gets those recurring phrases that are anchors in one of its
   documents and compiles them into an Aho-Corasick automaton; the shard's documents, as word codes, stream through
   it, which locates every occurrence. So a document is read by one automaton only, whatever the number of phrases.
4. Windows whose anchor was located are compared by 128-bit hashes over all shards, which leaves the first
   document of each, and the words of all later occurrences are removed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import compress, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from eventide.llm.arrow import FIRST, SECOND, Piece, Words, pieces, whole_runs, words
from eventide.llm.frames import Bitmap, Scratch, map_batches, two_columns
from eventide.storage import materialize

SHARD_BYTES = 1 << 20
KEY = ["place", "mark"]
#: Open windows of a text: first words, whether the text has an equal one before, and two hashes.
WINDOWS = "place long, mark long, starts array<int>, seen array<boolean>, a array<long>, b array<long>"
WINDOWS_COLUMNS = [*KEY, "starts", "seen", "a", "b"]
RESULT = "doc_id long, n_words long, n_removed long, kept string"
#: Rows without an id have places in the last 2^56, by their texts.
_LAST = (1 << 63) - 1


@dataclass
class Anchored:
    """Windows of a piece: their first words, and the first word of the anchor of each."""

    found: Words
    hashes: np.ndarray
    windows: np.ndarray
    anchors: np.ndarray

    def codes(self) -> np.ndarray:
        """16 bits of the hash of each word."""
        return (self.hashes >> np.uint64(48)).astype(np.uint16)

    def phrases(self, at: np.ndarray, size: int) -> np.ndarray:
        """The phrases that begin at some words, a row of codes each."""
        return self.codes()[at[:, None] + np.arange(size)]


def phrase_words(window: int) -> int:
    return max(1, window * 3 // 10)


def anchored(piece: Piece, window: int) -> Anchored:
    size = phrase_words(window)
    found = words(piece)
    hashes = FIRST.ranges(piece.data, found.starts, found.ends)
    windows = whole_runs(found, window)
    phrases = FIRST.runs(hashes, size)
    if not len(windows):
        return Anchored(found, hashes, windows, windows)
    inside = np.lib.stride_tricks.sliding_window_view(phrases, window - size + 1)
    anchors = windows + inside.argmin(1)[windows]
    return Anchored(found, hashes, windows, anchors)


def _shard(shards: int):
    return F.pmod(F.xxhash64(*KEY), F.lit(shards)).cast("int")


def _anchor_rows(texts: DataFrame, window: int) -> DataFrame:
    """(phrase, shard, times): each anchor of each shard in each piece."""
    size = phrase_words(window)

    def work(batch: pa.RecordBatch):
        home = batch.column(1).to_numpy()
        for piece in pieces(batch.column(0)):
            own = anchored(piece, window)
            at = np.unique(own.anchors)
            rows = np.empty((len(at), 2 * size + 4), np.uint8)
            rows[:, : 2 * size] = own.phrases(at, size).view(np.uint8)
            rows[:, 2 * size :] = home[piece.row + own.found.owners()[at]].astype(np.int32).view(np.uint8).reshape(-1, 4)
            rows = np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel()
            _, one, times = np.unique(rows, return_index=True, return_counts=True)
            phrases = own.phrases(at[one], size)
            cuts = pa.py_buffer((np.arange(len(one) + 1, dtype=np.int32) * (2 * size)).tobytes())
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(one), [None, cuts, pa.py_buffer(phrases.tobytes())])
            shard = home[piece.row + own.found.owners()[at[one]]]
            yield {"phrase": packed, "shard": shard, "times": times.astype(np.int32)}

    return map_batches(texts.select("text", "shard"), "phrase binary, shard int, times int", work)


class PhraseAutomaton:
    """Phrases of words as an automaton over the 16-bit codes of words.

    A word is written as the four hexadecimal digits of its code. Digits of each position have symbols of their
    own, so a phrase is found at words only; and a state has few followers, which the automaton tries in turn.
    """

    DIGITS = 4

    def __init__(self, phrases: np.ndarray):
        """`phrases` has a row of codes for each."""
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        self.size = phrases.shape[1]
        text, step = self._written(phrases), self.size * self.DIGITS
        for at in range(0, len(text), step):
            self.automaton.add_word(text[at : at + step])
        if len(self.automaton):
            self.automaton.make_automaton()

    def _written(self, codes: np.ndarray) -> str:
        symbols = np.empty((codes.size, self.DIGITS), np.uint8)
        for i in range(self.DIGITS):
            symbols[:, i] = (codes.ravel() >> np.uint16(4 * i) & np.uint16(15)) + 16 * i + 1
        return symbols.tobytes().decode("latin-1")

    def locate(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each word of some documents, whether a phrase begins there; `first` is the first word of each."""
        hit = np.zeros(len(codes), bool)
        if not len(self.automaton):
            return hit
        text = self._written(codes)
        for a, b in pairwise(first.tolist()):
            if b - a >= self.size:
                found = self.automaton.iter(text, a * self.DIGITS, b * self.DIGITS)
                ends = np.fromiter((end for end, _ in found), np.int64)
                hit[(ends + 1) // self.DIGITS - self.size] = True
        return hit


def _one_piece(column: pa.ChunkedArray) -> Piece:
    whole = list(pieces(column.combine_chunks(), 1 << 62))
    return whole[0] if whole else Piece(0, np.empty(0, np.uint8), np.zeros(1, np.int64))


def _locate(docs: pa.Table, phrases: pa.Table, window: int) -> pa.Table:
    """The windows of one shard's documents whose anchor is a recurring phrase."""
    size = phrase_words(window)
    piece = _one_piece(docs["text"])
    own = anchored(piece, window)
    packed = b"".join(phrases["phrase"].to_pylist())
    automaton = PhraseAutomaton(np.frombuffer(packed, np.uint16).reshape(-1, size))
    open_at = own.windows[automaton.locate(own.codes(), own.found.first)[own.anchors]]
    del automaton
    second = SECOND.ranges(piece.data, own.found.starts, own.found.ends)
    a = FIRST.ranges(own.hashes, open_at, open_at + window).view(np.int64)
    b = SECOND.ranges(second, open_at, open_at + window).view(np.int64)
    owner = own.found.owners()[open_at]
    # In its own document, only the first of equal windows can be the first of all.
    order = np.lexsort((b, a, owner))
    seen = np.zeros(len(a), bool)
    x, y = order[1:], order[:-1]
    seen[x] = (owner[x] == owner[y]) & (a[x] == a[y]) & (b[x] == b[y])
    cuts = np.searchsorted(owner, np.arange(len(piece) + 1)).astype(np.int32)
    some = pa.array(np.diff(cuts) > 0)
    starts = (open_at - own.found.first[owner]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (starts, seen, a, b)]
    names = WINDOWS_COLUMNS
    columns = [docs[k].combine_chunks() for k in KEY] + lists
    return pa.table(dict(zip(names, columns, strict=True))).filter(some)


def _windows(texts: DataFrame, window: int, shard_bytes: int, write) -> DataFrame:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = texts.withColumn("shard", _shard(int(size // shard_bytes) + 1))
    rows = _anchor_rows(dealt, window)
    recurring = rows.groupBy("phrase").agg(F.sum("times").alias("times")).where("times > 1").select("phrase")
    recurring = write(recurring, "substring-recurring")
    phrases = rows.select("phrase", "shard").join(recurring, "phrase", "left_semi").distinct()
    schema = texts.sparkSession.createDataFrame([], WINDOWS).schema
    arrow = to_arrow_schema(schema)
    both = dealt.select(*KEY, "text", "shard").groupBy("shard").cogroup(phrases.groupBy("shard"))
    return both.applyInArrow(lambda x, y: _locate(x, y, window).cast(arrow), schema)


def _later(batch: pa.RecordBatch, window: int):
    """Words to remove: those of windows that another document, or an earlier place of this one, has first.

    `gone` has the first word and the one after the last of each run of them.
    """
    starts, seen, a, b = (batch.column(i) for i in range(2, 6))
    edges = starts.offsets.to_numpy().astype(np.int64)
    edges, low = edges - edges[0], edges[0]
    n = int(edges[-1])
    begin = starts.values.to_numpy()[low : low + n]
    seen = seen.values.to_numpy(zero_copy_only=False)[low : low + n]
    doc = np.repeat(np.arange(len(batch)), np.diff(edges))
    first = batch.column(6)  # hashes of windows that this document is the first to have
    own = first.flatten()
    sizes = np.array([0 if x is None else x for x in first.value_lengths().to_pylist()], np.int64)
    own_doc = np.repeat(np.arange(len(batch)), sizes)
    own_a, own_b = (own.field(k).to_numpy() for k in ("a", "b"))
    # A window is first if its document and hashes are among these, which sort before it.
    docs = np.concatenate([own_doc, doc])
    both_a = np.concatenate([own_a, a.values.to_numpy()[low : low + n]])
    both_b = np.concatenate([own_b, b.values.to_numpy()[low : low + n]])
    order = np.lexsort((np.arange(len(docs)), both_b, both_a, docs))
    new = np.ones(len(order), bool)
    x, y = order[1:], order[:-1]
    new[1:] = (docs[x] != docs[y]) | (both_a[x] != both_a[y]) | (both_b[x] != both_b[y])
    leads = order < len(own_doc)  # the group begins with one of the document's own
    known = np.empty(len(order), bool)
    known[order] = leads[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else leads
    later = seen | ~known[len(own_doc) :]
    begin, doc = begin[later], doc[later]
    # Windows come in order; a run ends where the next one does not touch it.
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (begin[1:] > begin[:-1] + window)
    last = np.append(fresh[1:], True) if len(fresh) else fresh
    runs = np.stack([begin[fresh], begin[last] + window], 1).ravel().astype(np.int32)
    cuts = 2 * np.searchsorted(doc[fresh], np.arange(len(batch) + 1))
    gone = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(runs))
    keep = pa.array(np.diff(cuts) > 0)
    yield {"place": batch.column(0).filter(keep), "mark": batch.column(1).filter(keep), "gone": gone.filter(keep)}


def _copies(texts: DataFrame, write) -> tuple[DataFrame, DataFrame]:
    """The texts to search, each once, and the keys of those that equal the text of a smaller place."""
    names = texts.where("text is not null").select(*KEY, F.unhex(F.md5("text")).alias("name"))
    names = write(names, "substring-names")
    first = names.groupBy("name").agg(F.min("place").alias("first"), F.count("*").alias("times"))
    first = write(first.where("times > 1").select("name", "first"), "substring-firsts")
    several = names.join(first, "name").groupBy(*KEY).agg(
        F.max(F.col("place") > F.col("first")).alias("copy"), F.count("*").alias("rows")
    )
    several = write(several.where("copy or rows > 1").select(*KEY, "copy"), "substring-several")
    maybe = Bitmap(several.select(F.xxhash64(*KEY))).has(F.xxhash64(*KEY))
    some = write(texts.where(maybe).join(several, KEY, "left"), "substring-some")
    once = some.where("not copy").drop("copy").dropDuplicates(KEY)  # rows that repeat are searched once
    left = texts.where(~maybe).unionByName(some.where("copy is null").drop("copy")).unionByName(once)
    return left.where("text is not null"), several.where("copy").select(*KEY)


def dedup_substrings(
    docs: DataFrame,
    window: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed, and `kept`, the words that are left joined by one space.

    A window of `window` words is repeated if its words also stand at a smaller (doc_id, start); a word that
    such a window covers is removed. Windows are judged on the texts as they come, not on what is left. With
    `digest`, `kept` is the SHA-256 of the words in its place.

    One row per row of `docs`. A NULL text has no words. Rows of one id count as one document and do not
    repeat each other. Rows without an id come after all others, ordered by a hash of the text, those of equal text
    as one document (ids among the last 2^56 numbers are not told apart from them). An empty table gives an empty result, and only
    the two named columns are read.
    """

    def finish(kept: list[bytes]) -> str:
        body = b" ".join(kept)
        return hashlib.sha256(body).hexdigest() if digest else body.decode("utf-8", "replace")

    scratch = Scratch(docs.sparkSession)
    texts = two_columns(docs, id_col, text_col)
    texts = texts.withColumn("mark", F.xxhash64("text"))
    unnamed = F.lit(_LAST) - F.shiftrightunsigned("mark", 8)
    texts = texts.withColumn("place", F.coalesce("doc_id", unnamed))
    left, copies = _copies(texts.select(*KEY, "text"), scratch.write)
    windows = scratch.write(_windows(left, window, shard_bytes, scratch.write), "substring-windows")
    # In a document only the first of equal windows can be the first of all.
    mine = F.filter(F.arrays_zip("a", "b", "seen"), lambda x: ~x["seen"])
    each = windows.select("place", F.explode(mine).alias("w")).select("place", "w.a", "w.b")
    first = scratch.write(each.groupBy("a", "b").agg(F.min("place").alias("place")), "substring-first")
    first = first.groupBy("place").agg(F.collect_list(F.struct("a", "b")).alias("first"))  # as many as its windows
    some = windows.join(first, "place", "left").select(*WINDOWS_COLUMNS, "first")
    gone = map_batches(some, "place long, mark long, gone array<int>", lambda batch: _later(batch, window))
    whole = copies.withColumn("gone", F.array().cast("array<int>"))  # nothing listed: all of it
    gone = materialize(gone.unionByName(whole), "substring-gone")
    scratch.clear()

    def cut(batch: pa.RecordBatch):
        listed = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(batch)
        n_words, n_removed, kept = [], [], []
        for text, runs in zip(batch.column(1).to_pylist(), listed, strict=True):
            own = (text or "").encode().split()
            n = len(own)
            if runs is not None and not runs:  # a copy goes as a whole, if it has a window
                runs = [0, n] if n >= window else None
            left_over = own
            if runs:
                keep = np.ones(n, bool)
                for a, b in zip(runs[::2], runs[1::2], strict=True):
                    keep[a:b] = False
                left_over = list(compress(own, keep))
            n_words.append(n)
            n_removed.append(n - len(left_over))
            kept.append(finish(left_over))
        yield {"doc_id": batch.column(0), "n_words": n_words, "n_removed": n_removed, "kept": kept}

    maybe = Bitmap(gone.select(F.xxhash64(*KEY))).has(F.xxhash64(*KEY))
    shortened = texts.where(maybe).join(gone, KEY, "left").select("doc_id", "text", "gone")
    rest = map_batches(texts.where(~maybe).select("doc_id", "text"), RESULT, cut)
    return rest.unionByName(map_batches(shortened, RESULT, cut))
