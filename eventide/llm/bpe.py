"""Byte-level BPE with a hierarchical-bitmap rank queue (operator 4).

The queue has a bucket for each merge rank, which holds positions of a linked list of symbols. Three levels of
bitmaps say which buckets have entries; find-first-set on each level picks the lowest rank. A merge does not
search for entries it has made invalid: they are skipped when they come up. Each entry is made by one merge
and taken once, so the work on a pre-token follows its length, however long it is. Pre-tokens do not touch each
other, so all that a worker does not know yet of a piece of documents go through one queue together.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from eventide.llm.arrow import FIRST, Words, pieces
from eventide.llm.frames import kept, map_batches, return_free, two_columns
from eventide.llm.units import FlatCache, spread, units

SCHEMA = "doc_id long, ids array<int>, decoded binary"
#: Large pieces give the queue many pre-tokens at once, but take some hundred times their bytes while it works.
PIECE_BYTES = 1 << 19
#: Ids are put together for fewer documents at a time.
PART_BYTES = 1 << 18
#: Units that a worker remembers, some 32 bytes each.
CACHED = 250_000
#: Pre-tokens of more bytes go through the queue one at a time.
LONG = 64
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Linked-list positions in buckets by rank; the bitmaps say which buckets have any."""

    def __init__(self, ranks: int):
        self.low, self.middle, self.top = [0] * ((ranks >> 6) + 1), [0] * ((ranks >> 12) + 1), 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        word, block = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.middle[block] |= 1 << (word & 63)
        self.top |= 1 << block

    def lowest(self) -> int:
        """The lowest rank with a bucket, by find-first-set on each level; -1 when there is none."""
        if not self.top:
            return -1
        block = (self.top & -self.top).bit_length() - 1
        bits = self.middle[block]
        word = block << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def take(self, rank: int) -> list[int]:
        """Remove the bucket of the lowest rank."""
        word, block = rank >> 6, rank >> 12
        self.low[word] &= self.low[word] - 1
        if not self.low[word]:
            self.middle[block] &= self.middle[block] - 1
            if not self.middle[block]:
                self.top &= self.top - 1
        return self.buckets.pop(rank)


class Strings:
    """Short byte strings by number, in one array."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of some numbers end to end, and where each begins, with the end of all."""
        sizes = self.sizes[numbers]
        return self.data[spread(self.starts[numbers], sizes)], np.append(0, np.cumsum(sizes))


class Encoder:
    """Ranks of a vocabulary, the merges of pre-tokens, and the way back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        most = max(ranks.values())
        by_rank = [b""] * (most + 1)
        for token, rank in ranks.items():
            by_rank[rank] = token
        self.tokens = Strings(by_rank)
        self.decimals = Strings([b" %d" % i for i in range(most + 1)])
        self.queue = RankQueue(most)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        joins = {
            ranks[whole[:i]] << 32 | ranks[whole[i:]]: rank
            for whole, rank in ranks.items()
            for i in range(1, len(whole))
            if whole[:i] in ranks and whole[i:] in ranks
        }
        self.pairs = np.sort(np.fromiter(joins, np.int64, len(joins)))
        self.pair_ranks = np.array([joins[k] for k in self.pairs.tolist()] + [-1], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids put together, -1 where that is no token."""
        keys = left << 32 | right
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], -1)

    def encode_all(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each pre-token has, and the ids of all: always merge the adjacent pair of lowest rank, the leftmost of equals.

        All pre-tokens share one linked list, cut between them, and one queue. A step takes the lowest bucket
        and merges the leftmost valid entry of every pre-token that has one, since a merge may make a pair of
        lower rank, which then comes before the pre-token's next entry. The others go back.
        """
        lengths = np.array([len(t) for t in tokens], np.int64)
        data = np.frombuffer(b"".join(tokens), np.uint8)
        n, queue = len(data), self.queue
        owner = np.repeat(np.arange(len(tokens)), lengths)
        ids = np.append(self.byte_ids[data], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # n: no neighbour
        edges = np.cumsum(lengths)
        after[edges - 1] = n
        before[edges - lengths] = n
        alive = np.ones(n + 1, bool)
        rank_at = np.full(n + 1, -1, np.int64)  # of the valid pair that starts at each position
        inner = np.flatnonzero(after[:n] < n)
        rank_at[inner] = self.rank_of(ids[inner], ids[inner + 1])
        order = np.argsort(rank_at[:n], kind="stable")
        order = order[rank_at[order] >= 0]
        for part in np.split(order, np.flatnonzero(np.diff(rank_at[order])) + 1) if len(order) else ():
            queue.push(int(rank_at[part[0]]), part.tolist())
        while (rank := queue.lowest()) >= 0:
            entries = np.array(sorted(queue.take(rank)))
            entries = entries[rank_at[entries] == rank]  # skip what is stale
            if not len(entries):
                continue
            if len(entries) > 1:
                own = owner[entries]
                later = np.append(False, own[1:] == own[:-1])
                if later.any():
                    queue.push(rank, entries[later].tolist())
                    entries = entries[~later]
            gone = after[entries]
            right, left = after[gone], before[entries]
            ids[entries] = rank
            after[entries], before[right] = right, entries
            alive[gone], rank_at[gone] = False, -1
            at = np.concatenate([entries, left])
            new = self.rank_of(ids[at], np.concatenate([ids[right], ids[entries]]))
            new[np.concatenate([right, left]) == n] = -1
            rank_at[at] = new
            rank_at[n] = -1
            for r, i in zip(new.tolist(), at.tolist(), strict=True):
                if r >= 0:
                    queue.push(r, [i])
        return np.add.reduceat(alive[:n], edges - lengths, dtype=np.int64), ids[:n][alive[:n]]

    def encode_long(self, token: bytes) -> list[int]:
        """`encode_all` for one long pre-token: buckets are heaps, and each step takes one entry."""
        rank_of, queue, n = self.ranks.get, self.queue, len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))  # where the symbol that starts here ends
        rank_at: list[int | None] = [rank_of(token[i : i + 2]) for i in range(n)]
        rank_at[n - 1] = None
        for i, rank in enumerate(rank_at):
            if rank is not None:
                queue.push(rank, [i])
        while (rank := queue.lowest()) >= 0:
            bucket = queue.buckets[rank]
            i = heappop(bucket)
            if not bucket:
                queue.take(rank)
            if rank_at[i] != rank:
                continue  # stale
            j = after[i]
            after[i] = k = after[j]
            end[i] = end[j]
            rank_at[i] = rank_at[j] = None
            if k < n:
                before[k] = i
            for at in (i if k < n else -1, before[i]):
                if at >= 0:
                    rank_at[at] = new = rank_of(token[at : end[after[at]]])
                    if new is not None:
                        if new in queue.buckets:
                            heappush(queue.buckets[new], at)
                        else:
                            queue.push(new, [at])
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(token[i : end[i]]))
            i = after[i]
        return ids

    def encode(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """`encode_all` for any pre-tokens: those that are tokens themselves need no merge, long ones go alone."""
        counts = np.ones(len(tokens), np.int64)
        ranks = np.fromiter(map(self.ranks.get, tokens, [-1] * len(tokens)), np.int64, len(tokens))
        open_at = np.flatnonzero(ranks < 0).tolist()
        short = [i for i in open_at if len(tokens[i]) <= LONG]
        if not open_at:
            return counts, ranks
        merged = {i: self.encode_long(tokens[i]) for i in open_at if len(tokens[i]) > LONG}
        for i, ids in merged.items():
            counts[i] = len(ids)
        together = np.empty(0, np.int64)
        if short:
            counts[short], together = self.encode_all([tokens[i] for i in short])
        first = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        out[first] = ranks
        out[spread(first[short], counts[short])] = together
        for i, ids in merged.items():
            out[first[i] : first[i] + len(ids)] = ids
        return counts, out

    def encode_units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and the ids of all; each match of the pattern is merged separately.

        Pre-tokens that several texts share are merged once.
        """
        cut = [self.pattern.findall(t.decode("utf-8")) for t in texts]
        number: dict[str, int] = {}
        which = np.array([number.setdefault(token, len(number)) for tokens in cut for token in tokens], np.int64)
        counts, ids = self.encode([token.encode("utf-8") for token in number])
        first = np.cumsum(counts) - counts
        edges = np.append(0, np.cumsum([len(tokens) for tokens in cut]))
        ends = np.append(0, np.cumsum(counts[which]))
        return np.diff(ends[edges]), ids[spread(first[which], counts[which])]

    def decode(self, ids: list[int]) -> bytes:
        return self.tokens.join(np.array(ids, np.int64))[0].tobytes()


def load_encoder(path: str, pattern: str) -> Encoder:
    """From a file of lines `base64-bytes rank`. Once per task."""

    def load() -> Encoder:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return Encoder(ranks, pattern)

    return kept(("encoder", path, pattern), load)


def shared_file(spark, path: str) -> str:
    """Send a vocabulary file to all executors; returns the name that `worker_path` finds there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def worker_path(name: str) -> str:
    return SparkFiles.get(name)


def _parts(found: Words, offsets: np.ndarray):
    """Ranges of documents of about `PART_BYTES` together."""
    at, n = 0, len(found.first) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PART_BYTES, "right")) - 1)
        yield at, min(stop, n)
        at = stop


def _batches(docs: DataFrame, path: str, pattern: str, schema: str, columns) -> DataFrame:
    """`columns` gets the encoder, the ids of some documents, and where the ids of each begin."""
    name = shared_file(docs.sparkSession, path)

    def work(batch: pa.RecordBatch):
        encoder, cache = load_encoder(worker_path(name), pattern), kept(("units", name), lambda: FlatCache(CACHED))

        for piece in pieces(batch.column(1), PIECE_BYTES):
            found = units(piece, encoder.pattern)
            hashes = FIRST.ranges(piece.data, found.starts, found.ends)
            distinct, at, where = np.unique(hashes, return_index=True, return_inverse=True)
            missing = np.flatnonzero(cache.find(distinct) < 0)
            if len(missing):
                at = at[missing]
                ranges = zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True)
                cache.add(distinct[missing], *encoder.encode_units([piece.data[a:b].tobytes() for a, b in ranges]))
            entries = cache.find(distinct)
            for a, b in _parts(found, piece.offsets):
                own = entries[where[found.first[a] : found.first[b]]]
                before = np.append(0, np.cumsum(cache.counts[own], dtype=np.int64))
                edges = before[found.first[a : b + 1] - found.first[a]]
                ids = batch.column(0).slice(piece.row + a, b - a)
                yield {"doc_id": ids, **columns(encoder, cache.take(own), edges)}
            cache.trim()
        return_free()

    return map_batches(two_columns(docs, "doc_id", "text"), schema, work)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token ids of every whole text, and the bytes decoded from them; one row per row of `docs`.

    `path` is a vocabulary of ranks. Each match of `pattern` is merged separately and special tokens are
    ordinary text. A NULL text counts as empty and has no ids. Rows that repeat are encoded one by one, an
    empty table gives an empty result, and only the two named columns are read.
    """

    def columns(encoder: Encoder, ids: np.ndarray, edges: np.ndarray) -> dict:
        decoded, begins = encoder.tokens.join(ids)
        cuts = pa.py_buffer(begins[edges].astype(np.int32).tobytes())
        texts = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, cuts, pa.py_buffer(decoded.tobytes())])
        return {"ids": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32())), "decoded": texts}

    return _batches(two_columns(docs, id_col, text_col), path, pattern, SCHEMA, columns)


def digest_documents(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`encode_documents` with digests of ids and decoded bytes, taken before the rows leave the worker."""

    def digests(strings: Strings, ids: np.ndarray, edges: np.ndarray, skip: int) -> list[str]:
        body, begins = strings.join(ids)
        view = memoryview(body)
        return [hashlib.sha256(view[a + skip : b]).hexdigest() for a, b in pairwise(begins[edges].tolist())]

    def columns(encoder: Encoder, ids: np.ndarray, edges: np.ndarray) -> dict:
        return {
            "n_tokens": np.diff(edges),
            "ids_sha256": digests(encoder.decimals, ids, edges, 1),  # no space before the first
            "decoded_sha256": digests(encoder.tokens, ids, edges, 0),
        }

    return _batches(two_columns(docs, id_col, text_col), path, pattern, DIGESTS, columns)


def decode_documents(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """Texts from rows of (doc_id, ids), as `encode_documents` gives them; NULL ids give an empty text.

    Bytes that are no UTF-8 (ids of a cut text) become replacement characters.
    """
    name = shared_file(tokens.sparkSession, path)

    def work(batch: pa.RecordBatch):
        encoder = load_encoder(worker_path(name), pattern)
        lists = batch.column(1).to_pylist()
        yield {
            "doc_id": batch.column(0),
            "text": [encoder.decode(x or []).decode("utf-8", "replace") for x in lists],
        }

    columns = tokens.select(F.col("doc_id"), F.col("ids").cast("array<int>"))
    return map_batches(columns, "doc_id long, text string", work)
