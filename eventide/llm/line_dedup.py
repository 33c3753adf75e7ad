"""Line deduplication by a segment-partition edit join (operator 3).

Lines within `edits` edits of each other are near. A line is split into edits + 1 segments; a near line, at most
`edits` characters longer, holds at least one of them unchanged, at a place that the edits before and after it
allow. So every line is indexed by its segments, with its length, and probes the indexes of its own and
the shorter lengths with the substrings at those places. Pairs that meet are verified by a banded
bit-parallel edit distance. Near lines, directly or by way of others, are one class, and of a class the first
line in (document, line) order stays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from eventide.llm.arrow import FIRST, SECOND, Piece, code_points, lines, mix, pieces, with_word
from eventide.llm.components import connected_components
from eventide.llm.frames import Bitmap, Scratch, candidate_pairs, map_batches, two_columns
from eventide.storage import materialize

EDITS = 2
MIN_CHARS = 24
#: Rows of a key that are compared at once; larger groups are cut into blocks of this size.
TILE = 4_096
#: Steps that classes are carried on after the lines of each key have been compared with one of them.
STEPS = 3

_ODD = np.uint64(0x9E3779B97F4A7C15)


class NamedRanges:
    """Byte ranges, ordered by start, with hashes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.ends = data, starts, ends
        self.a = FIRST.ranges(data, starts, ends)

    def names(self, which: np.ndarray) -> list[bytes]:
        """128 bits of each."""
        order = np.argsort(self.starts[which], kind="stable")
        second = np.empty(len(which), np.uint64)
        second[order] = SECOND.ranges(self.data, self.starts[which][order], self.ends[which][order])
        packed = np.stack([self.a[which], second], 1).astype(">u8").tobytes()
        return [packed[i : i + 16] for i in range(0, len(packed), 16)]


class Lines(NamedRanges):
    """The lines with a word of a piece, with a 128-bit name for each text and, for long ones, a node number.

    A node number has 32 parity bits of the line's bigrams, which say how far apart two lines are at least,
    and 31 bits of its hash. Different lines may share one; texts are compared in the end.
    """

    def __init__(self, piece: Piece, min_chars: int):
        before = code_points(piece)
        starts, ends, owner, number = lines(piece)
        some = with_word(piece, starts, ends)
        super().__init__(piece.data, starts[some], ends[some])
        self.owner, self.number = owner[some], number[some]
        self.first = np.searchsorted(self.owner, np.arange(len(piece) + 1))
        self.chars = before[self.ends] - before[self.starts]
        self.long = self.chars >= min_chars
        self.symbols = np.frombuffer(
            piece.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32
        )
        self.at = before[self.starts]
        self.node = self._parity() << np.uint64(31) | self.a >> np.uint64(33)

    def _parity(self) -> np.ndarray:
        symbols = self.symbols
        bits = np.zeros(len(symbols) + 1, np.uint32)
        place = (symbols[:-1] * np.uint32(0x9E3779B1) ^ symbols[1:] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D)
        bits[1:-1] = np.uint32(1) << (place >> np.uint32(27))
        total = np.bitwise_xor.accumulate(bits)  # bits[i] is the bigram that ends at symbol i
        last = np.maximum(self.at + self.chars - 1, self.at)
        return (total[last] ^ total[self.at]).astype(np.uint64)


def segment(length: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where segment i of a line of this length starts, and how long it is; the last ones may be longer."""
    size, longer = length // (edits + 1), length % (edits + 1)
    before = np.maximum(0, i - (edits + 1 - longer))
    return i * size + before, size + (i >= edits + 1 - longer)


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(characters less, segment, shift) of each key of a line; the first edits + 1 index it, the others probe."""
    out = [(0, i, 0) for i in range(edits + 1)]
    for less in range(edits + 1):
        for i in range(edits + 1):
            # Edits before the segment shift it by i at most, those after it by edits - i.
            for place in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1):
                if less or place:
                    out.append((less, i, place))
    return out


def keys(own: Lines, which: np.ndarray, edits: int, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of keys for each line, in the order of `probes`, and which of them there are."""
    at, length = own.at[which], own.chars[which]
    every = probes(edits)
    begins, sizes = np.zeros((2, len(every), len(which)), np.int64)
    tags, there = np.zeros((len(every), len(which)), np.uint64), np.zeros((len(every), len(which)), bool)
    for n, (less, i, place) in enumerate(every):
        start, size = segment(length - less, i, edits)
        there[n] = (length - less >= min_chars) & (start + place >= 0) & (start + place + size <= length)
        begins[n], sizes[n] = at + start + place, size
        tags[n] = ((length - less) * (edits + 1) + i).astype(np.uint64)
    flat = np.flatnonzero(there.ravel())
    begins, sizes, tags = begins.ravel()[flat], sizes.ravel()[flat], tags.ravel()[flat]
    order = np.argsort(begins, kind="stable")
    hashes = np.empty(len(flat), np.uint64)
    hashes[order] = FIRST.ranges(own.symbols, begins[order], (begins + sizes)[order])
    out = np.zeros(there.size, np.int64)
    out[flat] = mix(hashes + mix(tags + _ODD)).view(np.int64)
    return out.reshape(there.shape).T, there.T


def _line_rows(texts: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(line, node, keys, doc_id, number): the first place of each line in each piece; node and keys of long ones.

    A row without `line` says in `number` how many lines with a word a document has.
    """
    width = len(probes(edits))

    def work(batch: pa.RecordBatch):
        for piece in pieces(batch.column(1)):
            own = Lines(piece, min_chars)
            ids = batch.column(0).to_numpy()[piece.row + own.owner]
            order = np.lexsort((own.number, ids))
            _, one = np.unique(own.a[order], return_index=True)
            which = order[one]
            long = own.long[which]
            key, there = keys(own, which[long], edits, min_chars)
            ends = np.append(0, np.cumsum(long * width))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key.ravel(), mask=~there.ravel()))
            yield {
                "line": own.names(which),
                "node": pa.array(own.node[which].astype(np.int64), mask=~long),
                "keys": lists,
                "doc_id": ids[which],
                "number": own.number[which],
            }
            n, every = len(piece), batch.column(0).slice(piece.row, len(piece))
            yield {"line": [None] * n, "node": [None] * n, "keys": [None] * n, "doc_id": every, "number": np.diff(own.first)}

    return map_batches(texts, "line binary, node long, keys array<long>, doc_id long, number long", work)


def _meeting(lines: DataFrame, edits: int) -> DataFrame:
    """(key, member) rows whose key other lines have too, and some that only seem so; ranges split keys with many rows.

    A member is the node number with a last bit that says: indexed here.
    """
    each = lines.where("node is not null").select("node", F.posexplode("keys").alias("n", "key")).where("key is not null")
    indexed = F.when(F.col("n") <= edits, 1).otherwise(0).cast("long")
    rows = each.select("key", F.shiftleft("node", 1).bitwiseOR(indexed).alias("member"))
    dealt = rows.repartitionByRange("key", "member").sortWithinPartitions("key", "member")

    def work(batch: pa.RecordBatch):
        key, member = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
        key, member = key[new], member[new]
        same = np.ones(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        keep = same[1:] | same[:-1]
        yield {"key": key[keep], "member": member[keep]}

    return map_batches(dealt, "key long, member long", work)


def _near(columns: dict, i: np.ndarray, j: np.ndarray, edits: int) -> np.ndarray:
    """Of two classes, one of them indexed, and bigrams that allow so few edits. An edit changes four parities at most."""
    member, label = columns["member"], columns["class"]
    apart = np.bitwise_count(((member[i] ^ member[j]) >> 32).astype(np.uint32))
    return ((member[i] | member[j]) & 1 == 1) & (apart <= 4 * edits) & (label[i] != label[j])


def _classes(links: DataFrame, twins: DataFrame, write) -> DataFrame:
    """(node, class): nodes of one class are connected by these links, of node_a and node_b; there may be fewer classes.

    Every node takes the largest class among those it is linked with, `STEPS` times. Nodes that several lines share are
    left out, as such a line need not be connected with what another one is linked with.
    """
    ends = links.select("node_a", "node_b").where("node_a != node_b").distinct()
    ends = ends.join(twins.toDF("node_a"), "node_a", "left_anti").join(twins.toDF("node_b"), "node_b", "left_anti")
    pair = lambda x, y: F.struct(F.col(x).alias("node"), F.col(y).alias("beside"))
    both = F.array(pair("node_a", "node_b"), pair("node_b", "node_a"), pair("node_a", "node_a"), pair("node_b", "node_b"))
    ends = write(ends.select(F.explode(both).alias("e")).select("e.*").distinct(), "line-ends")
    found = ends.groupBy("node").agg(F.max("beside").alias("class"))
    for _ in range(STEPS):
        found = write(found, "line-classes").withColumnRenamed("node", "beside")
        found = ends.join(found, "beside").groupBy("node").agg(F.max("class").alias("class"))
    return found


def _weighed(met: DataFrame) -> DataFrame:
    """(key, member, node, weight): the weight of a line is how many lines it shares its keys with, all together."""
    met = met.withColumn("node", F.shiftrightunsigned("member", 1))
    sizes = met.groupBy("key").agg(F.count("*").alias("size"))
    weights = met.join(sizes, "key").groupBy("node").agg(F.sum("size").alias("weight"))
    return met.join(weights, "node")


def _star(rows: DataFrame, edits: int) -> DataFrame:
    """Pairs (a, b): the indexed line of most weight of each key, and those that it may be near to.

    In a group of near copies of one line, that line is the one that shares most keys, and most others are near to it.
    """
    centre = rows.where(F.col("member").bitwiseAND(F.lit(1)) == 1).groupBy("key")
    centre = centre.agg(F.max(F.struct("weight", F.col("node").alias("other"))).alias("c"))
    both = rows.join(centre.select("key", "c.other"), "key").where("node != other")
    apart = F.bit_count(F.shiftrightunsigned(F.col("node").bitwiseXOR(F.col("other")), 31))
    both = both.where(apart <= 4 * edits)
    return both.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _of_several_classes(met: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, member, class) of the keys that lines of several classes have."""
    rows = met.join(classes, "node", "left").select("key", "member", F.coalesce("class", "node").alias("class"))
    several = rows.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return rows.join(several.where("low != high").select("key"), "key")


def _line_texts(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(line, node, body) of the lines in `names`, which has line and node."""
    first = F.conv(F.hex(F.substring("line", 1, 8)), 16, -10).cast("long")
    wanted = Bitmap(names.select(first))

    def work(batch: pa.RecordBatch):
        for piece in pieces(batch.column(1)):
            starts, ends, owner, number = lines(piece)
            own = NamedRanges(piece.data, starts, ends)
            which = np.flatnonzero(wanted.test(own.a.view(np.int64)))
            _, one = np.unique(own.a[which], return_index=True)
            which = which[one]
            bodies = [piece.data[a:b].tobytes() for a, b in zip(starts[which], ends[which], strict=True)]
            yield {"line": own.names(which), "body": bodies}

    found = map_batches(texts, "line binary, body string", work).dropDuplicates(["line"])
    return found.join(names, "line")


def within(left: list[str], right: list[str], edits: int) -> np.ndarray:
    """Which pairs are at most `edits` apart, by bit-parallel columns of a band around the diagonal.

    Bit t of a column j stands for row j - edits + t. All pairs go through their columns together.
    """
    a = np.frombuffer("".join(left).encode("utf-32-le", "replace"), np.uint32)
    b = np.frombuffer("".join(right).encode("utf-32-le", "replace"), np.uint32)
    m, n = (np.array([len(x) for x in y], np.int64) for y in (left, right))
    at_a, at_b = np.cumsum(m) - m, np.cumsum(n) - n
    a = np.append(a, np.uint32(0))
    out = np.full(len(m), edits + 1, np.int64)
    width = 2 * edits + 1
    mask, bottom = np.uint64((1 << width) - 1), np.uint64(2 * edits)
    live = np.flatnonzero((np.abs(m - n) <= edits) & (m > edits))
    tiny = np.flatnonzero((np.abs(m - n) <= edits) & (m <= edits))
    out[tiny] = [distance(left[k], right[k]) for k in tiny]
    up = np.full(len(live), ((1 << (edits + 1)) - 1) << edits, np.uint64)
    down = np.zeros(len(live), np.uint64)
    score = np.full(len(live), edits, np.int64)
    column = 0
    while len(live):
        ended = n[live] == column
        if ended.any():
            out[live[ended]] = score[ended]
            live, up, down, score = (x[~ended] for x in (live, up, down, score))
            continue
        column += 1
        rows, begin = m[live], at_a[live]
        symbol = b[at_b[live] + column - 1]
        equal = np.zeros(len(live), np.uint64)
        for t in range(width):
            row = column - edits + t
            if row < 1:
                continue
            same = (row <= rows) & (a[np.minimum(begin + row - 1, len(a) - 1)] == symbol)
            equal |= same.astype(np.uint64) << np.uint64(t)
        zero = ((((equal & up) + up) ^ up) | equal | down) & mask
        plus = (down | ~(zero | up)) & mask
        minus = zero & up
        diagonal = column + edits <= rows
        score += diagonal & (zero >> bottom & np.uint64(1) == 0)
        last = np.maximum(rows - column + edits, 0).astype(np.uint64)
        along = (plus >> last & np.uint64(1)).astype(np.int64) - (minus >> last & np.uint64(1)).astype(np.int64)
        score += np.where(diagonal, 0, along)
        shifted = zero >> np.uint64(1)
        up = (minus | ~(shifted | plus)) & mask
        down = shifted & plus
    return out <= edits


def distance(a: str, b: str) -> int:
    """Edit distance of short texts."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def _verified(pairs: DataFrame, bodies: DataFrame, edits: int) -> DataFrame:
    """(a, b, node_a, node_b): names and nodes of the lines of these pairs that are near."""
    left = bodies.select(F.col("node").alias("a"), F.col("line").alias("line_a"), F.col("body").alias("body_a"))
    right = bodies.select(F.col("node").alias("b"), F.col("line").alias("line_b"), F.col("body").alias("body_b"))
    both = pairs.join(left, "a").join(right, "b").select("line_a", "line_b", "a", "b", "body_a", "body_b")

    def work(batch: pa.RecordBatch):
        keep = pa.array(within(batch.column(4).to_pylist(), batch.column(5).to_pylist(), edits))
        yield {n: batch.column(i).filter(keep) for i, n in enumerate(("a", "b", "node_a", "node_b"))}

    return map_batches(both, "a binary, b binary, node_a long, node_b long", work)


def near_lines(
    docs: DataFrame,
    rows: DataFrame,
    facts: DataFrame,
    edits: int = EDITS,
    tile: int = TILE,
    write: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Links (a, b) between names of near lines that connect all of them.

    It gets (doc_id, text) rows, their `_line_rows`, and (line, node) of each line. The lines of a key are first
    compared with one of them. What is connected then is not compared any more, so a large group of near copies costs
    its size; all other pairs that share a key are.
    """
    met = write(_weighed(write(_meeting(rows, edits), "line-keys")), "line-weights")
    nodes = facts.where("node is not null").select("line", "node")
    twins = write(nodes.groupBy("node").count().where("count > 1").select("node"), "line-twins")
    wanted = met.select("node").unionByName(twins).distinct()
    bodies = write(_line_texts(docs, write(nodes.join(wanted, "node"), "line-nodes")), "line-texts")

    pairs = twins.select(F.col("node").alias("a"), F.col("node").alias("b"))  # lines that share a number
    stars = write(_star(met, edits).unionByName(pairs), "line-stars")
    links = write(_verified(stars, bodies, edits), "line-links")
    members = write(_of_several_classes(met, _classes(links, twins, write)), "line-open")
    rest = candidate_pairs(members, lambda c, i, j: _near(c, i, j, edits), tile, write)
    rest = rest.select(F.shiftrightunsigned("a", 1).alias("a"), F.shiftrightunsigned("b", 1).alias("b")).distinct()
    links = links.unionByName(_verified(write(rest, "line-pairs"), bodies, edits))
    return write(links.select("a", "b"), "line-links")


#: A place is one number, ordered by document and then line, as Spark adds up numbers without sorting.
_LINES = 1 << 31


def _place(doc_id: Column, number: Column) -> Column:
    return doc_id.cast("decimal(20,0)") * F.lit(_LINES) + number.cast("decimal(10,0)")


def first_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, tile: int = TILE
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, first): for each document the numbers of its lines that are the first of their class.

    And (doc_id, lines): how many lines with a word each row of `docs` has.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.write(_line_rows(docs, edits, min_chars), "line-rows")
    counts = materialize(rows.where("line is null").select("doc_id", F.col("number").alias("lines")), "line-counts")
    rows = rows.where("line is not null")
    facts = rows.groupBy("line", "node").agg(F.min(_place(F.col("doc_id"), F.col("number"))).alias("place"))
    facts = scratch.write(facts, "line-facts")
    links = near_lines(docs, rows, facts, edits, tile, scratch.write)
    classes = connected_components(links, scratch.write).withColumnRenamed("node", "line")
    classes = scratch.write(classes, "line-classes")
    alone = facts.join(classes, "line", "left_anti").select("place")
    joined = facts.join(classes, "line").groupBy("component").agg(F.min("place").alias("place")).select("place")
    number = F.pmod("place", F.lit(_LINES))
    kept = alone.unionByName(joined).select(
        ((F.col("place") - number) / F.lit(_LINES)).cast("long").alias("doc_id"), number.cast("long").alias("number")
    )
    first = materialize(kept.groupBy("doc_id").agg(F.collect_list("number").alias("first")), "line-first")
    scratch.clear()
    return first, counts


def dedup_lines(
    docs: DataFrame,
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    tile: int = TILE,
) -> DataFrame:
    """All columns of `docs` with the lines taken out of the text that repeat another one, exactly or nearly.

    Lines are cut at line feeds. Equal lines are of one class; so are lines of `min_chars` characters or
    more that are at most `edits` edits apart, also by way of others. Of each class the line with the smallest
    (id, line number) stays, wherever it is. Lines without a word always stay, and so does a
    NULL text. Rows of one id count as one document; rows without an id are left as they are
    and make no other line go. An empty table gives an empty result, and no column is renamed.
    """
    first, changed = _decide(docs, edits, min_chars, id_col, text_col, tile)
    name = "first_lines"
    while name in docs.columns:
        name += "_"
    first = first.select(F.col("doc_id").alias(f"{name}_id"), F.col("first").alias(name))
    some = docs.where(changed).join(first, docs[id_col] == first[f"{name}_id"], "left").drop(f"{name}_id")
    @F.arrow_udf("string")
    def cut(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        both = zip(texts.to_pylist(), numbers.to_pylist(), strict=True)
        return pa.array([_kept(t, n) for t, n in both], pa.string())

    some = some.withColumn(text_col, cut(text_col, name)).select(*docs.columns)
    return docs.where(~changed).unionByName(some)


def _decide(docs, edits, min_chars, id_col, text_col, tile) -> tuple[DataFrame, Column]:
    """First lines by document, and a filter that all rows of `docs` with a line to drop pass."""
    texts = two_columns(docs, id_col, text_col).where("doc_id is not null")
    first, counts = first_lines(texts, edits, min_chars, tile)
    changed = counts.join(first.select("doc_id", F.size("first").alias("firsts")), "doc_id", "left")
    changed = changed.where(F.col("lines") > F.coalesce("firsts", F.lit(0))).select("doc_id")
    return first, Bitmap(changed).has(docs[id_col])


def _kept(text: str | None, numbers: list[int] | None) -> str | None:
    """The text without the lines that have a word and are not first."""
    if text is None:
        return None
    first = set(numbers or ())
    left = (x for i, x in enumerate(text.split("\n")) if i in first or not x.strip(" \t\n\v\f\r"))
    return "\n".join(left)
