"""N-gram Jaccard join by PartEnum signatures (operator 5).

A document is its set of distinct word n-grams. Two sets of at most s elements together whose Jaccard
similarity is p percent or more differ in at most k = s (100 - p) / (100 + p) elements. Sets are put into size bands,
so that k is fixed in a band. There the domain of n-grams is cut into n1 = (k + 1) / 2 parts by hash, and each
part into three: in some part at most one element differs, so the two sets agree in two of its three
subparts (or, should these be empty, the third one without an element). A set therefore has a signature for each part and each choice of two subparts, and sufficiently
similar sets share one. A set signs for its own band and those above it that a similar set may be in.

Sets that are equal are one class, which its smallest id stands for. Links are checked on the n-grams of the
whole texts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from eventide.llm.arrow import FIRST, Piece, lowered, mix, pieces, whole_runs, words
from eventide.llm.components import connected_components
from eventide.llm.frames import Bitmap, Scratch, candidate_pairs, map_batches, two_columns, without
from eventide.storage import materialize

BAND_RATIO = 1.25
#: Members of a signature that are compared at once; larger groups are cut into blocks of this size.
TILE = 4_096
#: Parity bits that pairs are compared by before their texts are; they tell sets of some thousand elements apart.
WIDE = 2048

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@lru_cache(maxsize=1)
def band_edges() -> np.ndarray:
    """The first size of each band."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
    return np.array(edges, np.int64)


def most_apart(together: np.ndarray, percent: int) -> np.ndarray:
    """The largest symmetric difference of two similar sets, by the sum of their sizes."""
    return together * (100 - percent) // (100 + percent)


def _order(hashes: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(hashes)
    small = owners[order].astype(np.uint16) if n < 1 << 16 else owners[order]
    return order[np.argsort(small, kind="stable")]


def shingle_sets(piece: Piece, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct n-grams of each document, sorted; and where each document begins.

    Letters A-Z count as lower case. A document of fewer than n words has one element, all of them.
    """
    piece = lowered(piece)
    found = words(piece)
    hashes = FIRST.ranges(piece.data, found.starts, found.ends)
    at = whole_runs(found, n)
    rolled = FIRST.ranges(hashes, at, at + n) if len(at) else np.empty(0, np.uint64)
    short = np.flatnonzero((found.counts > 0) & (found.counts < n))
    whole = FIRST.ranges(hashes, found.first[short], found.first[short + 1])
    whole = mix(whole + found.counts[short].astype(np.uint64))
    values = np.concatenate([rolled, whole])
    owners = np.concatenate([found.owners()[at], short])
    order = _order(values, owners, len(piece))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.searchsorted(owners, np.arange(len(piece) + 1))


def _wrapped_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def _spread(values: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements of the sets `which`, one set after the other, and the place of each one's set in `which`."""
    sizes = first[which + 1] - first[which]
    home = np.repeat(np.arange(len(which)), sizes)
    at = np.arange(len(home)) - np.repeat(_starts(sizes)[:-1], sizes) + first[which][home]
    return values[at], home


def signatures(values: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All signatures, and the set each belongs to."""
    edges, sizes = band_edges(), np.diff(first)
    band = np.searchsorted(edges, sizes, "right") - 1
    filled = np.flatnonzero(sizes)
    which, bands = [filled], [band[filled]]
    while len(which[-1]):  # the bands above where a similar set may be
        higher = bands[-1] + 1
        near = 100 * sizes[which[-1]] >= percent * edges[higher]
        which.append(which[-1][near])
        bands.append(higher[near])
    which, bands = np.concatenate(which), np.concatenate(bands)
    apart = most_apart(2 * (edges[bands + 1] - 1), percent)
    which, bands, apart = which[apart > 0], bands[apart > 0], apart[apart > 0]  # else only equal sets link
    parts = (apart + 2) // 2
    begin = _starts(parts)
    own, home = _spread(values, first, which)
    cell = (mix(own ^ _ODD[0]) % (3 * parts[home]).astype(np.uint64)).astype(np.int64) + 3 * begin[home]
    value = mix(own ^ _ODD[1])
    sums = np.zeros(3 * begin[-1], np.uint64)
    np.add.at(sums, cell, value)
    filled = np.bincount(cell, minlength=len(sums)).reshape(-1, 3) > 0
    sums = sums.reshape(-1, 3)
    row = np.repeat(np.arange(len(which)), parts)
    part = (np.arange(len(row)) - begin[row]).astype(np.uint64)
    tag = mix(mix(bands[row].astype(np.uint64) + _ODD[2]) + part)
    signed, owner = [], []
    bare = np.zeros((len(row), 3), bool)
    for left in range(3):
        one, other = (left + 1) % 3, (left + 2) % 3
        bare[:, left] = ~filled[:, one] & ~filled[:, other]
        both = mix(sums[:, one] + _ODD[0]) + mix(sums[:, other]) * _ODD[2]
        signed.append(_sign(tag, left, np.where(bare[:, left], mix(sums[:, left] + _ODD[1]), both)))
        owner.append(which[row])
    # Two empty subparts say nothing. Then the third ones differ in one element at most: they are equal, or
    # one is the other without an element. So a set signs for its third subpart, and for it without each.
    alone = np.flatnonzero(bare.ravel()[cell])
    at = cell[alone]
    for left in range(3):
        own_at, own_value = at[at % 3 == left], value[alone[at % 3 == left]]
        signed.append(_sign(tag[own_at // 3], left, mix(sums.ravel()[own_at] - own_value + _ODD[1])))
        owner.append(which[row[own_at // 3]])
    return np.concatenate(signed), np.concatenate(owner)


def _sign(tag: np.ndarray, left: int, agreed: np.ndarray) -> np.ndarray:
    return mix(tag * _ODD[1] + agreed + np.uint64(left))


def sketches(values: np.ndarray, first: np.ndarray, bits: int | np.ndarray = 512) -> list[bytes]:
    """Parity bits of each set, as many for all or some for each. Two sets that differ in d elements differ in at most d bits."""
    count = len(first) - 1
    bits = np.broadcast_to(np.asarray(bits, np.int64), count)
    begin, home = _starts(bits), np.repeat(np.arange(count), np.diff(first))
    at = (mix(values ^ _ODD[2]) % bits[home].astype(np.uint64)).astype(np.int64) + begin[home]
    parity = (np.bincount(at, minlength=begin[-1]) & 1).astype(np.uint8)
    packed = np.packbits(parity, bitorder="little").tobytes()
    return [packed[i // 8 : j // 8] for i, j in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def _sized(values: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """A sketch of at least two bits for each element; none for sets that `WIDE` bits do for."""
    sizes = np.diff(first)
    large = np.flatnonzero(2 * sizes > WIDE)
    bits = 1 << np.ceil(np.log2(2 * sizes[large])).astype(np.int64)
    own, home = _spread(values, first, large)
    out = [None] * len(sizes)
    for i, sketch in zip(large.tolist(), sketches(own, np.searchsorted(home, np.arange(len(large) + 1)), bits), strict=True):
        out[i] = sketch
    return out


def bits_apart(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """In how many bits the sketches of each pair differ. The longer one, its bits a power of two times the other's, is folded."""
    lengths = np.array([[len(x) for x in left], [len(x) for x in right]], np.int64).reshape(2, -1)
    apart = np.zeros(len(left), np.int64)
    for both in np.unique(lengths, axis=1).T:
        rows = np.flatnonzero((lengths == both[:, None]).all(0))
        words = [np.frombuffer(b"".join([side[i] for i in rows]), np.uint64) for side in (left, right)]
        short = both.min() // 8
        one, other = (np.bitwise_xor.reduce(w.reshape(len(rows), -1, short), 1) for w in words)
        apart[rows] = np.bitwise_count(one ^ other).sum(1, dtype=np.int64)
    return apart


def _features(texts: DataFrame, n: int) -> DataFrame:
    def work(batch: pa.RecordBatch):
        for piece in pieces(batch.column(1)):
            values, first = shingle_sets(piece, n)
            yield {
                "doc_id": batch.column(0).slice(piece.row, len(piece)),
                "n_shingles": np.diff(first),
                "set_a": _wrapped_sums(mix(values), first).view(np.int64),
                "set_b": _wrapped_sums(mix(values ^ _ODD[1]), first).view(np.int64),
                "wide": sketches(values, first, WIDE),
                "sized": _sized(values, first),
            }

    columns = "doc_id long, n_shingles long, set_a long, set_b long, wide binary, sized binary"
    return map_batches(texts, columns, work)


def _signed(texts: DataFrame, n: int, percent: int) -> DataFrame:
    def work(batch: pa.RecordBatch):
        for piece in pieces(batch.column(1)):
            signed, owner = signatures(*shingle_sets(piece, n), percent)
            ids = batch.column(0).to_numpy()[piece.row + owner]
            yield {"sig": signed.view(np.int64), "doc_id": ids}

    return map_batches(texts, "sig long, doc_id long", work)


def _shared(signed: DataFrame) -> DataFrame:
    """Rows (sig, doc_id) whose signature another document has too, and some that only seem so.

    The rows are dealt out by ranges of (sig, doc_id), so that a signature with very many documents falls into
    several tasks, and read in order. The first and the last signature of a batch may go on beyond it
    and are kept.
    """
    rows = signed.select("sig", "doc_id")
    dealt = rows.repartitionByRange("sig", "doc_id").sortWithinPartitions("sig", "doc_id")

    def work(batch: pa.RecordBatch):
        sig = batch.column(0).to_numpy()
        same = np.ones(len(sig) + 1, bool)
        same[1:-1] = sig[1:] == sig[:-1]
        keep = same[1:] | same[:-1]
        yield {"sig": sig[keep], "doc_id": batch.column(1).to_numpy()[keep]}

    return map_batches(dealt, "sig long, doc_id long", work)


def _groups(shared: DataFrame) -> DataFrame:
    """(sig, a): the signatures that different documents share, with the smallest of these; of those that the same documents share, one.

    Near documents share most of their signatures, and each would give the same pairs again. Sets of documents are told
    apart by their number and 96 bits.
    """
    marks = (F.sum(F.shiftright(F.xxhash64("doc_id", F.lit(i)), 16)).alias(f"mark_{i}") for i in range(2))
    ends = F.min("doc_id").alias("a"), F.max("doc_id").alias("z")
    groups = shared.groupBy("sig").agg(*ends, F.count("*").alias("rows"), *marks).where("a != z")
    return groups.groupBy("rows", "mark_0", "mark_1").agg(F.min("sig").alias("sig"), F.min("a").alias("a")).select("sig", "a")


def _plausible(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ids that sizes and sketches do not rule out; far fewer texts are fetched then.

    `marks` has doc_id, n_shingles, wide and sized; where an id has several rows, a pair stays if any two of them may be
    similar. Wide sketches come first, and only the pairs they leave fetch those that grow with the set.
    """
    wide = _not_apart(pairs, marks.select("doc_id", "n_shingles", "wide"), percent)
    return _not_apart(wide.distinct(), _sized_marks(marks), percent).distinct()


def _sized_marks(marks: DataFrame) -> DataFrame:
    return marks.select("doc_id", "n_shingles", F.coalesce("sized", "wide"))


def _not_apart(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    left, right = (marks.toDF(end, f"n_{end}", f"bits_{end}") for end in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def work(batch: pa.RecordBatch):
        sizes = [batch.column(i).to_numpy() for i in (2, 3)]
        small, large = np.minimum(*sizes), np.maximum(*sizes)
        apart = bits_apart(batch.column(4).to_pylist(), batch.column(5).to_pylist())
        keep = pa.array((100 * small >= percent * large) & (apart <= most_apart(small + large, percent)))
        yield {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}

    return map_batches(both, "a long, b long", work)


def _linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose whole texts are similar."""
    known = Bitmap(pairs.select(F.explode(F.array("a", "b"))))
    texts = texts.where(known.has(F.col("doc_id")))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("text_a", "text_b", "a", "b")

    def work(batch: pa.RecordBatch):
        keep = []
        for one, other in zip(pieces(batch.column(0), 1), pieces(batch.column(1), 1), strict=True):
            x, y = shingle_sets(one, n)[0], shingle_sets(other, n)[0]
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        keep = pa.array(keep)
        yield {"a": batch.column(2).filter(keep), "b": batch.column(3).filter(keep)}

    return map_batches(both, "a long, b long", work)


def _near(columns: dict, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of different components that sizes and sketches do not rule out."""
    sizes, component = columns["n_shingles"], columns["component"]
    if "bits" not in columns:
        columns["bits"] = np.frombuffer(b"".join(columns["wide"]), np.uint64).reshape(-1, WIDE // 64)
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    use = (component[i] != component[j]) & (100 * small >= percent * large)
    apart = np.bitwise_count(columns["bits"][i[use]] ^ columns["bits"][j[use]]).sum(1)
    use[use] = apart <= most_apart(small[use] + large[use], percent)
    return use


def _of_one_id(sets: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between the classes of the rows of each id that has different sets."""
    differs = F.min("set_a").alias("low"), F.max("set_a").alias("high"), F.min("set_b").alias("l"), F.max("set_b").alias("h")
    several = sets.groupBy("doc_id").agg(*differs).where("low != high or l != h").select("doc_id")
    several = scratch.write(several, "join-several")
    own = sets.join(several, "doc_id", "left_semi").join(classes, ["n_shingles", "set_a", "set_b"])
    own = scratch.write(own.select("doc_id", "class").distinct(), "join-own")
    low = own.groupBy("doc_id").agg(F.min("class").alias("a"))
    return own.join(low, "doc_id").where("class != a").select("a", F.col("class").alias("b"))


def jaccard_classes(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    tile: int = TILE,
) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id that links lead to; one row per row of `docs`.

    Two documents link when 100 * intersection >= percent * union of their n-gram sets. A NULL or empty
    text has no n-grams and links with nothing; its component is its own id. Rows of one id are one document, linked with each
    other. A row without an id has no component. An empty table gives an empty result, and only the two
    named columns are read.
    """
    scratch, texts = Scratch(docs.sparkSession), two_columns(docs, id_col, text_col)
    features = materialize(_features(texts, n), "join-features")
    sets = features.where("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "set_a", "set_b"]
    classes = materialize(sets.groupBy(key).agg(F.min("doc_id").alias("class")), "join-classes")
    lead = classes.select(F.col("class").alias("doc_id"), "n_shingles").distinct()
    copies = scratch.write(sets.select("doc_id").join(lead, "doc_id", "left_anti"), "join-copies")
    texts = texts.where("doc_id is not null")
    shared = scratch.write(_shared(_signed(without(texts, "doc_id", copies), n, percent)), "join-shared")

    # First each document with the smallest of every group that shares a signature; groups of the same documents count once.
    low = scratch.write(_groups(shared), "join-low")
    shared = scratch.write(shared.join(low, "sig").distinct(), "join-grouped")
    pairs = shared.where("doc_id != a").select("a", F.col("doc_id").alias("b")).distinct()
    marks = sets.select("doc_id", *key, "wide", "sized").join(lead, ["doc_id", "n_shingles"], "left_semi")
    wide = scratch.write(marks.dropDuplicates(["doc_id", *key]).drop("set_a", "set_b"), "join-marks")
    pairs = scratch.write(_plausible(pairs, wide, percent), "join-pairs")
    links = _linked(pairs, texts, n, percent).unionByName(_of_one_id(sets, classes, scratch))
    links = scratch.write(links, "join-links")
    found = scratch.write(connected_components(links, scratch.write), "join-found")

    # Then all pairs that share a signature and are not yet connected.
    member = found.withColumnRenamed("node", "doc_id")
    labelled = shared.drop("a").join(member, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    labelled = scratch.write(labelled, "join-labelled")
    open_sigs = labelled.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_sigs = scratch.write(open_sigs.where("x != y").select("sig"), "join-open")
    members = labelled.join(open_sigs, "sig", "left_semi").join(wide.select("doc_id", "n_shingles", "wide"), "doc_id")
    members = members.withColumnsRenamed({"sig": "key", "doc_id": "member"})
    members = scratch.write(members, "join-members")
    near = candidate_pairs(members, lambda c, i, j: _near(c, i, j, percent), tile, scratch.write)
    near = _not_apart(near.join(pairs, ["a", "b"], "left_anti"), _sized_marks(wide), percent).distinct()
    near = scratch.write(near, "join-near")
    links = scratch.write(links.unionByName(_linked(near, texts, n, percent)), "join-all-links")
    found = materialize(connected_components(links, scratch.write), "join-found")
    scratch.clear()

    top = classes.join(found.withColumnRenamed("node", "class"), "class", "left")
    top = top.select(*key, F.coalesce("component", "class").alias("top"))
    rows = features.select("doc_id", *key).join(top, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("top", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"))
