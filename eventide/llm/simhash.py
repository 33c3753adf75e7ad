"""Document fingerprints by SimHash (operator 11), with DataFrame functions only.

The terms of a text are its pairs of neighbouring words, in lower case, and its last word. Each term votes with
its weight, the number of times it occurs: for every bit that its 64-bit hash has set, and against every other.
The signs of the sums are the fingerprint, so the angle between the term counts of two texts is about the
share of bits in which their fingerprints differ.

Fingerprints within a Hamming radius are found in permuted block tables: 64 bits are cut into `blocks` blocks, and
at most `radius` of them can differ, so near fingerprints agree in blocks - radius others. There is a table for each
choice of so many blocks, in which the fingerprint is permuted to have these first, and candidates share them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import combinations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from eventide.llm.components import connected_components
from eventide.llm.frames import Scratch, numbered, two_columns
from eventide.storage import materialize

RADIUS = 3
BLOCKS = 6
#: Rounds in which members of a table's groups are compared with one of them only.
STARS = 2
SPACE = " \t\n\x0b\x0c\r"
_LOW = 0x100000001  # the lowest bit of both halves
_LEAST = -(1 << 63)


def terms(text: Column) -> Column:
    """Hashes of the terms of a text, with repetition; none for a text without words."""
    bare = F.btrim(F.lower(text), F.lit(SPACE))
    words = F.split(bare, f"[{SPACE}]+")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    return F.when(bare != "", pairs)


def fingerprints(texts: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """`keys` and `fingerprint`; 0 for a text without words. Votes are added up before the shuffle.

    One sum counts two bits, one in each half of a long: a text may have up to 2^31 terms.
    """
    votes = texts.select(*keys, F.explode_outer(terms(text)).alias("term"))
    halves = [F.shiftrightunsigned("term", j).bitwiseAND(F.lit(_LOW)) for j in range(32)]
    counted = votes.groupBy(*keys).agg(
        F.count("term").alias("cast_votes"), *[F.sum(x).alias(f"votes_{j}") for j, x in enumerate(halves)]
    )
    bits = []
    for j in range(32):
        low, high = F.col(f"votes_{j}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"votes_{j}", 32)
        for bit, count in ((j, low), (j + 32, high)):
            bits.append(F.when(count * 2 > F.col("cast_votes"), F.lit(_signed(1 << bit))).otherwise(F.lit(0)))
    one = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return counted.select(*keys, one.cast("long").alias("fingerprint"), (F.col("cast_votes") > 0).alias("has_words"))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the share of differing bits stands for, from 0 (unrelated) to 1 (same direction)."""
    return F.greatest(F.lit(0.0), F.cos(hamming(a, b) * (math.pi / 64)))


def table_masks(radius: int, blocks: int) -> list[int]:
    """For each permuted table the bits of the blocks that lead in it."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("needs 0 <= radius < blocks <= 64")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    own = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(chosen)) for chosen in combinations(own, blocks - radius)]


def near_links(
    prints: DataFrame,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    write: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """(a, b): links that connect all fingerprints that are within `radius` of each other by way of others.

    `prints` has distinct fingerprints in its one column. In a group of a table, members are first compared
    with one of them; what is connected then is not compared any more, so that a dense group costs its size.
    Members of different classes are compared with each other, and all links among them are found.
    """
    masks = table_masks(radius, blocks)
    leading = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("lead")) for t, m in enumerate(masks)]
    rows = prints.toDF("fp").select("fp", F.explode(F.array(*leading)).alias("k")).select("fp", "k.t", "k.lead")
    group = ["t", "lead"]
    shared = rows.groupBy(*group).count().where("count > 1").select(*group)
    members = write(rows.join(shared, group), "simhash-members").withColumn("class", F.col("fp"))
    near = hamming(F.col("fp"), F.col("other")) <= radius
    links = None
    for _ in range(STARS):
        # One of the last class is the centre, and all of other classes are compared with it.
        centre = members.groupBy(*group).agg(F.max(F.struct("class", F.col("fp").alias("other"))).alias("c"))
        centre = centre.select(*group, F.col("c.class").alias("other_class"), "c.other")
        stars = members.join(centre, group).where((F.col("class") != F.col("other_class")) & near)
        stars = stars.select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct()
        links = write(stars if links is None else links.unionByName(stars), "simhash-stars")
        classes = connected_components(links, write).select(F.col("node").alias("fp"), "component")
        members = members.drop("class").join(classes, "fp", "left")
        members = members.withColumn("class", F.coalesce("component", "fp")).drop("component")
        several = members.groupBy(*group).agg(F.min("class").alias("low"), F.max("class").alias("high"))
        members = write(members.join(several.where("low != high").select(*group), group), "simhash-open")
    others = members.select(*group, F.col("fp").alias("other"), F.col("class").alias("other_class"))
    rest = members.join(others, group).where((F.col("class") < F.col("other_class")) & near)
    rest = rest.select(F.col("fp").alias("a"), F.col("other").alias("b")).distinct()
    return write(links.unionByName(rest), "simhash-links")


def _next_rows(rows: DataFrame, write) -> DataFrame:
    """`rows` with the key of the next one, by descending id; the first one comes after the last."""
    order = [F.desc("id"), F.col("mark")]
    placed = write(numbered(rows.withColumn("all", F.lit("")), "all", order, write).drop("all"), "simhash-order")
    following = placed.select(F.col("index").alias("at"), F.col("id").alias("next_id"), F.col("mark").alias("next_mark"))
    joined = placed.join(following, (F.col("index") + 1) % F.col("total") == F.col("at"))
    return write(joined.drop("index", "total", "at"), "simhash-next")


def document_fingerprints(
    docs: DataFrame,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """Fingerprints of texts and of their edited texts, and classes of near ones; a row per row of `docs`.

    Columns: doc_id, n_chars, edited (text), fingerprint, edited_fingerprint (16 hexadecimal digits), near_edited
    and near_next (`likeness` to the edited and the next text), class_id (the smallest id within `radius`, also by
    way of others). In the edited text the last half of the characters has given way to as many first ones of the next
    document, by descending id, or to all that it has; after the last comes the first. With `digest`, `edited` is its SHA-256,
    so that edited texts are not carried on.

    NULL texts count as empty. Texts without words have a fingerprint of zeros and are in a class of
    their own. Rows of one id are ordered by a hash of the text, equal ones count once and have equal results;
    rows without id come last, in no class by themselves (NULL). An empty table gives an empty
    result, and only the two named columns are read.
    """
    scratch = Scratch(docs.sparkSession)
    write = scratch.write
    texts = two_columns(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    texts = texts.withColumn("id", F.coalesce("doc_id", F.lit(_LEAST)))
    texts = texts.withColumn("mark", F.xxhash64(F.col("doc_id").isNull(), "text"))
    key = ["id", "mark"]
    facts = texts.groupBy(*key).agg(F.max("doc_id").alias("doc_id"), F.max(F.length("text")).alias("n_chars"))
    order = _next_rows(facts, write)

    once = texts.groupBy(*key).agg(F.first("text").alias("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    asked = order.select(F.col("id").alias("for_id"), F.col("mark").alias("for_mark"), "n_chars", "next_id", "next_mark")
    heads = once.join(asked, (F.col("id") == F.col("next_id")) & (F.col("mark") == F.col("next_mark")))
    heads = heads.select(
        F.col("for_id").alias("id"), F.col("for_mark").alias("mark"), "n_chars", F.substring("text", F.lit(1), half).alias("head")
    )
    left = F.substring(F.col("text"), F.lit(1), F.col("n_chars") - half)
    edited = once.join(heads, key).select(*key, F.concat(left, "head").alias("text"))
    if digest:  # texts go straight into the votes
        edited = edited.withColumn("edited", F.unhex(F.sha2("text", 256)))
        changed = fingerprints(edited, [*key, "edited"], F.col("text"))
        changed = changed.withColumn("edited", F.lower(F.hex("edited")))
    else:
        edited = materialize(edited, "simhash-edited")
        changed = fingerprints(edited, key, F.col("text"))
    changed = write(changed.drop("has_words").withColumnRenamed("fingerprint", "edited_fingerprint"), "simhash-changed")

    own = write(fingerprints(texts, key, F.col("text")), "simhash-texts")
    following = own.select(
        F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("fingerprint").alias("next_fingerprint")
    )
    links = near_links(own.where("has_words").select("fingerprint").distinct(), radius, blocks, write)
    classes = connected_components(links, write)
    found = order.join(own, key).join(changed, key).join(following, ["next_id", "next_mark"])
    found = found.select(
        *key,
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.col("fingerprint").alias("own"),
        F.col("edited_fingerprint").alias("changed"),
        F.col("next_fingerprint").alias("following"),
        F.when(F.col("has_words"), F.col("fingerprint")).alias("near"),
        *(["edited"] if digest else []),
    )
    found = write(found, "simhash-found")
    named = found.join(classes, F.col("near") == F.col("node"), "left").withColumn("c", F.coalesce("component", "near"))
    least = named.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("class_id"))
    written = lambda name: F.lower(F.lpad(F.hex(name), 16, "0"))
    result = named.join(least, "c", "left").select(
        *key,
        "n_chars",
        written("own").alias("fingerprint"),
        written("changed").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        *(["edited"] if digest else []),
    )
    result = materialize(result, "simhash-result")
    scratch.clear()
    rows = texts.select("doc_id", *key).join(result, key)
    if not digest:
        rows = rows.join(edited.withColumnRenamed("text", "edited"), key)
    return rows.select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"
    )
