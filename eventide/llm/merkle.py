"""Merkle manifest of a table by butterfly exchange (operator 13).

Each row is a leaf; the leaves of a group, in order, are the lowest nodes of a tree in which every `fanout`
consecutive nodes have one parent. A task works on a partition of fanout ** levels leaves, aligned in the tree,
and hashes their subtree. Then partitions go up together: in round r, those of an aligned group of `fanout`
subtrees swap the roots, each with the one at its own place in every other subtree, and each
hashes the common ancestor for itself. After the last round every partition has the root and all siblings on
the way to it, so that proofs need no way down. The roots of the groups are the leaves of one more tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from eventide.llm.frames import Scratch, numbered
from eventide.storage import materialize

FANOUT = 16
LEVELS = 3
#: Siblings to the left and to the right of each node on the way to the root.
PROOF = "array<struct<before:string,after:string>>"
HEX = 64


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of values one after the other: each its length in bytes, a colon and itself, or `-` for NULL."""
    texts = [c.cast("string") for c in columns]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    up = lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256)
    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, from left to right."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda s: F.concat(s["before"], s["after"]))), 256)


def climb(nodes: bytes, fanout: int, levels: int | None) -> list[bytes]:
    """The nodes of each level as hexadecimal digests end to end: so many levels, or up to a single node."""
    out, step = [nodes], fanout * HEX
    while len(out) <= levels if levels is not None else len(out[-1]) > HEX:
        below = out[-1]
        digests = (hashlib.sha256(below[i : i + step]).hexdigest() for i in range(0, len(below), step))
        out.append("".join(digests).encode())
    return out


def _block_levels(total: int, fanout: int, levels: int) -> int | None:
    """A group of one block ends at its own root; blocks of a larger one all end at the same level."""
    return levels if total > fanout**levels else None


def _sorted(rows: pa.Table) -> tuple[pa.Table, bytes, int]:
    rows = rows.take(pa.array(np.argsort(rows["index"].to_numpy(), kind="stable")))
    return rows, "".join(rows["leaf"].to_pylist()).encode(), rows["total"][0].as_py()


def _blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(tree, block, blocks, node): the root of each block of leaves."""
    schema = "tree string, block long, blocks long, node string"
    arrow = to_arrow_schema(nodes.sparkSession.createDataFrame([], schema).schema)

    def work(rows: pa.Table) -> pa.Table:
        tree, block = rows["tree"][0].as_py(), rows["block"][0].as_py()
        _, leaves, total = _sorted(rows)
        root = climb(leaves, fanout, _block_levels(total, fanout, levels))[-1].decode()
        return pa.table([[tree], [block], [-(-total // fanout**levels)], [root]], schema=arrow)

    used = nodes.select("tree", "block", "index", "total", "leaf")
    return used.groupBy("tree", "block").applyInArrow(work, schema)


def butterfly(blocks: DataFrame, fanout: int, write: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """(tree, block, node, path): the root of its tree for each block, and the siblings on the way to it.

    A subtree at the right edge may be smaller than the others; it has partners for all of them by its places
    taken in turn. A block asks for `fanout` roots a round, whatever the number of blocks.
    """
    state = write(blocks.withColumn("path", F.array().cast(PROOF)), "butterfly")
    most = state.agg(F.max("blocks")).first()[0] or 0
    span = 1
    while span < most:
        mine = F.floor(F.col("block") / span)
        first = mine - mine % fanout
        last = F.least(first + fanout - 1, F.floor((F.col("blocks") - 1) / span))
        asked = state.where(F.col("blocks") > span).select(
            "tree", "block", "blocks", F.explode(F.sequence(first, last)).alias("other")
        )
        size = F.least(F.lit(span), F.col("blocks") - F.col("other") * span)
        partner = F.col("other") * span + F.col("block") % span % size
        asked = asked.select("tree", "block", "other", partner.alias("partner"))
        held = state.select("tree", F.col("block").alias("partner"), F.col("node").alias("root"))
        runs = asked.join(held, ["tree", "partner"]).groupBy("tree", "block")
        runs = runs.agg(F.array_sort(F.collect_list(F.struct("other", "root"))).alias("run"))  # `fanout` at most
        state = state.join(runs, ["tree", "block"], "left")
        side = lambda keep: F.concat_ws("", F.filter("run", keep)["root"])
        left, right = side(lambda x: x["other"] < mine), side(lambda x: x["other"] > mine)  # noqa: B023
        step = F.array(F.struct(left.alias("before"), right.alias("after")))
        moved = F.col("run").isNotNull()
        state = state.select(
            "tree",
            "block",
            "blocks",
            F.when(moved, F.sha2(F.concat_ws("", F.col("run")["root"]), 256)).otherwise(F.col("node")).alias("node"),
            F.when(moved, F.concat("path", step)).otherwise(F.col("path")).alias("path"),
        )
        state = write(state, "butterfly")
        span *= fanout
    return state.drop("blocks")


def _proofs(nodes: DataFrame, paths: DataFrame, fanout: int, levels: int) -> DataFrame:
    """`nodes` with what `paths` has of their block, and their proofs: siblings in the block, then those of its `path`."""
    kept = [c for c in nodes.columns if c not in ("tree", "block", "index", "total")]
    given = [c for c in paths.columns if c not in ("tree", "block", "path")]
    shape = nodes.select(*kept, *[F.lit("").alias(c) for c in given])
    fields = shape.withColumn("proof", F.array().cast(PROOF)).schema
    arrow = to_arrow_schema(fields)

    def work(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, leaves, total = _sorted(rows)
        upper = [(s["before"], s["after"]) for s in above["path"][0].as_py()]
        below = climb(leaves, fanout, _block_levels(total, fanout, levels))[:-1]
        below = [(level.decode(), fanout**k) for k, level in enumerate(below)]
        before, after = [], []
        for i in range(len(rows)):
            for level, width in below:
                at = i // width
                run = at - at % fanout
                before.append(level[run * HEX : at * HEX])
                after.append(level[(at + 1) * HEX : (run + fanout) * HEX])
            before += [x for x, _ in upper]
            after += [x for _, x in upper]
        steps = len(below) + len(upper)
        entry = arrow.field("proof").type.value_type
        pairs = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], fields=list(entry))
        cuts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * steps)
        proof = pa.ListArray.from_arrays(cuts, pairs)
        columns = [rows[c].combine_chunks() for c in kept]
        columns += [pa.repeat(pa.scalar(above[c][0].as_py(), pa.string()), len(rows)) for c in given]
        return pa.table([*columns, proof.cast(arrow.field("proof").type)], schema=arrow)

    return nodes.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(work, fields)


def _in_blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("index") / fanout**levels))


def manifest(
    docs: DataFrame,
    columns: list[str],
    group_col: str = "source",
    id_col: str = "doc_id",
    fanout: int = FANOUT,
    levels: int = LEVELS,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """doc_id, leaf, subroot (of the group), root (of the table) and `proof`; one row per row of `docs`.

    A leaf is the digest of the values of `columns`. Leaves of a group ascend by id, NULL first, then by
    digest, so rows that repeat have places of their own; groups ascend bytewise, NULL first. `proof` has the
    siblings of each level, from the leaf to the root; `fold` gives the root back. `also` are further
    columns to hand through. `levels` bounds the leaves that a task holds at once, fanout ** levels of them. An
    empty table gives an empty result, and names of other columns of `docs` do not matter.
    """
    scratch = Scratch(docs.sparkSession)
    also = also or {}
    # One letter before the name keeps the order of names and puts NULL in front.
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit("n"))
    leaves = docs.select(
        tree.alias("tree"),
        F.col(id_col).alias("doc_id"),
        leaf_digest([docs[c] for c in columns]).alias("leaf"),
        *[c.alias(name) for name, c in also.items()],
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    leaves = materialize(_in_blocks(numbered(leaves, "tree", order, scratch.write), fanout, levels), "leaves")
    own = butterfly(_blocks(leaves, fanout, levels), fanout, scratch.write)

    tops = own.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("node").alias("leaf"))
    tops = scratch.write(_in_blocks(numbered(tops, "tree", [F.col("name")], scratch.write), fanout, levels), "subroots")
    above = butterfly(_blocks(tops, fanout, levels), fanout, scratch.write).withColumnRenamed("node", "root")
    upper = _proofs(tops, above, fanout, levels).select(F.col("name").alias("tree"), "root", F.col("proof").alias("top"))
    paths = own.join(upper, "tree").select(
        "tree", "block", F.col("node").alias("subroot"), "root", F.concat("path", "top").alias("path")
    )
    paths = materialize(paths, "paths")
    scratch.clear()
    return _proofs(leaves, paths, fanout, levels).select("doc_id", "leaf", "subroot", "root", "proof", *also)
