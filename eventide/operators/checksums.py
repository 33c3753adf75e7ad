"""Reconciliation of two copies of a table by nested checksums, down to the keys that differ.

Rows are summed up by day and key bucket in a way that their order does not matter. Days whose sums agree hold the
same rows; of the others, only the buckets that differ are read once more, and their keys are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import row_hashes
from eventide.operators.changes import key_states
from eventide.operators.keyed import same_keys
from eventide.operators.merge import touched_partitions
from eventide.storage import materialize

BUCKETS = 256
SUMS = ["rows", "xor_a", "xor_b", "sum_a"]


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(row_hashes(keys)[0], F.lit(buckets)).cast("int")


def block_sums(df: DataFrame, day: str, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Checksums of the rows of each day and key bucket: one aggregation, at most `buckets` rows for a day.

    Two hashes of all columns are combined by exclusive or, and one is added up too (its upper half, so that
    two billion rows fit): a row that is there twice cancels out of the former, but not of the sum or the count.
    """
    a, b = row_hashes(columns)
    hashed = df.select(F.col(day).alias("day"), _bucket(keys, buckets).alias("bucket"), a.alias("a"), b.alias("b"))
    return hashed.groupBy("day", "bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor("a").alias("xor_a"),
        F.bit_xor("b").alias("xor_b"),
        F.sum(F.shiftrightunsigned("a", 32)).alias("sum_a"),
    )


def _day_sums(blocks: DataFrame) -> DataFrame:
    """Checksums of days from those of their blocks."""
    return blocks.groupBy("day").agg(
        F.sum("rows").alias("rows"),
        F.bit_xor("xor_a").alias("xor_a"),
        F.bit_xor("xor_b").alias("xor_b"),
        F.sum("sum_a").alias("sum_a"),
    )


def _unequal(left: DataFrame, right: DataFrame, level: Sequence[str]) -> DataFrame:
    """What of a level differs, or is on one side only."""
    both = left.select(*level, *SUMS).unionByName(right.select(*level, *SUMS))
    found = both.groupBy(*level, *SUMS).count().filter("count = 1")  # equal ones come in pairs
    return found.select(*level).distinct()


def differing_blocks(left: DataFrame, right: DataFrame) -> DataFrame:
    """(day, bucket) of the blocks that differ, from the `block_sums` of both sides; day by day first."""
    days = materialize(_unequal(_day_sums(left), _day_sums(right), ["day"]), "unequal-days")
    if not days.limit(1).count():
        return days.withColumn("bucket", F.lit(0)).limit(0)
    sides = [s.alias("s").join(days.alias("d"), same_keys("s", "d", ["day"]), "left_semi") for s in (left, right)]
    return _unequal(*sides, ["day", "bucket"])


def reconcile_rows(
    left: DataFrame,
    right: DataFrame,
    day: str,
    keys: Sequence[str],
    columns: Sequence[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """The keys in which two copies of a table differ: day, keys, left_rows, right_rows and `difference`.

    `difference` is missing (not on the right), extra (not on the left), copied (the same rows, another number of
    times) or changed. NULL is a day and a key like any other. Where both sides are equal, each is read once and
    nothing else is done.
    """
    sums = [materialize(block_sums(s, day, keys, columns, buckets), "block-sums") for s in (left, right)]
    blocks = materialize(differing_blocks(*sums), "unequal-blocks")
    sides = []
    for side in (left, right):
        rows, _ = touched_partitions(side, blocks.select(F.col("day").alias(day)), day)
        rows = rows.select(*dict.fromkeys([day, *keys, *columns])).withColumn("bucket", _bucket(keys, buckets))
        rows = rows.withColumn("day", F.col(day)).alias("s")
        near = rows.join(blocks.alias("b"), same_keys("s", "b", ["day", "bucket"]), "left_semi")
        sides.append(near.select(*dict.fromkeys([day, *keys, *columns])))
    states = key_states(*sides, [day, *[k for k in keys if k != day]])
    ends = [f"{h}{end}" for h in ("a", "b") for end in ("", "_last")]
    same = F.col(f"old_{ends[0]}") == F.col(f"new_{ends[0]}")
    for end in ends[1:]:
        same = same & (F.col(f"old_{end}") == F.col(f"new_{end}"))
    difference = (
        F.when(F.col("new_rows") == 0, "missing")
        .when(F.col("old_rows") == 0, "extra")
        .when(~same, "changed")
        .when(F.col("old_rows") != F.col("new_rows"), "copied")
    )
    found = states.withColumn("difference", difference).dropna(subset=["difference"])
    return found.select(
        *dict.fromkeys([day, *keys]),
        F.col("old_rows").alias("left_rows"),
        F.col("new_rows").alias("right_rows"),
        "difference",
    )
