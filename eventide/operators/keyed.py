"""One row per key, rows next to each other within a key, and how both stay even under hot keys."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.storage import materialize

# Rows of one key that one task may still sort on its own.
MAX_GROUP_ROWS = 2_000_000
# Rows, and bytes of all their values as text, of a table that may be sent to every task.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    Spark cuts each map task down to one row per key before the shuffle, so a key with any number of
    copies reaches its reducer as at most one row per map task. A hash over the row closes the order, so
    that a task run again picks the same row among equals.
    """
    whole = F.xxhash64(*[F.col(c) for c in df.columns])
    window = Window.partitionBy(*keys).orderBy(*order_by, whole)
    return (
        df.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast if its rows and their bytes, counted first, are few; else as it is.

    Spark guesses the size of a joined or filtered table from its inputs and may shuffle the large side for
    nothing. Counting the rows of stored tables reads no column; bytes are added up only where rows are few.
    """
    if df.count() > max_rows:
        return df
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df


def same_keys(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of two aliased frames on some columns, NULL being equal to NULL."""
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, pairs)


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    size: str | None = None,
    position: str | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the group size, the position in the group, and values of the rows before and after.

    `previous` and `following` map a new column to the column it is taken from. `order_by` should order the
    rows of a key completely; rows it leaves equal come in any order. NULL is a key like any other.

    A window gives a whole key to one task, which does not scale for a key that holds a large part of
    all rows. Keys above `max_group_rows` therefore go a second way with the same result: their rows are
    range-partitioned on key and order into even slices, numbered within each slice, and joined with
    what the slices before and after contribute. `df` is read more than once and should be a table.
    """
    want = _Wanted(list(keys), list(order_by), size, position, dict(previous or {}), dict(following or {}))
    if max_group_rows is None:
        return _within_one_task(df, want)
    hot = _larger_than(df, keys, max_group_rows)
    hot_rows = hot.agg(F.sum("_rows")).first()[0]
    if not hot_rows:
        return _within_one_task(df, want)
    few = small_side(hot)
    on = same_keys("d", "h", keys)
    rest = df.alias("d").join(few.alias("h"), on, "left_anti")
    heavy = df.alias("d").join(few.alias("h"), on, "left_semi")
    slices = max(2, math.ceil(2 * hot_rows / max_group_rows))
    return _within_one_task(rest, want).unionByName(_in_slices(heavy, want, slices))


@dataclass(frozen=True)
class _Wanted:
    """The columns to add, and the groups and order they refer to."""

    keys: list[str]
    order_by: list[str]
    size: str | None
    position: str | None
    previous: dict[str, str]
    following: dict[str, str]


def _larger_than(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys with more rows than the limit, and how many. Map tasks add up their rows of a key first."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return materialize(sizes.filter(F.col("_rows") > limit), "hot-keys")


def _within_one_task(df: DataFrame, want: _Wanted) -> DataFrame:
    """The plain window: Spark gives each key to one task."""
    group = Window.partitionBy(*want.keys)
    ordered = group.orderBy(*want.order_by)
    new = {}
    if want.position:
        new[want.position] = F.row_number().over(ordered).cast("long")
    new |= {out: F.lag(c).over(ordered) for out, c in want.previous.items()}
    new |= {out: F.lead(c).over(ordered) for out, c in want.following.items()}
    # The size comes second, so that it runs on the order the others need and costs no sort of its own.
    rows = df.withColumns(new) if new else df
    return rows.withColumn(want.size, F.count(F.lit(1)).over(group)) if want.size else rows


def _in_slices(heavy: DataFrame, want: _Wanted, slices: int) -> DataFrame:
    """The same columns for keys whose rows are cut into slices."""
    # Numbers given while reading files stay the same when a task runs again. They cut equal rows apart.
    numbered = materialize(heavy, "hot-rows").withColumn("_row", F.monotonically_increasing_id())
    order_by = [*want.order_by, "_row"]
    # The slice of a row must not change between the two uses below, so the rows are written once.
    ranged = numbered.repartitionByRange(slices, *want.keys, *order_by)
    rows = materialize(ranged.withColumn("_slice", F.spark_partition_id()), "slices")

    part = ["_slice", *want.keys]
    ordered = Window.partitionBy(*part).orderBy(*order_by)
    local = {"_at": F.row_number().over(ordered).cast("long")}
    local |= {out: F.lag(c).over(ordered) for out, c in want.previous.items()}
    local |= {out: F.lead(c).over(ordered) for out, c in want.following.items()}

    # One edge row per slice and key meeting in it.
    edges = small_side(materialize(_slice_edges(rows, want, part, order_by), "slice-edges"))
    joined = rows.withColumns(local).alias("l").join(edges.alias("e"), same_keys("l", "e", part))
    at_start, at_end = F.col("l._at") == 1, F.col("l._at") == F.col("e._rows")
    added = {}
    if want.size:
        added[want.size] = F.col("e._total")
    if want.position:
        added[want.position] = F.col("e._before") + F.col("l._at")
    for out in want.previous:
        added[out] = F.when(at_start, F.col(f"e._last.{out}")).otherwise(F.col(f"l.{out}"))
    for out in want.following:
        added[out] = F.when(at_end, F.col(f"e._first.{out}")).otherwise(F.col(f"l.{out}"))
    return joined.select(*[F.col(f"l.{c}") for c in heavy.columns], *[v.alias(k) for k, v in added.items()])


def _slice_edges(rows: DataFrame, want: _Wanted, part: list[str], order_by: list[str]) -> DataFrame:
    """Per slice and key: rows here, before and in all, the last row before and the first one after."""
    # Structs compare by their first fields, so the largest one carries the values of the last row.
    last = F.struct(*order_by, *[F.col(c).alias(o) for o, c in want.previous.items()])
    first = F.struct(*order_by, *[F.col(c).alias(o) for o, c in want.following.items()])
    edges = rows.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(last).alias("_last"), F.min(first).alias("_first")
    )
    across = Window.partitionBy(*want.keys)
    by_slice = across.orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(
        *part,
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(across).alias("_total"),
        F.lag("_last").over(by_slice).alias("_last"),
        F.lead("_first").over(by_slice).alias("_first"),
    )
