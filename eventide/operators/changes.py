"""What changed between two extracts of a table, and a table brought up to date with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import any_null, row_hashes
from eventide.operators.keyed import first_per_key
from eventide.operators.merge import AmbiguousSource, merge_frames
from eventide.storage import materialize

CHANGE = "_change"


def key_states(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key what both extracts hold: rows and the least and largest row hashes of either side.

    One aggregation over both, so a key with very many rows reaches its task as one row per map task, where
    a full join would bring all of them there.
    """
    columns = old.columns
    a, b = row_hashes(columns)
    sides = [
        side.select(*keys, F.lit(flag).alias("_is_new"), a.alias("_a"), b.alias("_b"))
        for side, flag in ((old, False), (new.select(*columns), True))
    ]
    aggregates = []
    for name, mine in (("old", ~F.col("_is_new")), ("new", F.col("_is_new"))):
        aggregates.append(F.count_if(mine).alias(f"{name}_rows"))
        for h in ("a", "b"):
            value = F.when(mine, F.col(f"_{h}"))
            aggregates += [F.min(value).alias(f"{name}_{h}"), F.max(value).alias(f"{name}_{h}_last")]
    return sides[0].unionByName(sides[1]).groupBy(*keys).agg(*aggregates)


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that turn `old` into `new`, with a column `_change`: insert, update or delete.

    Updates and inserts have the new values, deletes the old ones. A key holds one row in each extract, which
    may be there several times; different rows of one key are refused. Rows with a NULL in their key can't be followed
    from one extract to the other, so they are compared as whole rows, as often as they occur: what `new` has
    more of is inserted, what it has less of deleted.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"extracts have different columns: {old.columns} and {new.columns}")
    columns, whole = old.columns, ~any_null(keys)
    states = key_states(old.filter(whole), new.filter(whole), keys)
    same = (F.col("old_a") == F.col("new_a")) & (F.col("old_b") == F.col("new_b"))
    several = [F.col(f"{s}_{h}") != F.col(f"{s}_{h}_last") for s in ("old", "new") for h in ("a", "b")]
    several = several[0] | several[1] | several[2] | several[3]
    change = (
        F.when(F.coalesce(several, F.lit(False)), "ambiguous")
        .when(F.col("old_rows") == 0, "insert")
        .when(F.col("new_rows") == 0, "delete")
        .when(~same, "update")
    )
    changed = materialize(states.select(*keys, change.alias(CHANGE)).dropna(subset=[CHANGE]), "changed-keys")
    doubled = changed.filter(F.col(CHANGE) == "ambiguous").limit(5).collect()
    if doubled:
        raise AmbiguousSource(f"different rows of one key: {[r.asDict() for r in doubled]}")
    named = [F.lit(kind).alias(CHANGE) for kind in ("insert", "delete")]
    parts = [
        first_per_key(side.select(*columns).join(changed.filter(kinds), list(keys)), keys, [])
        for side, kinds in ((new, f"{CHANGE} != 'delete'"), (old, f"{CHANGE} = 'delete'"))
    ]
    without = [side.filter(any_null(keys)).select(*columns) for side in (old, new)]
    parts.append(without[1].exceptAll(without[0]).select(*columns, named[0]))
    parts.append(without[0].exceptAll(without[1]).select(*columns, named[1]))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select(*columns, CHANGE)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with changes that `snapshot_changes` found; applied to its `old`, it gives its `new`.

    Rows with a NULL in their key go by their values, one for each row to delete.
    """
    gone, complete = F.col(CHANGE) == "delete", ~any_null(keys)
    columns = target.columns
    rows = changes.filter(complete & ~gone).select(*columns)
    merged = merge_frames(target.filter(complete), rows, keys, changes.filter(complete & gone))
    loose = target.filter(~complete).exceptAll(changes.filter(~complete & gone).select(*columns))
    return merged.unionByName(loose).unionByName(changes.filter(~complete & ~gone).select(*columns))
