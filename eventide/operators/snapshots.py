"""Snapshots that keep every version of a row with the time span in which it was current."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.keyed import MAX_GROUP_ROWS, first_per_key, small_side, with_neighbours
from eventide.storage import materialize


def snapshot_history(
    rows: DataFrame,
    key: str,
    updated_at: str,
    tie_break: str,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """All versions of every key: valid from its own update up to the next one, open at the end.

    Of several rows of one key and time the one with the largest `tie_break` counts.
    """
    one_per_time = first_per_key(rows, [key, updated_at], [F.desc(tie_break)])
    if max_group_rows is not None:
        one_per_time = materialize(one_per_time, "snapshot")
    spans = with_neighbours(
        one_per_time,
        [key],
        [updated_at],
        following={"valid_to": updated_at},
        max_group_rows=max_group_rows,
    )
    return spans.withColumn("valid_from", F.col(updated_at))


def snapshot_update(
    snapshot: DataFrame, current: DataFrame, key: str, updated_at: str
) -> DataFrame:
    """Bring a snapshot up to date with the current rows of its source.

    Of several rows of one key the newest counts, and among equals the one a hash picks. Rows without a key
    can't be followed from run to run and are left out. An open version is closed when its row was updated since, and the new row is added as open version.
    Keys that vanished from the source keep their open version.
    """
    time = current.schema[updated_at].dataType
    current = first_per_key(current.filter(F.col(key).isNotNull()), [key], [F.desc(updated_at)])
    is_open = F.col("valid_to").isNull()
    news = current.select(F.col(key).alias("_key"), F.col(updated_at).alias("_updated_at"))
    opened = snapshot.filter(is_open)
    closed_now = F.col("_updated_at") > F.col("valid_from")
    held = (
        opened.join(news, F.col(key) == F.col("_key"), "left")
        .withColumn("valid_to", F.when(closed_now, F.col("_updated_at")).otherwise(F.col("valid_to")))
        .drop("_key", "_updated_at")
    )
    latest = opened.select(F.col(key).alias("_key"), F.col("valid_from").alias("_since"))
    added = (
        current.join(latest, F.col(key) == F.col("_key"), "left")
        .filter(F.col("_since").isNull() | (F.col(updated_at) > F.col("_since")))
        .drop("_key", "_since")
        .withColumns({"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast(time)})
    )
    return snapshot.filter(~is_open).unionByName(held).unionByName(added)



def snapshot_amend(
    snapshot: DataFrame,
    arrivals: DataFrame,
    key: str,
    updated_at: str,
    tie_break: str,
    vanished: DataFrame | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Bring versions into a snapshot in whatever order they arrive, and close keys that vanished.

    A version older than the open one, or than any other, splits the span in which it belongs, so that any order
    of arrival gives the spans of `snapshot_history`. `vanished` has the key and `closed_at`: the version that is
    current then ends there, and the key has none until one arrives that is newer; a closing of a key that has no version by then
    changes nothing. Of several versions of one key and time the one with the largest `tie_break`
    counts. Rows without a key can't be followed and are left out. Only spans of keys that arrive or vanish are
    computed anew; all other rows are passed through.
    """
    time = snapshot.schema[updated_at].dataType
    columns = [c for c in snapshot.columns if c not in ("valid_from", "valid_to")]
    arrivals = arrivals.filter(F.col(key).isNotNull()).select(*columns)
    moved = arrivals.select(key)
    if vanished is not None:
        vanished = vanished.filter(F.col(key).isNotNull() & F.col("closed_at").isNotNull())
        moved = moved.unionByName(vanished.select(key))
    moved = small_side(materialize(moved.distinct(), "moved-keys"))
    touched = materialize(snapshot.join(moved, key, "left_semi"), "moved-versions")
    rest = snapshot.alias("s").join(moved.alias("m"), F.col(f"s.{key}") == F.col(f"m.{key}"), "left_anti")

    versions = touched.select(*columns).unionByName(arrivals)
    versions = first_per_key(versions, [key, updated_at], [F.desc(tie_break)])
    # A span that ends where no version begins was closed: its end is an entry of its own.
    begins = touched.select(F.col(key).alias("_key"), F.col(updated_at).alias("_at"))
    ends = touched.filter(F.col("valid_to").isNotNull())
    ends = ends.join(begins, (F.col(key) == F.col("_key")) & (F.col("valid_to") == F.col("_at")), "left_anti")
    ends = ends.select(key, F.col("valid_to").alias("_end"))
    if vanished is not None:
        ends = ends.unionByName(vanished.select(key, F.col("closed_at").cast(time).alias("_end")))
    # Where a version begins at that very time, the key is not closed.
    taken = versions.select(F.col(key).alias("_key"), F.col(updated_at).alias("_at"))
    ends = ends.distinct().join(taken, (F.col(key) == F.col("_key")) & (F.col("_end") == F.col("_at")), "left_anti")
    entries = versions.withColumns({"_end": F.lit(None).cast(time), "_entry": F.col(updated_at)}).unionByName(
        ends.withColumn("_entry", F.col("_end")), allowMissingColumns=True
    )
    entries = materialize(entries, "span-entries")
    spans = with_neighbours(
        entries, [key], ["_entry"], following={"valid_to": "_entry"}, max_group_rows=max_group_rows
    )
    amended = spans.filter(F.col("_end").isNull()).withColumn("valid_from", F.col(updated_at))
    return rest.select(*snapshot.columns).unionByName(amended.select(*snapshot.columns))


def vanished_keys(snapshot: DataFrame, current: DataFrame, key: str, closed_at: Column) -> DataFrame:
    """Keys with an open version that are not in the current extract, with the time at which they close."""
    opened = snapshot.filter(F.col("valid_to").isNull() & F.col(key).isNotNull()).select(key).distinct()
    gone = opened.join(current.select(key).distinct(), key, "left_anti")
    return gone.withColumn("closed_at", closed_at)
