"""Merge: matched rows take the new values or go, unmatched source rows are added, all others stay."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import any_null, no_salt, salt_where_null
from eventide.operators.evolve import sync_columns
from eventide.operators.keyed import first_per_key
from eventide.operators.layout import clustered
from eventide.sources.lake import read_table
from eventide.storage import materialize, read_back, remove_path, scratch_path, table_exists


# Distinct partition values that one merge lists in a filter; a year of days fits.
MAX_LISTED = 1_000


class AmbiguousSource(ValueError):
    """Several source rows want to change the same target row."""


def ambiguous_keys(source: DataFrame, keys: Sequence[str], target: DataFrame | None = None) -> DataFrame:
    """Keys held by several source rows; with a target, only those that match a row of it."""
    repeated = (
        source.filter(~any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("source_rows"))
        .filter(F.col("source_rows") > 1)
    )
    if target is None:
        return repeated
    return repeated.join(target.select(*keys).distinct(), list(keys), "left_semi")


def merge_actions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], deletes: DataFrame | None = None
) -> DataFrame:
    """The merged table with a column `_action`: keep, update, insert or delete.

    Source rows are unique per key. `deletes` holds keys whose target rows go; a key that the source has as
    well is updated. Rows to delete are in the result with their old values. A key with NULL matches nothing, so such source rows are inserted and
    such target rows kept. Target rows go through one left join, which Spark broadcasts for a small
    source and splits for a hot key; rows with a NULL key are spread by a salt. A full join would read the
    target once only, but Spark can't split a hot key of a full join.
    """
    columns = target.columns
    if set(source.columns) != set(columns):
        raise ValueError(f"merge needs equal columns: {columns} and {source.columns}")
    complete = source.filter(~any_null(keys))
    named = [F.col(k).alias(f"_key_{k}") for k in keys]
    changes = complete.select(*named, no_salt(keys).alias("_zero"), F.struct(*columns).alias("_new"))
    changes = changes.withColumn("_gone", F.lit(False))
    if deletes is not None:
        gone = deletes.select(*keys).filter(~any_null(keys)).distinct()
        gone = gone.join(complete.select(*keys).distinct(), list(keys), "left_anti")
        none = F.lit(None).cast(changes.schema["_new"].dataType)
        gone = gone.select(*named, no_salt(keys).alias("_zero"), none.alias("_new"), F.lit(True).alias("_gone"))
        changes = changes.unionByName(gone)
    salted = target.withColumn("_salt", salt_where_null(keys, columns))
    matches = [F.col(k) == F.col(f"_key_{k}") for k in keys] + [F.col("_salt") == F.col("_zero")]
    changed = F.col("_new").isNotNull()
    action = F.when(F.col("_gone"), "delete").when(changed, "update").otherwise("keep")
    kept = salted.join(changes, reduce(lambda a, b: a & b, matches), "left").select(
        *[F.when(changed, F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in columns],
        action.alias("_action"),
    )
    known = target.select(*keys).filter(~any_null(keys)).distinct()
    added = complete.join(known, list(keys), "left_anti").unionByName(source.filter(any_null(keys)))
    return kept.unionByName(added.select(*columns, F.lit("insert").alias("_action")))


def merge_frames(
    target: DataFrame, source: DataFrame, keys: Sequence[str], deletes: DataFrame | None = None
) -> DataFrame:
    return merge_actions(target, source, keys, deletes).filter("_action != 'delete'").drop("_action")


def _counts() -> list[Column]:
    done = {"rows_inserted": "insert", "rows_updated": "update", "rows_deleted": "delete"}
    return [F.count_if(F.col("_action") == action).alias(name) for name, action in done.items()]


def merge_metrics(actions: DataFrame) -> DataFrame:
    """Rows inserted, updated and deleted."""
    return actions.agg(*_counts())


def on_values(target: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """The rows with one of these values; None stands for NULL."""
    some = [v for v in values if v is not None]
    wanted = F.col(column).isin(some) if some else F.lit(False)
    return target.where(wanted | F.col(column).isNull() if None in values else wanted)


def touched_partitions(
    target: DataFrame, changes: DataFrame, column: str, most: int = MAX_LISTED
) -> tuple[DataFrame, list[Any] | None]:
    """The rows of the target's partitions that occur in the changes, and these partitions' values.

    Spark prunes by values it knows when it plans, so up to `most` distinct ones are fetched and listed in
    the filter. Of more, only the least and the largest bound the scan and a semi join does the rest; the
    values are None then.
    """
    found = changes.select(column).distinct().limit(most + 1).collect()
    values = [r[0] for r in found]
    if len(values) <= most:
        return on_values(target, column, values), values
    bounds = changes.agg(F.min(column), F.max(column), F.count_if(F.col(column).isNull())).first()
    named = target.where(F.col(column).between(F.lit(bounds[0]), F.lit(bounds[1])))
    named = named.join(changes.select(column).distinct(), column, "left_semi")
    return (named.unionByName(target.where(F.col(column).isNull())) if bounds[2] else named), None


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition_by: str | None = None,
    evolve: bool = False,
    newest_by: str | None = None,
    schema: T.StructType | None = None,
    deletes: DataFrame | None = None,
    cluster_by: Sequence[str] = (),
    stored: bool = False,
) -> dict[str, Any]:
    """Merge rows into the Parquet table at `path` and return what was done.

    A missing table is created from the rows as they are. `deletes` holds keys whose rows go. When the
    partition column is a key, only the partitions that occur in the updates or deletes are read and
    rewritten, and one that loses all its rows is dropped. The merged rows are written to a staging
    folder first, since a folder cannot be overwritten while it is read; a reader that runs during
    the second write may see the table between two states, and a failed second write leaves the staging
    folder behind with all merged rows. `evolve` gives the table the columns of the
    updates (new ones added, missing ones dropped); where `schema` names them, untouched partitions stay as they
    are, since reading them by the schema does the same. Rows of a partition are laid out by `cluster_by`. With `newest_by` only the newest of several updates
    of one key counts; otherwise several updates of one target row are refused. `schema` is that of the
    table; without it the footers of all its files are read to find out. `stored` says that the updates are a
    table as read from its files, which needs no copy.
    """
    if newest_by:
        complete = first_per_key(updates.filter(~any_null(keys)), keys, [F.desc(newest_by)])
        updates = complete.unionByName(updates.filter(any_null(keys)))
    seen = Observation()
    if not table_exists(spark, path):
        counted = (seen, F.count(F.lit(1)).alias("rows_inserted"))
        _write(updates, path, partition_by, False, counted, cluster_by)
        return {"created": True, "rows_inserted": seen.get["rows_inserted"]}

    copy = scratch_path(spark, "updates")
    if newest_by or not stored:
        updates = materialize(updates, "updates", copy)  # used several times below
    target = read_table(spark, path, schema)
    if evolve:
        target = sync_columns(target, updates.schema)
    # Only where the source itself has a key several times does the target need to be asked.
    repeated = ambiguous_keys(updates, keys).limit(1).count()
    doubled = ambiguous_keys(updates, keys, target).limit(5).collect() if repeated else []
    if doubled:
        raise AmbiguousSource(f"several source rows match one target row: {[r.asDict() for r in doubled]}")

    pruned = partition_by in keys and (not evolve or schema is not None)
    touched = None
    if pruned:
        changes = updates.select(partition_by)
        if deletes is not None:
            changes = changes.unionByName(deletes.select(partition_by).dropna())
        target, touched = touched_partitions(target, changes, partition_by)

    actions = merge_actions(target, updates, keys, deletes).observe(seen, *_counts())
    staging = scratch_path(spark, "merge")
    merged = actions.filter("_action != 'delete'").drop("_action")
    merged.write.parquet(staging)
    merged = read_back(spark, staging, merged.schema)
    _write(merged, path, partition_by, pruned, cluster_by=cluster_by)
    if pruned and seen.get["rows_deleted"]:
        _drop_emptied(spark, path, merged, partition_by, touched, deletes)
    for used in (staging, copy):
        remove_path(spark, used)
    return {"created": False, **seen.get}


def _drop_emptied(
    spark: SparkSession, path: str, merged: DataFrame, column: str, touched: list[Any] | None, deletes: DataFrame
) -> None:
    """Remove the folders of partitions that lost all rows: a dynamic overwrite leaves what it has no rows for."""
    left = {r[0] for r in merged.select(F.col(column).cast("string")).distinct().collect()}  # one per partition
    if touched is None:
        values = {r[0] for r in deletes.select(F.col(column).cast("string")).dropna().distinct().collect()}
    else:
        listed = spark.createDataFrame([(v,) for v in touched], merged.select(column).schema)
        values = {r[0] for r in listed.select(F.col(column).cast("string")).dropna().collect()}
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values - left:
        remove_path(spark, f"{path}/{column}={escape(value)}")


def _write(
    df: DataFrame,
    path: str,
    partition_by: str | None,
    dynamic: bool,
    counted: tuple | None = None,
    cluster_by: Sequence[str] = (),
) -> None:
    """Overwrite a table or, if dynamic, its partitions that occur in `df`.

    Rows are counted after the last shuffle, where a task that runs again is not counted twice.
    """
    if partition_by and cluster_by:
        df = clustered(df, partition_by, cluster_by)
    elif partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    df = df.observe(*counted) if counted else df
    writer = df.write.mode("overwrite")
    if partition_by:
        mode = "dynamic" if dynamic else "static"
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", mode)
    writer.parquet(path)
