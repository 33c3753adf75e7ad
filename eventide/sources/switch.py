"""Tables that are switched as a whole: new rows are written beside the old ones, then the catalog points to them.

A folder cannot be replaced at once, a location in the catalog can. Readers see the old rows up to the switch
and the new ones from then on; a write that fails leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.layout import clustered
from eventide.operators.merge import AmbiguousSource, ambiguous_keys, merge_actions, touched_partitions
from eventide.storage import list_folders, materialize, remove_path


def _quoted(text: Any) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fresh(root: str) -> str:
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"


def create_table(spark: SparkSession, name: str, schema: T.StructType, root: str, partition_by: str | None = None) -> None:
    """An empty table whose rows will lie in folders below `root`."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    place = _fresh(root)
    spark.createDataFrame([], schema).write.parquet(place)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION {_quoted(place)}")


def switch_table(spark: SparkSession, name: str, df: DataFrame, root: str) -> str:
    """Replace all rows of a table without partitions. The new folder is returned; the old one stays."""
    place = _fresh(root)
    df.select(*spark.table(name).columns).write.parquet(place)
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(place)}")
    spark.catalog.refreshTable(name)
    return place


def _folder(spark: SparkSession, place: str, column: str, value: Any) -> str:
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
    return f"{place}/{column}={named}"


def _locations(spark: SparkSession, name: str) -> dict[str, str]:
    """Where the partitions of a table lie, by value; the catalog lists them without looking into folders."""
    state = spark._jsparkSession.sessionState()
    table = state.sqlParser().parseTableIdentifier(name)
    none = spark._jvm.scala.Option.empty()
    found, out = state.catalog().listPartitions(table, none).iterator(), {}
    while found.hasNext():
        part = found.next()
        out[part.spec().values().head()] = part.location().toString()
    return out


def switch_partitions(
    spark: SparkSession, name: str, df: DataFrame, column: str, values: Sequence[Any], root: str, cluster_by: Sequence[str] = ()
) -> str | None:
    """Replace some partitions: `df` holds their new rows and no others; one without rows is taken out.

    All rows are written before the first partition is switched. Each partition is switched at once, one after
    the other; if that is cut short, every partition has either its old or its new rows, and a rerun completes it.
    """
    place = _fresh(root)
    counts = Observation()
    text = F.col(column).cast("string")
    per_value = [F.count_if(text == str(v)).alias(f"p{i}") for i, v in enumerate(values)]
    if not values:
        return None
    laid_out = clustered(df, column, cluster_by) if cluster_by else df.hint("rebalance", F.col(column))
    laid_out.observe(counts, *per_value).write.partitionBy(column).parquet(place)
    known = _locations(spark, name)
    for i, value in enumerate(values):
        part = f"PARTITION (`{column}` = {_quoted(value)})"
        if not counts.get[f"p{i}"]:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")
        else:
            folder = _quoted(_folder(spark, place, column, value))
            change = f"{part} SET LOCATION {folder}" if str(value) in known else f"ADD {part} LOCATION {folder}"
            spark.sql(f"ALTER TABLE {name} {change}")
    spark.catalog.refreshTable(name)
    return place


def upsert_switched(
    spark: SparkSession,
    name: str,
    updates: DataFrame,
    keys: Sequence[str],
    column: str,
    root: str,
    deletes: DataFrame | None = None,
    cluster_by: Sequence[str] = (),
) -> dict[str, int]:
    """Merge rows into a table partitioned by `column`, one of the keys, and switch the touched partitions.

    Only these are read and written. Updates and deletes without a partition value are refused, since the catalog
    has no partition for them.
    """
    if column not in keys:
        raise ValueError(f"the partition column {column} must be a key")
    updates = materialize(updates.select(*spark.table(name).columns), "updates")
    changes = updates.select(column)
    if deletes is not None:
        changes = changes.unionByName(deletes.select(column))
    if changes.filter(F.col(column).isNull()).limit(1).count():
        raise ValueError(f"rows without {column}")
    doubled = ambiguous_keys(updates, keys).limit(5).collect()
    if doubled:
        raise AmbiguousSource(f"several source rows of one key: {[r.asDict() for r in doubled]}")
    target, touched = touched_partitions(spark.table(name), changes, column)
    if touched is None:  # more than are listed in a filter; one for each partition
        touched = [r[0] for r in changes.distinct().collect()]
    done = Observation()
    counted = {"rows_inserted": "insert", "rows_updated": "update", "rows_deleted": "delete"}
    actions = merge_actions(target, updates, keys, deletes)
    actions = actions.observe(done, *[F.count_if(F.col("_action") == a).alias(n) for n, a in counted.items()])
    merged = materialize(actions.filter("_action != 'delete'").drop("_action"), "merged")
    switch_partitions(spark, name, merged, column, touched, root, cluster_by)
    return done.get


def remove_unused(spark: SparkSession, name: str, root: str) -> list[str]:
    """Delete the folders below `root` that the table no longer points to, once no reader uses them any more."""
    state = spark._jsparkSession.sessionState()
    table = state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(name))
    used = [*_locations(spark, name).values()] if table.partitionColumnNames().size() else []
    used.append(table.location().toString())
    gone = [f for f in list_folders(spark, root) if f.startswith("v-") and not any(f"/{f}" in u for u in used)]
    for folder in gone:
        remove_path(spark, f"{root.rstrip('/')}/{folder}")
    return gone
