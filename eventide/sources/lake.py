"""Lake tables in Parquet folders: gated appends, filtered scans, day replacement."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.constants import ROWS_PER_FILE
from eventide.functions import all_of
from eventide.operators.layout import clustered
from eventide.schemas import EVENTS_SCHEMA, SchemaMismatch, compare_schemas
from eventide.storage import list_folders, remove_path, table_exists


@dataclass(frozen=True)
class Lake:
    """A root folder with one sub-folder per layer and one folder per table below it."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    filters: Sequence[tuple[str, str, Any]] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Scan a table; filters and columns reach the Parquet reader.

    Without a schema the columns of all files are joined by name, so rows written before a column was
    added read as NULL there. That reads every file's footer; for a large table pass the schema.
    """
    if schema is not None:
        df = spark.read.schema(schema).parquet(path)
    else:
        df = spark.read.option("mergeSchema", "true").parquet(path)
    df = df.filter(all_of(filters)) if filters else df
    return df.select(*columns) if columns else df


def required_nulls(df: DataFrame, schema: T.StructType) -> dict[str, int]:
    """NULL counts of the columns declared not null, all of them in one pass."""
    required = [f.name for f in schema if not f.nullable and f.name in df.columns]
    if not required:
        return {}
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    return {c: counts[c] for c in required if counts[c]}


def _refusing_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same rows; reading a NULL in a required column stops the job, and its write with it."""

    def checked(field: T.StructField):
        stop = F.raise_error(F.lit(f"NULL in required column {field.name}")).cast(field.dataType)
        return F.coalesce(F.col(field.name), stop)

    return df.withColumns({f.name: checked(f) for f in schema if not f.nullable})


def conform(df: DataFrame, schema: T.StructType, mode: str = "strict") -> DataFrame:
    """Let rows through only if they have the declared schema.

    `strict` refuses every difference; `additive` lets new columns in (they come after the declared
    ones) and puts columns in declared order. Names and types are compared at once; required columns are
    checked while the rows are written, without another pass.
    """
    diff = compare_schemas(df.schema, schema)
    if mode == "strict":
        if diff:
            raise SchemaMismatch(f"schema differs from the declared one: {diff}")
    elif mode == "additive":
        if not diff.additive_only:
            raise SchemaMismatch(f"schema is not an addition to the declared one: {diff}")
        df = df.select(*schema.names, *diff.extra)
    else:
        raise ValueError(f"unknown schema mode {mode!r}")
    return _refusing_nulls(df, schema)


def write_days(
    df: DataFrame,
    path: str,
    day: str,
    mode: str = "append",
    rows_per_file: int = ROWS_PER_FILE,
    dynamic: bool = False,
    cluster_by: Sequence[str] = (),
    counts: Sequence[Column] = (),
) -> dict[str, int]:
    """Write rows into day folders and return their number, and other counts, taken while writing.

    The rebalance step gathers a day's rows into files of even size and, at run time, cuts a day that is
    much larger than the others into several tasks. With clustering columns the rows are cut into ranges
    of day and columns instead.
    """
    seen = Observation()
    laid_out = clustered(df, day, cluster_by) if cluster_by else df.hint("rebalance", F.col(day))
    rows = laid_out.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    writer = rows.write.mode(mode).partitionBy(day).option("maxRecordsPerFile", rows_per_file)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return seen.get


def append_bronze(
    df: DataFrame,
    path: str,
    schema: T.StructType = EVENTS_SCHEMA,
    mode: str = "append",
    schema_mode: str = "strict",
    day: str = "_partition_date",
) -> int:
    """Append raw rows to the bronze table, partitioned by day, if they pass the schema gate."""
    return write_days(conform(df, schema, schema_mode), path, day, mode)["rows"]


def replace_days(
    df: DataFrame, path: str, day: str, days: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> int:
    """Replace the days present in `df`, and empty those in `days` for which it holds no row.

    Spark's dynamic overwrite touches only days that have rows; a day that became empty must be
    dropped by hand, or its old rows would stay.
    """
    spark = df.sparkSession
    named = F.date_format(F.col(day), "yyyy-MM-dd")
    per_day = [F.count_if(named == d).alias(f"day {d}") for d in days]
    exists = table_exists(spark, path)
    written = write_days(df, path, day, "overwrite", dynamic=exists, cluster_by=cluster_by, counts=per_day)
    empty = {f"{day}={d}" for d in days if not written[f"day {d}"]}
    for name in list_folders(spark, path):
        if name in empty:
            remove_path(spark, f"{path}/{name}")
    return written["rows"]
