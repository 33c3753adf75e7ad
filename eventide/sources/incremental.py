"""Watermark-driven extraction: look up, extract, land, load, advance."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.context import utc_literal, wall_time
from eventide.schemas import CONTROL_SCHEMA
from eventide.storage import materialize, read_back, table_exists


def latest_watermarks(control: DataFrame) -> DataFrame:
    """The newest load time per pipeline and table."""
    return control.groupBy("pipeline_name", "table_name").agg(
        F.max("last_load_timestamp").alias("watermark")
    )


def lookup_watermark(control: DataFrame, pipeline: str, table: str) -> dt.datetime | None:
    """The newest load time of one table, None before its first load."""
    own = control.filter((F.col("pipeline_name") == pipeline) & (F.col("table_name") == table))
    value = own.agg(F.date_format(F.max("last_load_timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    return dt.datetime.fromisoformat(value) if value else None


def upper_bound(partition_date: str, upper: str = "end_of_day") -> tuple[str, dt.datetime]:
    """(comparison, moment) closing the range of one day.

    `end_of_day` ends with second 23:59:59, leaving rows of the last fraction of a second to the next
    run; `next_midnight` takes the day in full.
    """
    day = dt.datetime.fromisoformat(partition_date)
    if upper == "end_of_day":
        return "<=", day.replace(hour=23, minute=59, second=59)
    if upper == "next_midnight":
        return "<", day + dt.timedelta(days=1)
    raise ValueError(f"unknown upper bound {upper!r}")


def changed_between(
    column: str, watermark: dt.datetime | None, partition_date: str, upper: str = "end_of_day"
) -> Column:
    """Rows changed after the watermark (all earlier ones when there is none) up to a day's end."""
    op, end = upper_bound(partition_date, upper)
    bound = F.col(column) <= wall_time(end) if op == "<=" else F.col(column) < wall_time(end)
    return bound if watermark is None else (F.col(column) > wall_time(watermark)) & bound


def extract_changes(
    source: DataFrame,
    watermark: dt.datetime | None,
    partition_date: str,
    column: str = "updated_at",
    upper: str = "end_of_day",
) -> DataFrame:
    """The watermark is one value read beforehand, so the range is a literal the source can prune by."""
    return source.filter(changed_between(column, watermark, partition_date, upper))


def day_folder(folder: str, partition_date: str) -> str:
    return f"{folder.rstrip('/')}/{dt.date.fromisoformat(partition_date):%Y/%m/%d}"


def land_day(df: DataFrame, folder: str, partition_date: str) -> tuple[str, int]:
    """Write a day's extract as Snappy Parquet under folder/yyyy/MM/dd; a replay overwrites it."""
    path, seen = day_folder(folder, partition_date), Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path, seen.get["rows"]


def read_control(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], CONTROL_SCHEMA)
    return read_back(spark, path, CONTROL_SCHEMA)


def advance_watermark(
    spark: SparkSession, path: str, pipeline: str, table: str, moment: dt.datetime, rows: int
) -> None:
    """Append one control row. Call it last, after the load has succeeded."""
    row = spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(table).alias("table_name"),
        utc_literal(moment).alias("last_load_timestamp"),
        F.lit(rows).cast("long").alias("rows_copied"),
    )
    row.write.mode("append").parquet(path)


def typed_copy(df: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Cast every column to its target type; give (converted rows, rows that do not convert).

    Nothing is truncated or wrapped: a value that does not fit sends its row, as it came, to the second
    frame. Booleans are not numbers, so a Boolean source for a numeric target is refused outright.
    """
    have = {f.name: f.dataType for f in df.schema}
    for field in target:
        if isinstance(have[field.name], T.BooleanType) and isinstance(field.dataType, T.NumericType):
            raise TypeError(f"{field.name}: a Boolean is not converted to {field.dataType.simpleString()}")
    casts = {f.name: _exact_cast(f.name, have[f.name], f.dataType) for f in target}
    failed = F.lit(False)
    for name, value in casts.items():
        failed = failed | (F.col(name).isNotNull() & value.isNull())
    good = df.filter(~failed).select([v.alias(n) for n, v in casts.items()])
    return good, df.filter(failed)


def _exact_cast(name: str, source: T.DataType, target: T.DataType) -> Column:
    """The cast value, NULL where the cast fails or would lose digits or a time of day."""
    value, given = F.col(name).try_cast(target), F.col(name)
    if source == target:
        return value
    whole = None
    if isinstance(source, T.StringType):
        if isinstance(target, T.DecimalType):
            plain = r"^\s*[+-]?[0-9]*\.?([0-9]*)\s*$"
            digits = F.length(F.rtrim(F.regexp_extract(given, plain, 1), F.lit("0")))
            rounded = given.try_cast(T.DecimalType(38, 18)) == value  # with an exponent
            whole = F.when(given.rlike(plain), digits <= target.scale).otherwise(rounded)
        elif isinstance(target, T.DateType):
            whole = given.try_cast("timestamp") == value.cast("timestamp")
    elif isinstance(source, (T.NumericType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(target, (T.NumericType, T.DateType)):
            whole = value.try_cast(source) == given
    return value if whole is None else F.when(whole, value)


def ingest_day(
    spark: SparkSession,
    read_source: Callable[[], DataFrame],
    load: Callable[[DataFrame], object],
    control_path: str,
    folder: str,
    pipeline: str,
    table: str,
    partition_date: str,
    column: str = "updated_at",
    upper: str = "end_of_day",
    advance: str = "partition_date",
    schema: T.StructType | None = None,
) -> dict[str, object]:
    """Look up the watermark, land the changes, load them, then advance the watermark.

    Each step runs only after the one before it succeeded, so a failed run leaves the watermark alone
    and the next run takes the same range again. `advance` is `partition_date` (midnight at the start of
    the loaded day: the next run reads that day again, and the load must be an upsert) or `max_seen`.
    With a schema the rows are converted to it, and those that do not convert land in a folder of their own.
    """
    watermark = lookup_watermark(read_control(spark, control_path), pipeline, table)
    changes = extract_changes(read_source(), watermark, partition_date, column, upper)
    refused = 0
    if schema is not None:
        # The source is read once: read twice, a row that changes meanwhile could be in both parts or in none.
        changes, bad = typed_copy(materialize(changes, "changes"), schema)
        _, refused = land_day(bad, f"{folder.rstrip('/')}_refused", partition_date)
    path, rows = land_day(changes, folder, partition_date)
    landed = read_back(spark, path, changes.schema)
    outcome = load(landed)
    moment = dt.datetime.fromisoformat(partition_date)
    if advance == "max_seen":
        newest = landed.agg(F.date_format(F.max(column), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        moment = dt.datetime.fromisoformat(newest) if newest else watermark
    elif advance != "partition_date":
        raise ValueError(f"unknown way to advance the watermark: {advance!r}")
    if moment is not None:
        advance_watermark(spark, control_path, pipeline, table, moment, rows)
    return {"watermark": watermark, "path": path, "rows_copied": rows, "rows_refused": refused, "load": outcome}
