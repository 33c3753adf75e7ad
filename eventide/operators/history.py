"""Table versions as a change log: every row carries its commit number, commit time and operation.

The log is a Parquet folder partitioned by commit number. Appending a commit, reading an old version,
listing commits and dropping old rows are queries over it. In a table with keys, a commit holds a key at most
once; rows whose key has a NULL are not bound by that.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.constants import RETENTION_HOURS
from eventide.context import utc_literal
from eventide.functions import any_null
from eventide.operators.keyed import first_per_key
from eventide.sources.lake import read_table
from eventide.storage import table_exists

VERSION, COMMITTED, OP = "_commit_version", "_commit_ts", "_op"
_LOG_SCHEMA = T.StructType(
    [
        T.StructField(COMMITTED, T.TimestampType()),
        T.StructField(OP, T.StringType()),
        T.StructField(VERSION, T.LongType()),
    ]
)
LOG_COLUMNS = _LOG_SCHEMA.names


def as_commit(df: DataFrame, version: int, committed: dt.datetime, op: str = "upsert") -> DataFrame:
    return df.withColumns(
        {VERSION: F.lit(version).cast("long"), COMMITTED: utc_literal(committed), OP: F.lit(op)}
    )


def append_commit(
    df: DataFrame, path: str, version: int, committed: dt.datetime, op: str = "upsert"
) -> None:
    """Add one commit. Writing the same commit number again replaces it, so a retry is harmless."""
    exists = table_exists(df.sparkSession, path)
    writer = as_commit(df, version, committed, op).write.mode("overwrite").partitionBy(VERSION)
    writer.option("partitionOverwriteMode", "dynamic" if exists else "static").parquet(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The log at a path; `schema` is that of the table's own columns, found in the files if not given."""
    if schema is not None:
        schema = T.StructType([*schema, *_LOG_SCHEMA])
    return read_table(spark, path, schema).withColumn(VERSION, F.col(VERSION).cast("long"))


def table_history(log: DataFrame, limit: int = 10) -> DataFrame:
    """The newest commits first, with their rows by operation."""
    return (
        log.groupBy(VERSION, COMMITTED)
        .agg(
            F.count_if(F.col(OP) != "delete").alias("rows_written"),
            F.count_if(F.col(OP) == "delete").alias("rows_deleted"),
        )
        .orderBy(F.desc(VERSION))
        .limit(limit)
    )


def version_at(log: DataFrame, as_of: dt.datetime) -> int:
    """The last commit made at or before a moment."""
    value = log.filter(F.col(COMMITTED) <= utc_literal(as_of)).agg(F.max(VERSION)).first()[0]
    if value is None:
        raise LookupError(f"the table has no version as of {as_of}")
    return value


def _span(log: DataFrame) -> tuple[int | None, int | None]:
    """First and last commit of a log."""
    return tuple(log.agg(F.min(VERSION), F.max(VERSION)).first())


def _latest(log: DataFrame, keys: Sequence[str] | None, first: int | None) -> DataFrame:
    """The newest row per key. Rows with a NULL key never replace each other.

    The first commit usually holds most rows. Its rows are not sorted with the others: those whose key
    occurs in no later commit stay, which takes no shuffle of them while the later commits are small.
    """
    if not keys or first is None:
        return log
    complete = log.filter(~any_null(keys))
    later = complete.filter(F.col(VERSION) > first)
    newest = first_per_key(later, keys, [F.desc(VERSION)])
    base = complete.filter(F.col(VERSION) == first)
    untouched = base.join(later.select(*keys), list(keys), "left_anti").select(*log.columns)
    rows = untouched.unionByName(newest).unionByName(log.filter(any_null(keys)))
    return rows.filter(F.col(OP) != "delete")


def read_version(
    log: DataFrame,
    version: int,
    keys: Sequence[str] | None = None,
    span: tuple[int | None, int | None] | None = None,
) -> DataFrame:
    """The table as commit `version` left it. Without keys every commit only adds rows.

    `span` gives the first and last commit where they are known without reading the log.
    """
    first, last = span or _span(log)
    if first is None or not first <= version <= last:
        raise LookupError(f"version {version} is not in the log, which holds {first} to {last}")
    return _latest(log.filter(F.col(VERSION) <= version), keys, first).drop(*LOG_COLUMNS)


def read_as_of(
    log: DataFrame,
    keys: Sequence[str] | None = None,
    as_of: dt.datetime | None = None,
    version: int | None = None,
    span: tuple[int | None, int | None] | None = None,
) -> DataFrame:
    """The table at a moment, at a version, or now. A moment goes before a version."""
    if as_of is not None:
        version = version_at(log, as_of)
    if version is not None:
        return read_version(log, version, keys, span)
    first = (span or _span(log))[0] if keys else None
    return _latest(log, keys, first).drop(*LOG_COLUMNS)


def vacuum(
    log: DataFrame,
    keys: Sequence[str],
    now: dt.datetime,
    retention_hours: int = RETENTION_HOURS,
    enforce: bool = True,
) -> DataFrame:
    """The log without rows that were replaced before the retention period began.

    Versions inside the period read as before. What the table held when the period began becomes the
    content of its first kept commit, so asking for an earlier version is an error afterwards, not a
    partial answer. Commits inside the period are not touched and need no shuffle.
    """
    if enforce and retention_hours < RETENTION_HOURS:
        raise ValueError(f"retention below {RETENTION_HOURS} hours would break readers of old versions")
    cutoff = now - dt.timedelta(hours=retention_hours)
    base = log.filter(F.col(COMMITTED) <= utc_literal(cutoff))
    newest = base.groupBy(VERSION).agg(F.max(COMMITTED).alias("at")).agg(
        F.min(VERSION).alias("first"),
        F.max(VERSION).alias("version"),
        F.date_format(F.max_by("at", VERSION), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
    ).first()
    if newest["version"] is None:
        return log
    rebased = _latest(log.filter(F.col(VERSION) <= newest["version"]), keys, newest["first"]).withColumns(
        {
            VERSION: F.lit(newest["version"]).cast("long"),
            COMMITTED: utc_literal(dt.datetime.fromisoformat(newest["at"])),
        }
    )
    return rebased.unionByName(log.filter(F.col(VERSION) > newest["version"]))
