"""Schema changes: adding columns, merging schemas by addition, following a new schema."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def add_column(df: DataFrame, name: str, data_type: T.DataType, nullable: bool = True) -> DataFrame:
    """A new column of NULLs at the end; an existing column is left alone with a warning.

    Stored rows are not rewritten: readers ask for the longer schema and old files give NULL.
    """
    if name in df.columns:
        log.warning("column %s already exists, nothing is added", name)
        return df
    if not nullable and not df.isEmpty():
        raise ValueError(f"column {name} cannot be required: the table already has rows")
    return df.withColumn(name, F.lit(None).cast(data_type))


def append_additive(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append by name; columns that one side lacks are NULL there."""
    for field in rows.schema:
        if field.name in table.columns and table.schema[field.name].dataType != field.dataType:
            raise TypeError(f"column {field.name} changes its type, which is not an addition")
    return table.unionByName(rows, allowMissingColumns=True)


def sync_columns(table: DataFrame, schema: T.StructType) -> DataFrame:
    """The table in a new schema: new columns NULL, missing ones dropped, changed types cast.

    A value that does not fit its new type stops the job.
    """
    have = set(table.columns)
    return table.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
