"""Parallel range reads over JDBC."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from eventide.constants import RANGE_LOWER, RANGE_PARTS, RANGE_UPPER
from eventide.sources.incremental import upper_bound


def change_query(
    table: str, column: str, watermark: dt.datetime | None, partition_date: str, upper: str = "end_of_day"
) -> str:
    """The sub-query a database runs, so that only changed rows leave it. Names are plain or dotted ones."""
    for name in (table, column):
        if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*", name):
            raise ValueError(f"{name!r} is not a plain name")
    op, end = upper_bound(partition_date, upper)
    text = f"SELECT * FROM {table} WHERE {column} {op} TIMESTAMP '{end}'"
    if watermark is not None:
        text += f" AND {column} > TIMESTAMP '{watermark}'"
    return f"({text}) changes"


def read_database(
    spark: SparkSession,
    url: str,
    query: str,
    column: str = "id",
    lower: int = RANGE_LOWER,
    upper: int = RANGE_UPPER,
    parts: int = RANGE_PARTS,
    **options: str,
) -> DataFrame:
    """Read a table or sub-query with several connections, each taking a range of one column."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", query)
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", parts)
        .options(**options)
        .load()
    )
