"""How rows lie in files: compaction, clustering within a day, and Z-order."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.constants import COMPACT_TARGET_MB
from eventide.storage import list_files

_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: str | None = None,
    target_mb: int = COMPACT_TARGET_MB,
) -> tuple[int, int]:
    """Rewrite a table folder into few files of about the target size; give file counts before, after.

    The rebalance step joins small files and splits large partitions at run time, copies included.
    """
    before = spark.conf.get(_ADVISORY, None)
    spark.conf.set(_ADVISORY, f"{target_mb}m")
    try:
        rows = spark.read.option("mergeSchema", "true").parquet(source)
        if partition_by:
            rows.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by).parquet(target)
        else:
            rows.hint("rebalance").write.parquet(target)
    finally:
        if before is None:
            spark.conf.unset(_ADVISORY)
        else:
            spark.conf.set(_ADVISORY, before)
    return len(list_files(spark, source)), len(list_files(spark, target))


def _last_key(df: DataFrame, stored: bool) -> Column:
    """What cuts rows that are equal in all sort columns.

    A hash over the row cuts everything but exact copies. A row number cuts these as well, but only for rows
    read straight from files does it stay the same when a task runs again.
    """
    return F.monotonically_increasing_id() if stored else F.xxhash64(*[F.col(c) for c in df.columns])


def clustered(
    df: DataFrame, day: str, columns: Sequence[str], files: int | None = None, stored: bool = False
) -> DataFrame:
    """Rows ordered by day and clustering columns, cut into even ranges, frequent combinations too.

    `stored` says that `df` is a table as read from its files.
    """
    df, names = df.withColumn("_last", _last_key(df, stored)), df.columns
    order = [F.col(day), *[F.col(c) for c in columns], F.col("_last")]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(day, *columns).select(*names)


def column_bounds(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list[Any]]:
    """Values that cut each column into about even buckets.

    Numbers and times are cut at approximate percentiles, all of them in one aggregation. Text has none in Spark: it is
    dealt into ranges, which Spark cuts by a sample of the values, and the least value of each range is a bound.
    """
    shares = [i / buckets for i in range(1, buckets)]
    types = dict(df.dtypes)
    numbers = [c for c in columns if types[c] != "string"]
    found = df.agg(*[F.percentile_approx(c, shares).alias(c) for c in numbers]).first() if numbers else {}
    return {c: sorted(set(found[c] or [])) if c in numbers else _text_bounds(df, c, buckets) for c in columns}


def _text_bounds(df: DataFrame, column: str, buckets: int) -> list[str]:
    ranged = df.select(column).dropna().repartitionByRange(buckets, column)
    lowest = ranged.groupBy(F.spark_partition_id()).agg(F.min(column).alias("low")).collect()  # a row for each bucket
    return sorted(r.low for r in lowest)[1:]


def bucket_of(column: str | Column, bounds: Sequence[Any]) -> Column:
    """How many bounds lie at or below the value, found by halving; NULL goes to bucket 0."""
    value = F.col(column) if isinstance(column, str) else column

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(
            search(low, middle)
        )

    return search(0, len(bounds)) if bounds else F.lit(0)


def z_value(buckets: Sequence[Column], bits: int) -> Column:
    """Interleave the bits of the bucket numbers."""
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for place, bucket in enumerate(buckets):
            one = F.shiftright(bucket.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(buckets) + place))
    return z


def z_ordered(
    df: DataFrame,
    columns: Sequence[str],
    bits: int | None = None,
    files: int | None = None,
    within: Sequence[str] = (),
    stored: bool = False,
) -> DataFrame:
    """Rows laid out along a Z-curve over some columns, so that filters on any of them skip files.

    Partition columns of the table go to `within`: rows are kept together by them first. Among the Z-order
    columns they would be useless, having one value per partition. There are about four cells for each
    file, unless `bits` says otherwise; rows of one cell are ordered by the columns, so its files don't overlap.
    """
    if bits is None:
        parts = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bits = max(1, math.ceil(math.log2(4 * parts) / len(columns)))
    bounds = column_bounds(df, columns, 2**bits)
    z = z_value([bucket_of(c, bounds[c]) for c in columns], bits)
    with_z = df.withColumns({"_z": z, "_last": _last_key(df, stored)})
    order = [*[F.col(c) for c in within], F.col("_z"), *[F.col(c) for c in columns], F.col("_last")]
    ranged = with_z.repartitionByRange(files, *order) if files else with_z.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*within, "_z", *columns).drop("_z", "_last")
