"""Seed files, newly landed files, and registration of table folders in the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_seed(spark: SparkSession, path: str, schema: T.StructType | str, table: str | None = None) -> DataFrame:
    """A CSV file with a header and a declared schema; saved as a table when a name is given."""
    seed = spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")
    if table:
        seed.write.mode("overwrite").saveAsTable(table)
        return spark.table(table)
    return seed


def take_landed(
    spark: SparkSession,
    raw: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str,
    file_format: str = "json",
) -> None:
    """Append files that landed since the last call to a table; each file is taken exactly once."""
    landed = spark.readStream.schema(schema).format(file_format).load(raw)
    run = (
        landed.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    run.awaitTermination()


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partition_by: str,
    values: Sequence[str] = (),
) -> DataFrame:
    """Make a partitioned folder known to the catalog and register its new partitions.

    With values only these partitions are added, as a daily run does; without, all folders are listed.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY (`{partition_by}`) LOCATION '{place}'"
    )
    if values:
        parts = " ".join(f"PARTITION (`{partition_by}` = '{v}')" for v in values)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    else:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)
