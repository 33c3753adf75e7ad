"""Run a registered query and its SQL, and compare the rows as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


# Names of the same type in Spark and in the SQL engine.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs; empty when columns and rows are the same."""
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    if sorted(sql_columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} and {sorted(sql_columns)}"]
    sql_types = {d[0]: str(d[1]) for d in result.description}
    other = {c: (t, sql_types[c]) for c, t in spark_df.dtypes if TYPES.get(t) != sql_types[c]}
    if other:
        return [f"types {other}"]
    order = sorted(sql_columns)
    expected = Counter(
        tuple(_plain(row[sql_columns.index(c)]) for c in order) for row in result.fetchall()
    )
    actual = Counter(tuple(_plain(row[c]) for c in order) for row in spark_df.collect())
    if not expected:
        return ["the SQL gives no row, so nothing is checked"]
    if actual == expected:
        return []
    only_spark, only_sql = list((actual - expected).items())[:3], list((expected - actual).items())[:3]
    return [f"rows {sum(actual.values())} and {sum(expected.values())}; spark {only_spark}; sql {only_sql}"]
