"""The registry of queries and their checking SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the test tables store them."""
    moments = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in moments})


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name. Days are UTC days, whatever zone the session came with."""

    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return naive_times(function(spark, sf_dir))

        name = function.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
