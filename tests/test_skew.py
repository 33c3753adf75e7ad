"""Queries on tables in which one key holds a third of the rows and some rows are there many times."""

import shutil

import duckdb
import pytest

import __spark_entry__ as entry
from eventide.catalogue import activity
from tests.compare import connect, differences
from tests.conftest import SMALL

QUERIES = [
    "append_rows",
    "bronze_append",
    "churn_features",
    "clustered_rows",
    "compact_rows",
    "customer_enrich",
    "daily_user_metrics",
    "dq_events",
    "dq_reconcile",
    "fct_events",
    "merge_incremental_lookback",
    "merge_upsert",
    "partition_replace",
    "same_day_transactions",
    "scd2_snapshot",
    "scd2_update",
    "session_windows_null_hot",
    "stg_dedup_first",
    "stg_events",
    "stream_daily_counts",
    "versioned_table",
    "zorder_rows",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the events under one user (half of these under one id), 200 copies of two others."""
    folder = tmp_path_factory.mktemp("skewed")
    for table in ("customer", "nation", "lineitem"):
        shutil.copy(f"{SMALL}/{table}.parquet", folder)
    duckdb.sql(
        f"""COPY (
          WITH e AS (SELECT *, hash(event_id) % 3 = 0 AS hot FROM '{SMALL}/events.parquet')
          SELECT CAST(CASE WHEN hot AND event_id % 2 = 0 THEN 5 ELSE event_id END AS BIGINT) AS event_id, ts,
            CAST(CASE WHEN hot THEN 3 ELSE user_id END AS BIGINT) AS user_id,
            CASE WHEN hot THEN 'error' ELSE event_type END AS event_type, value, props FROM e
          UNION ALL SELECT event_id, ts, user_id, 'error', value, props FROM e, range(200) WHERE event_id = 77
          UNION ALL SELECT event_id, ts, user_id, 'view', value, props FROM e, range(200) WHERE event_id = 78
        ) TO '{folder}/events.parquet'"""
    )
    duckdb.sql(
        f"""COPY (
          SELECT * REPLACE (
            CAST(CASE WHEN hash(o_orderkey) % 3 = 0 THEN 1 ELSE o_custkey END AS BIGINT) AS o_custkey,
            CASE WHEN hash(o_orderkey) % 3 = 0 THEN TIMESTAMP '1998-05-05' ELSE o_orderdate END AS o_orderdate)
          FROM '{SMALL}/orders.parquet'
        ) TO '{folder}/orders.parquet'"""
    )
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_rows_are_whole_under_skew(spark, skewed, monkeypatch, name):
    monkeypatch.setattr(activity, "SMALL_GROUP", 50)
    df = entry.queries()[name](spark, skewed)
    assert differences(df, connect(skewed), entry.oracle_sql()[name]) == []
