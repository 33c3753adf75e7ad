"""Queries on data tests, gates, reconciliation and personal data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.catalogue import roles
from eventide.catalogue.registry import query
from eventide.constants import ACCEPTED_EVENT_TYPES, FRESHNESS_EVENTS, FRESHNESS_TRANSACTIONS
from eventide.functions import json_scalar, parse_payload
from eventide.operators.privacy import PERSONAL_PATTERNS, pseudonymize, redact_payload, scan_text
from eventide.operators.quality import (
    SOURCE_TESTS,
    TableTests,
    day_counts,
    day_gates,
    failing_rows,
    freshness,
    reconcile,
    run_tests,
    unaccepted_values,
)
from eventide.sources.lake import read_table
from eventide.storage import scratch_path

_ACCEPTED = ", ".join(f"'{v}'" for v in ACCEPTED_EVENT_TYPES)
_EVENT_TESTS = TableTests(
    "raw_events",
    not_null=["event_id", "event_timestamp", "user_id"],
    unique=["event_id"],
    accepted={"event_type": ACCEPTED_EVENT_TYPES},
)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.raw_events(spark, sf_dir).select(
        "event_id", "event_timestamp", "user_id", F.col("kind").alias("event_type")
    )


def _line(test: str, column: str, failures: str, table: str = "raw_events", source: str = "raw") -> str:
    return (
        f"SELECT '{test}' AS test, '{table}' AS table_name, '{column}' AS column_name, "
        f"({failures}) AS failures FROM {source}"
    )


_STATUS = "SELECT *, 'error' AS severity, CASE WHEN failures = 0 THEN 'pass' ELSE 'error' END AS status FROM"


@query(
    f"""WITH {roles.RAW_SQL}, results AS (
      {_line("not_null", "event_id", "count(*) FILTER (event_id IS NULL)")}
      UNION ALL {_line("not_null", "event_timestamp", "count(*) FILTER (event_timestamp IS NULL)")}
      UNION ALL {_line("not_null", "user_id", "count(*) FILTER (user_id IS NULL)")}
      UNION ALL {_line("accepted_values", "event_type", f"count(*) FILTER (kind NOT IN ({_ACCEPTED}))")}
      UNION ALL {_line("unique", "event_id", "count(*)",
                       source="(SELECT event_id FROM raw GROUP BY 1 HAVING count(*) > 1)")}
    ) {_STATUS} results"""
)
def dq_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_tests(_raw(spark, sf_dir), _EVENT_TESTS)


@query(
    f"""WITH results AS (
      {_line("not_null", "l_orderkey", "count(*) FILTER (l_orderkey IS NULL)", "lineitem", "lineitem")}
      UNION ALL {_line("not_null", "l_shipdate", "count(*) FILTER (l_shipdate IS NULL)", "lineitem", "lineitem")}
      UNION ALL {_line("unique", "line_id", "count(*)", "lineitem",
                       "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")}
    ) {_STATUS} results"""
)
def dq_not_null_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_shipdate", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id")
    )
    return run_tests(lines, TableTests("lineitem", not_null=["l_orderkey", "l_shipdate"], unique=["line_id"]))


_CUSTOMERS_SQL = """(SELECT CAST(c_custkey AS VARCHAR) AS customer_id, sha256(c_name) AS email_hash,
      DATE '2024-01-01' - CAST(floor(abs(c_acctbal)) AS INTEGER) AS created_at FROM customer)"""
_SOURCE_SQL = {
    "raw_events": "(SELECT *, event_date AS _partition_date FROM lake)",
    "raw_customers": _CUSTOMERS_SQL,
    "transactions": "transactions",
    "events": "streamed",
}


def _declared_sql() -> str:
    """All declared tests of all sources."""
    lines = []
    for t in SOURCE_TESTS:
        own = _SOURCE_SQL[t.table]
        lines += [_line("not_null", c, f"count(*) FILTER ({c} IS NULL)", t.table, own) for c in t.not_null]
        for c, values in t.accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            lines.append(_line("accepted_values", c, f"count(*) FILTER ({c} NOT IN ({listed}))", t.table, own))
        for c in t.unique:
            repeated = f"(SELECT {c} FROM {own} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
            lines.append(_line("unique", c, "count(*)", t.table, repeated))
    return " UNION ALL ".join(lines)


@query(f"WITH {roles.RAW_SQL}, results AS ({_declared_sql()}) {_STATUS} results")
def dq_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test declared for any source table."""
    tenure = F.floor(F.abs("c_acctbal")).cast("int")
    customers = roles.customer(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.sha2("c_name", 256).alias("email_hash"),
        F.date_sub(F.lit("2024-01-01").cast("date"), tenure).alias("created_at"),
    )
    frames = {
        "raw_events": roles.lake(spark, sf_dir),
        "raw_customers": customers,
        "transactions": roles.transactions(spark, sf_dir),
        "events": roles.streamed(spark, sf_dir),
    }
    return reduce(DataFrame.unionByName, [run_tests(frames[t.table], t) for t in SOURCE_TESTS])


@query(
    f"""SELECT event_type AS value_field, count(*) AS n_records FROM events
    WHERE event_type NOT IN ({_ACCEPTED}) GROUP BY 1"""
)
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unaccepted_values(roles.events(spark, sf_dir), "event_type", ACCEPTED_EVENT_TYPES)


@query(
    f"""WITH {roles.RAW_SQL}, newest AS (
      SELECT 'raw_events' AS table_name, max(_ingestion_timestamp) AS max_loaded_at, 12 AS warn, 24 AS err
      FROM lake
      UNION ALL
      SELECT 'transactions', max(synapse_load_timestamp), 6, 12 FROM transactions
    ), aged AS (
      SELECT *, date_sub('second', max_loaded_at, TIMESTAMP '2024-01-31 06:00:00') AS age_seconds FROM newest
    )
    SELECT table_name, max_loaded_at, age_seconds,
      CASE WHEN age_seconds > err * 3600 THEN 'error' WHEN age_seconds > warn * 3600 THEN 'warn'
        ELSE 'pass' END AS status
    FROM aged"""
)
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.lake(spark, sf_dir)
    bought = roles.transactions(spark, sf_dir)
    return freshness(events, "raw_events", "_ingestion_timestamp", roles.CTX, *FRESHNESS_EVENTS).unionByName(
        freshness(bought, "transactions", "synapse_load_timestamp", roles.CTX, *FRESHNESS_TRANSACTIONS)
    )


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT event_date, count(*) AS row_count, count(*) FILTER (user_id IS NULL) AS null_users,
      count(*) BETWEEN 316.35 AND 349.65 AS value_ok, count(*) >= 330 AS minimum_ok,
      count(*) FILTER (user_id IS NULL) = 0 AS users_ok
    FROM lake GROUP BY event_date"""
)
def dq_value_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates of all days in one pass: 333 rows give or take 5%, at least 330, all with a user."""
    counts = day_counts(roles.lake(spark, sf_dir), "_partition_date")
    return day_gates(counts, pass_value=333, tolerance=0.05, min_rows=330)


@query(
    f"""WITH {roles.RAW_SQL}, a AS (
      SELECT event_date AS day, count(*) AS n FROM lake GROUP BY 1
    ), b AS (
      SELECT CAST(_ingestion_timestamp AS DATE) AS day, count(*) AS n FROM lake GROUP BY 1
    )
    SELECT day, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
      abs(coalesce(a.n, 0) - coalesce(b.n, 0)) / greatest(a.n, b.n) AS drift,
      abs(coalesce(a.n, 0) - coalesce(b.n, 0)) / greatest(a.n, b.n) < 0.01 AS drift_ok
    FROM a FULL OUTER JOIN b USING (day)"""
)
def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the day they happened against events by the day they were ingested."""
    events = roles.lake(spark, sf_dir)
    happened = events.select(F.col("_partition_date").alias("day"))
    return reconcile(happened, events.select(F.to_date("_ingestion_timestamp").alias("day")))


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT 'accepted_values_raw_events_event_type' AS test_name, kind AS failing_value, count(*) AS n_records
    FROM raw WHERE kind NOT IN ({_ACCEPTED}) GROUP BY 2
    UNION ALL
    SELECT 'not_null_raw_events_user_id', event_id, 1 FROM raw WHERE user_id IS NULL"""
)
def dq_failures_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store what failed and read it back."""
    stored = failing_rows(_raw(spark, sf_dir), _EVENT_TESTS)
    folder = scratch_path(spark, "test-results")
    values, rows = "accepted_values_raw_events_event_type", "not_null_raw_events_user_id"
    for name in (values, rows):
        stored[name].write.mode("overwrite").parquet(f"{folder}/{name}")
    by_value = read_table(spark, f"{folder}/{values}", stored[values].schema)
    by_row = read_table(spark, f"{folder}/{rows}", stored[rows].schema)
    return by_value.select(
        F.lit(values).alias("test_name"), F.col("value_field").alias("failing_value"), "n_records"
    ).unionByName(
        by_row.select(
            F.lit(rows).alias("test_name"),
            F.col("event_id").alias("failing_value"),
            F.lit(1).cast("long").alias("n_records"),
        )
    )


@query("SELECT c_custkey, sha256(c_name) AS c_name_hash, c_mktsegment FROM customer")
def pii_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = roles.customer(spark, sf_dir).select("c_custkey", "c_name", "c_mktsegment")
    return pseudonymize(people, ["c_name"])


@query(
    " UNION ALL ".join(
        f"SELECT 'text' AS column_name, '{name}' AS pattern, "
        f"count(*) FILTER (regexp_matches(text, '{rx}')) AS matching_rows FROM documents"
        for name, rx in PERSONAL_PATTERNS.items()
    )
)
def pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_text(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["text"])


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT event_id, '{{' || concat_ws(',', '"referrer":"' || referrer || '"',
        '"device_type":"' || device_type || '"', '"country_code":"' || country_code || '"') || '}}' AS payload,
      CAST(NULL AS VARCHAR) AS page_url, device_type
    FROM raw"""
)
def payload_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads without session and address; the other keys can still be read."""
    rows = roles.raw_events(spark, sf_dir).select("event_id", "payload")
    clean = redact_payload(rows, "payload", ["session_id", "page_url"])
    keys = ["page_url", "device_type"]
    parsed = clean.withColumn("_parsed", parse_payload("payload", keys))
    return parsed.select("event_id", "payload", *[json_scalar("_parsed", "payload", k).alias(k) for k in keys])
