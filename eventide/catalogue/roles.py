"""The test tables in the roles of the lakehouse's sources, in Spark and as SQL.

All rows of the test tables take part: the lake holds every event, the stream delivers the web events
(click, view, purchase) as well, so that both sources overlap. Events of type error have neither user nor
session, which makes the NULL session and the NULL user hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.context import RunContext

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
ORDERS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string"
)
CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
WEB_EVENTS = ["click", "view", "purchase"]

# Landed JSON keeps microseconds.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

CTX = RunContext.of("2024-01-15", "2024-01-31 06:00:00", "run-1")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read with zoned timestamps, so that day filters reach the file reader without a cast."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")


def _tracked(value: Column) -> Column:
    return F.when(F.col("event_type") != "error", value)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the sources deliver it, with a JSON payload; helper columns come last."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id").cast("string")
    visit = F.struct(
        _tracked(F.concat_ws("-", user, F.to_date("ts").cast("string"))).alias("session_id"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("ftp://files.example.com/"), k))
        .otherwise(
            F.concat(F.lit("https://"), "event_type", F.lit(".example.com/item/"), k, F.lit("?user="), user)
        )
        .alias("page_url"),
        F.when(k < 50, F.concat(F.lit("https://search.example.com/?q="), k)).alias("referrer"),
        F.when(k < 25, "Mobile").when(k < 50, "WEB").when(k < 75, "Tablet").alias("device_type"),
        F.when(k < 20, "us").when(k < 40, "De").when(k < 60, "fr").alias("country_code"),
    )
    return events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        _tracked(user).alias("user_id"),
        F.upper("event_type").alias("event_type"),
        F.to_json(visit).alias("payload"),
        F.col("event_type").alias("kind"),
        "value",
    )


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze events: all of them, ingested an hour after they happened."""
    return raw_events(spark, sf_dir).select(
        "event_id",
        "event_timestamp",
        "user_id",
        F.lit(None).cast("string").alias("session_id"),
        "event_type",
        F.lit("Lake").alias("source_system"),
        F.lit(None).cast("string").alias("country_code"),
        F.lit(None).cast("string").alias("device_type"),
        "payload",
        (F.col("event_timestamp") + F.expr("interval 1 hour")).alias("_ingestion_timestamp"),
        F.to_date("event_timestamp").alias("_partition_date"),
    )


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed events: the web events."""
    web = raw_events(spark, sf_dir).filter(F.col("kind").isin(WEB_EVENTS))
    return web.select("event_id", "event_timestamp", "user_id", "event_type", "payload")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    known = customer(spark, sf_dir).join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return known.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("n_name").alias("acquisition_channel"),
        F.floor(F.abs("c_acctbal")).cast("long").alias("customer_tenure_days"),
        (F.col("c_acctbal") > 5000).alias("is_premium_subscriber"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    return bought.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("value").cast("decimal(18,2)").alias("amount_usd"),
        F.to_date("ts").alias("transaction_date"),
        F.col("user_id").cast("string").alias("customer_id"),
        (F.col("ts") + F.expr("interval 2 hours")).alias("synapse_load_timestamp"),
    )


# The same roles in SQL, as a chain of common table expressions to put after WITH.
RAW_SQL = """
base AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp,
    CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS user_id,
    upper(event_type) AS event_type, event_type AS kind, value,
    CASE WHEN event_type <> 'error'
      THEN CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) END AS session_id,
    CASE WHEN event_type = 'signup' THEN 'ftp://files.example.com/' || k
      ELSE 'https://' || event_type || '.example.com/item/' || k || '?user=' || user_id END AS page_url,
    CASE WHEN k < 50 THEN 'https://search.example.com/?q=' || k END AS referrer,
    CASE WHEN k < 25 THEN 'Mobile' WHEN k < 50 THEN 'WEB' WHEN k < 75 THEN 'Tablet' END AS device_type,
    CASE WHEN k < 20 THEN 'us' WHEN k < 40 THEN 'De' WHEN k < 60 THEN 'fr' END AS country_code
  FROM base
),
lake AS (
  SELECT event_id, event_timestamp, user_id, event_type, 'Lake' AS source_system, session_id, page_url,
    referrer, device_type, country_code, event_timestamp + INTERVAL 1 HOUR AS _ingestion_timestamp,
    CAST(event_timestamp AS DATE) AS event_date
  FROM raw
),
streamed AS (
  SELECT event_id, event_timestamp, user_id, event_type, 'gcp_pubsub' AS source_system, session_id,
    page_url, referrer, device_type, country_code, event_timestamp AS _ingestion_timestamp,
    CAST(event_timestamp AS DATE) AS event_date
  FROM raw WHERE kind IN ('click', 'view', 'purchase')
),
customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS customer_segment,
    n_name AS acquisition_channel, CAST(floor(abs(c_acctbal)) AS BIGINT) AS customer_tenure_days,
    c_acctbal > 5000 AS is_premium_subscriber
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
transactions AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(value AS DECIMAL(18,2)) AS amount_usd,
    CAST(ts AS DATE) AS transaction_date, CAST(user_id AS VARCHAR) AS customer_id,
    ts + INTERVAL 2 HOUR AS synapse_load_timestamp
  FROM events WHERE event_type = 'purchase'
)"""


def staged_sql(days: str = "TRUE") -> str:
    """Staged events, read from the days that meet a condition on `event_date`."""
    return f"""{RAW_SQL},
unioned AS (
  SELECT * FROM lake WHERE {days} UNION ALL SELECT * FROM streamed WHERE {days}
),
staged AS (
  SELECT event_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
    date_sub('second', date_trunc('hour', event_timestamp), event_timestamp) AS seconds_into_hour,
    user_id, session_id, lower(event_type) AS event_type, lower(source_system) AS source_system,
    upper(coalesce(country_code, 'XX')) AS country_code,
    lower(coalesce(device_type, 'unknown')) AS device_type,
    nullif(regexp_extract(page_url, '^https?://[^/]+'), '') AS page_domain, page_url, referrer,
    _ingestion_timestamp, TIMESTAMP '2024-01-31 06:00:00' AS dbt_updated_at, 'run-1' AS dbt_invocation_id
  FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY _ingestion_timestamp, event_timestamp, source_system) AS place FROM unioned
  ) WHERE place = 1 AND event_id IS NOT NULL AND event_timestamp IS NOT NULL
)"""


def facts_sql(days: str = "TRUE", recent: str = "TRUE", spent: str = "TRUE") -> str:
    """Fact rows of the staged events that meet a condition on `event_date`."""
    return f"""{staged_sql(days)},
facts AS (
  SELECT md5(event_id) AS event_key, event_id, session_id, e.user_id, e.event_date, event_timestamp,
    event_type, source_system, country_code, device_type, page_domain, customer_segment,
    acquisition_channel, customer_tenure_days, is_premium_subscriber,
    count(*) OVER (PARTITION BY session_id) AS session_event_count,
    row_number() OVER w AS session_event_sequence,
    lag(event_type) OVER w AS prev_event_type,
    date_sub('second', lag(event_timestamp) OVER w, event_timestamp) AS seconds_since_prev_event,
    coalesce(t.has_transaction, FALSE) AS has_same_day_transaction,
    CAST(t.amount AS DOUBLE) AS transaction_amount_usd, _ingestion_timestamp, dbt_updated_at
  FROM (SELECT * FROM staged WHERE {recent}) e
  LEFT JOIN customers c ON e.user_id = c.user_id
  LEFT JOIN (
    SELECT customer_id AS user_id, transaction_date, TRUE AS has_transaction, sum(amount_usd) AS amount
    FROM transactions WHERE {spent} GROUP BY customer_id, transaction_date
  ) t ON e.user_id = t.user_id AND e.event_date = t.transaction_date
  WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)
)"""
