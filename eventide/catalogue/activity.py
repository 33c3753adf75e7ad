"""Queries on staging, sessions, enrichment and the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.catalogue import roles
from eventide.catalogue.registry import query
from eventide.constants import PAYLOAD_KEYS
from eventide.functions import (
    hour_floor,
    json_scalar,
    parse_payload,
    url_origin,
    utc_day,
    whole_seconds_between,
)
from eventide.functions import surrogate_key as key_of
from eventide.operators.enrich import join_customers, join_daily_spend
from eventide.operators.metrics import daily_user_metrics as metrics_by_day
from eventide.operators.payloads import choose_columns, discover, typed_payload
from eventide.plans.facts import fct_events as fact_rows
from eventide.plans.facts import session_columns
from eventide.plans.staging import earliest_copies, stage_events, union_sources
from eventide.storage import materialize

# Keys above this many rows are cut into slices in the query that shows the handling of hot sessions.
SMALL_GROUP = 1000


def staged(spark: SparkSession, sf_dir: str, lookback_days: int | None = None) -> DataFrame:
    """Staged events as the silver table that later steps read."""
    rows = stage_events(roles.lake(spark, sf_dir), roles.streamed(spark, sf_dir), roles.CTX, lookback_days)
    return materialize(rows, "stg-events")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(
        staged(spark, sf_dir), roles.customers(spark, sf_dir), roles.transactions(spark, sf_dir), roles.CTX
    )


def _with_double(df: DataFrame, column: str = "transaction_amount_usd") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT event_id, session_id, page_url, referrer, device_type, country_code FROM raw"""
)
def stg_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = roles.raw_events(spark, sf_dir).withColumn("_parsed", parse_payload("payload", PAYLOAD_KEYS))
    return parsed.select("event_id", *[json_scalar("_parsed", "payload", k).alias(k) for k in PAYLOAD_KEYS])


@query(f"WITH {roles.RAW_SQL} SELECT * FROM lake UNION ALL SELECT * FROM streamed")
def stg_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_sources(roles.lake(spark, sf_dir), roles.streamed(spark, sf_dir))


@query(
    f"""WITH {roles.RAW_SQL}, unioned AS (SELECT * FROM lake UNION ALL SELECT * FROM streamed)
    SELECT * EXCLUDE (place) FROM (
      SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY _ingestion_timestamp, event_timestamp, source_system) AS place FROM unioned
    ) WHERE place = 1"""
)
def stg_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return earliest_copies(union_sources(roles.lake(spark, sf_dir), roles.streamed(spark, sf_dir)))


@query(f"WITH {roles.staged_sql()} SELECT * FROM staged")
def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_events(roles.lake(spark, sf_dir), roles.streamed(spark, sf_dir), roles.CTX, None)


@query(
    f"""WITH {roles.staged_sql("event_date BETWEEN DATE '2024-01-12' AND DATE '2024-01-15'")}
    SELECT * FROM staged"""
)
def stg_events_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_events(roles.lake(spark, sf_dir), roles.streamed(spark, sf_dir), roles.CTX, 3)


@query(f"WITH {roles.facts_sql()} SELECT * FROM facts")
def fct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_double(facts(spark, sf_dir))


_RECENT = "event_date >= DATE '2024-01-12'"


@query(
    f"""WITH {roles.facts_sql(recent=_RECENT, spent="transaction_date >= DATE '2024-01-12'")}
    SELECT * FROM facts"""
)
def fct_events_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact_rows(
        staged(spark, sf_dir),
        roles.customers(spark, sf_dir),
        roles.transactions(spark, sf_dir),
        roles.CTX,
        incremental=True,
    )
    return _with_double(rows)


_SESSIONS_SQL = f"""WITH {roles.RAW_SQL}
    SELECT event_id, session_id, event_timestamp, kind AS event_type,
      count(*) OVER (PARTITION BY session_id) AS session_event_count,
      row_number() OVER w AS session_event_sequence,
      lag(kind) OVER w AS prev_event_type,
      date_sub('second', lag(event_timestamp) OVER w, event_timestamp) AS seconds_since_prev_event
    FROM raw WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)"""


def _visits(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    user = F.when(F.col("event_type") != "error", F.col("user_id").cast("string"))
    session = F.concat(user, F.lit("-"), F.to_date("ts").cast("string"))
    return roles.events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        session.alias("session_id"),
        F.col("ts").alias("event_timestamp"),
        "event_type",
        *more,
    )


@query(_SESSIONS_SQL)
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_columns(_visits(spark, sf_dir))


@query(_SESSIONS_SQL)
def session_windows_null_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with sessions above a small size cut into slices: the NULL session, here."""
    return session_columns(_visits(spark, sf_dir), max_group_rows=SMALL_GROUP)


@query(
    f"""WITH {roles.RAW_SQL}, spend AS (
      SELECT customer_id AS user_id, transaction_date AS event_date, sum(amount_usd) AS amount
      FROM transactions GROUP BY customer_id, transaction_date
    )
    SELECT l.event_id, l.user_id, l.event_date, s.user_id IS NOT NULL AS has_same_day_transaction,
      CAST(s.amount AS DOUBLE) AS transaction_amount_usd
    FROM lake l LEFT JOIN spend s ON l.user_id = s.user_id AND l.event_date = s.event_date"""
)
def same_day_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.lake(spark, sf_dir).select("event_id", "user_id", F.col("_partition_date").alias("event_date"))
    joined = join_daily_spend(events, roles.transactions(spark, sf_dir))
    return _with_double(joined).select(
        "event_id", "user_id", "event_date", "has_same_day_transaction", "transaction_amount_usd"
    )


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT event_id, l.user_id, event_type, customer_segment, acquisition_channel, customer_tenure_days,
      is_premium_subscriber
    FROM lake l LEFT JOIN customers c ON l.user_id = c.user_id"""
)
def customer_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.lake(spark, sf_dir).select("event_id", "user_id", "event_type")
    return join_customers(events, roles.customers(spark, sf_dir))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
      md5(coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_')
      || '-' || coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_')
      || '-' || coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, '_dbt_utils_surrogate_key_null_'))
      AS line_key
    FROM lineitem"""
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    flagged = lines.withColumn("flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    key = key_of(["l_orderkey", "l_linenumber", "flag"])
    return flagged.select("l_orderkey", "l_linenumber", "l_partkey", key.alias("line_key"))


@query("SELECT page_id, url, nullif(regexp_extract(url, '^https?://[^/]+'), '') AS page_domain FROM pages")
def page_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", url_origin("url").alias("page_domain"))


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT CAST(event_timestamp AS DATE) AS event_date, user_id, kind AS event_type,
      count(*) AS event_count, count(DISTINCT session_id) AS session_count,
      min(event_timestamp) AS first_event_at, max(event_timestamp) AS last_event_at,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount_usd
    FROM raw GROUP BY 1, 2, 3"""
)
def daily_user_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.when(F.col("event_type") != "error", F.col("user_id").cast("string"))
    amount = F.col("value").cast("decimal(18,2)")
    typed = _visits(
        spark, sf_dir, F.to_date("ts").alias("event_date"), user.alias("user_id"), amount.alias("amount")
    )
    return _with_double(metrics_by_day(typed, "amount"), "amount_usd")


@query(
    """SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour,
      date_sub('second', date_trunc('hour', ts), ts) AS seconds_into_hour,
      date_sub('second', ts, TIMESTAMP '2024-01-31 06:00:00') AS age_seconds,
      CAST(CAST(ts AS DATE) - INTERVAL 3 DAY AS DATE) AS lookback_day,
      upper(event_type) AS shouted, lower(upper(event_type)) AS whispered,
      coalesce(CASE WHEN event_type <> 'error' THEN event_type END, 'unknown') AS known_type
    FROM events"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts")
    known = F.when(F.col("event_type") != "error", F.col("event_type"))
    return roles.events(spark, sf_dir).select(
        "event_id",
        utc_day(at).alias("day"),
        hour_floor(at).alias("hour"),
        whole_seconds_between(at, hour_floor(at)).alias("seconds_into_hour"),
        whole_seconds_between(roles.CTX.now_col, at).alias("age_seconds"),
        F.date_sub(utc_day(at), 3).alias("lookback_day"),
        F.upper("event_type").alias("shouted"),
        F.lower(F.upper("event_type")).alias("whispered"),
        F.coalesce(known, F.lit("unknown")).alias("known_type"),
    )


_PAYLOADS = """payloads AS (
  SELECT event_id, CASE event_type
    WHEN 'purchase' THEN '{"k":' || k || ',"value":' || CAST(round(value) AS BIGINT) || '.5,"paid":true}'
    WHEN 'view' THEN '{"k":' || k || ',"page":"p' || k || '","tags":["a","b"]}'
    WHEN 'click' THEN '{"k":"' || k || '","at":{"x":' || k || '}}'
    WHEN 'signup' THEN '{"k":' || k || ',"page":null}' ELSE 'no json' END AS payload
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of five kinds, with numbers, texts, flags, lists, objects, nulls, and some that are no JSON."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    text = (
        F.when(kind == "purchase", F.concat(F.lit('{"k":'), k, F.lit(',"value":'), F.round("value").cast("long"), F.lit('.5,"paid":true}')))
        .when(kind == "view", F.concat(F.lit('{"k":'), k, F.lit(',"page":"p'), k, F.lit('","tags":["a","b"]}')))
        .when(kind == "click", F.concat(F.lit('{"k":"'), k, F.lit('","at":{"x":'), k, F.lit("}}")))
        .when(kind == "signup", F.concat(F.lit('{"k":'), k, F.lit(',"page":null}')))
        .otherwise("no json")
    )
    return roles.events(spark, sf_dir).select("event_id", text.alias("payload"))


@query(
    f"""WITH {_PAYLOADS}, good AS (SELECT * FROM payloads WHERE json_valid(payload)),
    entries AS (SELECT unnest(json_keys(payload)) AS key, payload FROM good)
    SELECT key, CASE json_type(payload, '$.' || key) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING'
        WHEN 'DOUBLE' THEN 'DECIMAL' WHEN 'NULL' THEN 'VOID' ELSE json_type(payload, '$.' || key) END AS kind, count(*) AS rows
    FROM entries GROUP BY 1, 2"""
)
def payload_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of all payloads, with the kinds of their values."""
    return discover(_payloads(spark, sf_dir), "payload")


@query(
    f"""WITH {_PAYLOADS}
    SELECT event_id, json_extract_string(payload, '$.page') AS page,
      CAST(json_extract(payload, '$.value') AS DOUBLE) AS value, CAST(json_extract(payload, '$.paid') AS BOOLEAN) AS paid,
      CASE WHEN payload LIKE '%"tags"%' THEN '{{"k":' || json_extract(payload, '$.k') || ',"tags":["a","b"]}}'
        WHEN payload LIKE '%"at"%' THEN payload
        WHEN payload LIKE '%"page":null%' THEN '{{"k":' || json_extract(payload, '$.k') || ',"page":null}}'
        ELSE '{{"k":' || json_extract(payload, '$.k') || '}}' END AS payload_rest
    FROM (SELECT * FROM payloads WHERE json_valid(payload))
    UNION ALL SELECT event_id, NULL, NULL, NULL, payload FROM payloads WHERE NOT json_valid(payload)"""
)
def payload_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns for keys of one type that a tenth of the payloads hold; all else is kept as JSON."""
    rows = materialize(_payloads(spark, sf_dir), "payloads")
    columns = choose_columns(discover(rows, "payload"), rows.count())
    return typed_payload(rows, "payload", columns).drop("payload")
