import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.catalogue import roles
from eventide.context import RunContext
from eventide.operators.quality import GateFailed
from eventide.operators.scoring import score, train_churn, user_features
from eventide.plans.daily import GateLimits, append_predictions, materialize_model, run_day
from eventide.plans.facts import fct_events
from eventide.plans.staging import stage_events
from eventide.sources.lake import Lake
from eventide.storage import table_exists
from tests.conftest import SMALL, rows

CTX = RunContext.of("2024-01-15", "2024-01-16 03:00:00", "test")
OPEN = GateLimits(pass_value=30, tolerance=0.9, min_rows=1, max_drift=0.9)


def inputs(spark, known_users=True):
    lake, streamed = roles.lake(spark, SMALL), roles.streamed(spark, SMALL)
    if known_users:  # errors have no user, which the last gate refuses
        lake = lake.filter("event_type in ('CLICK', 'VIEW', 'PURCHASE')").withColumn("event_type", F.lower("event_type"))
    return lake, streamed, roles.customers(spark, SMALL), roles.transactions(spark, SMALL)


def test_day_runs_and_runs_again(spark, folder):
    lake = Lake(folder)
    staged = stage_events(*inputs(spark)[:2], CTX, None)
    facts = fct_events(staged, *inputs(spark)[2:])
    model = train_churn(user_features(facts, dt.date(2024, 1, 30)))
    first = run_day(spark, lake, *inputs(spark), CTX, model, OPEN)
    again = run_day(spark, lake, *inputs(spark), CTX, model, OPEN)
    assert first["merge"]["created"] and not again["merge"]["created"]
    assert (again["merge"]["rows_inserted"], again["merge"]["rows_updated"]) == (0, first["merge"]["rows_inserted"])
    assert first["loaded"] == again["loaded"] == first["scored"] == again["scored"] > 0
    mart = spark.read.parquet(lake.path("gold", "fct_events"))
    assert mart.select("event_key").distinct().count() == mart.count() == first["merge"]["rows_inserted"]
    assert rows(mart.select(F.min(F.col("event_date").cast("string")), F.max(F.col("event_date").cast("string")))) == [
        ("2024-01-12", "2024-01-15")
    ]
    assert spark.read.parquet(lake.path("gold", "ml_predictions")).count() == first["scored"]


def raw_customers(spark):
    known = spark.read.parquet(f"{SMALL}/customer.parquet")
    return known.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.sha2("c_name", 256).alias("email_hash"),
        F.lit("2024-01-01").cast("date").alias("created_at"),
        F.lit("2024-01-16 01:00:00").cast("timestamp").alias("_ingestion_timestamp"),
    )


def test_days_in_order_have_the_sessions_of_a_full_refresh(spark, folder):
    lake, (raw, streamed, people, bought) = Lake(folder), inputs(spark)
    # One session per user for all days: events keep their id and user, the payload names the session.
    session = F.concat(F.lit('{"session_id":"u'), "user_id", F.lit('"}'))
    raw, streamed = raw.withColumn("payload", session), streamed.withColumn("payload", session)
    seen = []
    for day in ("2024-01-04", "2024-01-07", "2024-01-08"):
        ctx = RunContext.of(day, f"{day} 23:30:00", "test")
        own = raw.filter(F.col("_partition_date") <= day)
        paid = bought.filter(F.col("transaction_date") <= day)
        seen.append(run_day(spark, lake, own, streamed, people, paid, ctx, None, OPEN, raw_customers=raw_customers(spark)))
    assert seen[0]["recounted"] == 0 and seen[1]["recounted"] > 0
    tables = {r["table_name"] for r in seen[2]["tests"]}
    assert tables == {"raw_events", "raw_customers", "transactions", "events"}
    assert {r["table_name"] for r in seen[2]["tests"] if r["test"] == "freshness"} == tables - {"events"}
    assert {r["status"] for r in seen[2]["tests"]} <= {"pass", "warn"}
    staged = stage_events(raw, streamed, ctx, None).filter("event_date between '2024-01-01' and '2024-01-08'")
    full = fct_events(staged, people, bought)
    columns = ["event_id", "session_event_count", "session_event_sequence", "prev_event_type", "seconds_since_prev_event"]
    mart = spark.read.parquet(lake.path("gold", "fct_events"))
    assert rows(mart.select(*columns)) == rows(full.select(*columns))


def test_day_stops_at_known_ids_and_stale_sources(spark, folder):
    lake, (raw, streamed, people, bought) = Lake(folder), inputs(spark)
    replay = raw.filter("_partition_date = '2024-01-10'").withColumn("_partition_date", F.lit("2024-01-15").cast("date"))
    old = RunContext.of("2024-01-10", "2024-01-11 03:00:00", "test")
    run_day(spark, lake, raw.filter("_partition_date <= '2024-01-10'"), streamed, people, bought, old, None, OPEN)
    with pytest.raises(GateFailed, match="known from earlier days"):
        run_day(spark, lake, raw.unionByName(replay), streamed, people, bought, CTX, None, OPEN)
    stale = raw.withColumn("_ingestion_timestamp", F.lit("2023-01-01").cast("timestamp"))
    with pytest.raises(GateFailed, match="raw_events is stale"):
        run_day(spark, Lake(f"{folder}-2"), stale, streamed, people, bought, CTX, None, OPEN)


def test_day_stops_at_texts_that_look_like_personal_data(spark, folder):
    raw, streamed, people, bought = inputs(spark)
    named = F.regexp_replace("payload", "https://view", "https://jane.doe@mail")
    with pytest.raises(GateFailed, match="no_email.*page_domain"):
        run_day(spark, Lake(folder), raw.withColumn("payload", named), streamed.limit(0), people, bought, CTX, None, OPEN)
    assert not table_exists(spark, f"{folder}/gold/fact_events")


def test_day_stops_at_a_failed_data_test(spark, folder):
    with pytest.raises(GateFailed, match="accepted_values"):
        run_day(spark, Lake(folder), *inputs(spark, known_users=False), CTX, None, OPEN)
    stored = spark.read.parquet(f"{folder}/test_results/2024-01-15/accepted_values_raw_events_event_type")
    assert stored.count() > 0


def test_day_stops_at_the_user_gate(spark, folder):
    with pytest.raises(GateFailed, match="users_ok=False|'users_ok': False"):
        run_day(spark, Lake(folder), *inputs(spark, known_users=False), CTX, None, OPEN, severity="warn")


def test_predictions_append_or_replace(spark, folder):
    staged = stage_events(*inputs(spark)[:2], CTX, None)
    facts = fct_events(staged, *inputs(spark)[2:])
    features = user_features(facts, dt.date(2024, 1, 30))
    predictions = score(facts, features, train_churn(features), CTX)
    for _ in range(2):
        append_predictions(predictions, folder)
    stored = spark.read.parquet(folder)
    assert stored.count() == 2 * facts.count()
    assert stored.columns == ["user_id", "predicted_label", "predicted_label_probs", "scored_at", "event_date"]


def test_materializations(spark, folder):
    df = spark.range(3)
    assert materialize_model(df, "m_view", "view").count() == spark.table("m_view").count() == 3
    assert materialize_model(df, "m", "table", folder).count() == 3
    assert materialize_model(df, "m", "ephemeral") is df
    with pytest.raises(ValueError):
        materialize_model(df, "m", "cube")
