import datetime as dt

import pytest

from eventide.constants import PAYLOAD_KEYS
from eventide.context import RunContext
from eventide.operators.privacy import personal_columns
from eventide.plans.facts import FACT_COLUMNS, fct_events
from eventide.plans.staging import stage_events
from eventide.schemas import CUSTOMERS_SCHEMA, EVENTS_SCHEMA, STREAM_EVENTS_SCHEMA, TRANSACTIONS_SCHEMA
from tests.conftest import rows, ts

CTX = RunContext.of("2024-01-10", "2024-01-11 06:00:00", "test")


def lake_row(event, at, ingested=None, day=None, payload='{"session_id":"s"}', user="u", source="App"):
    at = ts(at) if at else None
    ingested = ts(ingested) if ingested else at
    day = dt.date.fromisoformat(day) if day else at.date()
    return (event, at, user, "bronze", "CLICK", source, "bronze", "bronze", payload, ingested, day)


def frames(spark, lake, stream=()):
    nullable = [f"{f.name} {f.dataType.simpleString()}" for f in EVENTS_SCHEMA]
    streamed = [f"{f.name} {f.dataType.simpleString()}" for f in STREAM_EVENTS_SCHEMA]
    return (
        spark.createDataFrame(lake, ", ".join(nullable)),
        spark.createDataFrame(list(stream), ", ".join(streamed)),
    )


def test_defaults_and_case(spark):
    payload = '{"page_url":"https://a.b/c","country_code":"de","device_type":""}'
    lake, stream = frames(spark, [lake_row("e", "2024-01-10 10:20:30.5", payload=payload)])
    row = stage_events(lake, stream, CTX).first()
    assert (row.country_code, row.device_type, row.page_domain, row.session_id) == ("DE", "", "https://a.b", None)
    assert (row.event_type, row.source_system, row.seconds_into_hour) == ("click", "app", 1230)
    assert row.dbt_invocation_id == "test" and row.event_date == dt.date(2024, 1, 10)


def test_missing_categories_get_defaults(spark):
    lake, stream = frames(spark, [lake_row("e", "2024-01-10 10:00:00", payload=None)])
    row = stage_events(lake, stream, CTX).first()
    assert (row.country_code, row.device_type, row.page_domain) == ("XX", "unknown", None)


def test_earliest_copy_wins_across_sources(spark):
    lake, stream = frames(
        spark,
        [lake_row("e", "2024-01-10 10:00:00", "2024-01-10 11:00:00"), lake_row("f", "2024-01-10 10:00:00")],
        [("e", ts("2024-01-10 10:00:00"), "u", "view", "{}"), ("f", ts("2024-01-10 10:00:00"), "u", "view", "{}")],
    )
    staged = stage_events(lake, stream, CTX).select("event_id", "source_system")
    # The copies of f were ingested at the same moment, so the source name decides.
    assert rows(staged) == [("e", "gcp_pubsub"), ("f", "app")]


def test_time_of_first_copy_decides_after_dedup(spark):
    lake, stream = frames(
        spark,
        [
            lake_row("e", None, "2024-01-10 09:00:00", "2024-01-10"),
            lake_row("e", "2024-01-10 10:00:00"),
            lake_row(None, "2024-01-10 10:00:00"),
        ],
    )
    assert stage_events(lake, stream, CTX).count() == 0


@pytest.mark.parametrize("days,expected", [(0, ["today"]), (3, ["late", "today"]), (None, ["late", "old", "today"])])
def test_lookback(spark, days, expected):
    lake, stream = frames(
        spark,
        [lake_row("today", "2024-01-10 01:00:00"), lake_row("old", "2024-01-01 01:00:00")],
        [("late", ts("2024-01-07 00:00:00"), "u", "view", "{}")],
    )
    assert [r[0] for r in rows(stage_events(lake, stream, CTX, days).select("event_id"))] == expected


def test_partition_day_and_event_day_may_differ(spark):
    lake, stream = frames(spark, [lake_row("e", "2024-01-09 23:00:00", day="2024-01-10")])
    assert stage_events(lake, stream, CTX).first().event_date == dt.date(2024, 1, 9)


def test_facts_have_all_columns_and_no_personal_ones(spark):
    payload = [f'{{"session_id":"s{i // 2}"}}' for i in range(4)]
    lake, stream = frames(spark, [lake_row(f"e{i}", f"2024-01-10 1{i}:00:00", payload=payload[i]) for i in range(4)])
    staged = stage_events(lake, stream, CTX)
    facts = fct_events(
        staged,
        spark.createDataFrame([("u", "gold", "web", 5, True)], CUSTOMERS_SCHEMA),
        spark.createDataFrame([], TRANSACTIONS_SCHEMA),
        CTX,
    )
    assert facts.columns == FACT_COLUMNS and personal_columns(facts) == []
    got = facts.select(
        "event_id", "session_event_count", "session_event_sequence", "prev_event_type", "seconds_since_prev_event"
    )
    assert rows(got) == [
        ("e0", 2, 1, None, None),
        ("e1", 2, 2, "click", 3600),
        ("e2", 2, 1, None, None),
        ("e3", 2, 2, "click", 3600),
    ]


def test_incremental_facts_count_sessions_within_the_range(spark):
    lake, stream = frames(spark, [lake_row("a", "2024-01-06 23:00:00"), lake_row("b", "2024-01-07 01:00:00")])
    staged = stage_events(lake, stream, CTX, None)
    facts = fct_events(
        staged,
        spark.createDataFrame([], CUSTOMERS_SCHEMA),
        spark.createDataFrame([], TRANSACTIONS_SCHEMA),
        CTX,
        incremental=True,
    )
    assert rows(facts.select("event_id", "session_event_count")) == [("b", 1)]


def test_day_of_lake_prunes_partitions(spark, folder):
    lake, stream = frames(spark, [lake_row(f"e{i}", f"2024-01-{i:02d} 10:00:00") for i in range(5, 12)])
    lake.write.partitionBy("_partition_date").parquet(folder)
    stored = spark.read.schema(EVENTS_SCHEMA).parquet(folder)
    plan = stage_events(stored, stream, CTX)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_partition_date" in plan
    assert stage_events(stored, stream, CTX).count() == 1
    assert set(PAYLOAD_KEYS) - set(stored.columns) == {"page_url", "referrer"}


def test_fact_plan_shuffles_no_more_than_it_needs(spark):
    from eventide.catalogue import roles
    from tests.conftest import SMALL

    staged = stage_events(roles.lake(spark, SMALL), roles.streamed(spark, SMALL), CTX, None)
    facts = fct_events(
        staged, roles.customers(spark, SMALL), roles.transactions(spark, SMALL), max_group_rows=None
    )
    plan = facts._jdf.queryExecution().executedPlan().toString()
    # One shuffle each for event ids, sessions, and purchases per user and day.
    assert plan.count("Exchange hashpartitioning") == 3 and "Exchange SinglePartition" not in plan
