"""The event fact table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.constants import LOOKBACK_DAYS
from eventide.context import RunContext
from eventide.functions import surrogate_key, whole_seconds_between
from eventide.operators.enrich import join_customers, join_daily_spend
from eventide.operators.keyed import MAX_GROUP_ROWS, with_neighbours
from eventide.plans.sessions import continue_sessions
from eventide.schemas import CUSTOMERS_SCHEMA

# The columns of the fact table, in order.
FACT_COLUMNS = [
    "event_key",
    "event_id",
    "session_id",
    "user_id",
    "event_date",
    "event_timestamp",
    "event_type",
    "source_system",
    "country_code",
    "device_type",
    "page_domain",
    "customer_segment",
    "acquisition_channel",
    "customer_tenure_days",
    "is_premium_subscriber",
    "session_event_count",
    "session_event_sequence",
    "prev_event_type",
    "seconds_since_prev_event",
    "has_same_day_transaction",
    "transaction_amount_usd",
    "_ingestion_timestamp",
    "dbt_updated_at",
]


def recent(df: DataFrame, column: str, ctx: RunContext, days: int) -> DataFrame:
    """Rows from `days` before the run day on."""
    first = (ctx.ds - dt.timedelta(days=days)).isoformat()
    return df.filter(F.col(column) >= F.lit(first).cast("date"))


def session_columns(events: DataFrame, max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Size of the session, place in it, and type of and time since the event before.

    Events of equal time are ordered by id. Events without a session form one group, as in a window.
    """
    rows = with_neighbours(
        events,
        ["session_id"],
        ["event_timestamp", "event_id"],
        size="session_event_count",
        position="session_event_sequence",
        previous={"prev_event_type": "event_type", "_prev_at": "event_timestamp"},
        max_group_rows=max_group_rows,
    )
    elapsed = whole_seconds_between("event_timestamp", "_prev_at")
    return rows.withColumn("seconds_since_prev_event", elapsed).drop("_prev_at")


def fct_events(
    staged: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    ctx: RunContext | None = None,
    incremental: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """One row per event with customer, session and same-day purchase.

    An incremental run computes the last days only; sessions that reach back further are then counted
    from the first of those days, or with `earlier` (`sessions.state_before` that day) from their
    beginning. `customers` holds a user at most once (gated by a uniqueness test),
    so looking them up does not change sessions and comes after the session shuffle.
    """
    if incremental:
        staged = recent(staged, "event_date", ctx, lookback_days)
        transactions = recent(transactions, "transaction_date", ctx, lookback_days)
    carried = staged.drop("seconds_into_hour", "page_url", "referrer", "dbt_invocation_id")
    if earlier is None:
        sessions = session_columns(carried, max_group_rows)
    else:
        sessions = continue_sessions(carried, earlier, max_group_rows)
    known = customers.select(*CUSTOMERS_SCHEMA.names)
    enriched = join_daily_spend(join_customers(sessions, known), transactions)
    return enriched.withColumn("event_key", surrogate_key(["event_id"])).select(*FACT_COLUMNS)
