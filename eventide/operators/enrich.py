"""Left joins that bring dimension attributes and daily totals to events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import no_salt, salt_where_null
from eventide.operators.keyed import MAX_BROADCAST_ROWS, small_side


def join_customers(
    events: DataFrame,
    customers: DataFrame,
    spread_by: str = "event_id",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Every event with its customer's attributes; events without a known customer keep NULLs.

    Few customers are broadcast. With many, Spark splits a hot customer at run time, and events without a
    user are spread by a salt.
    """
    salted = events.withColumn("_salt", salt_where_null(["user_id"], [spread_by]))
    known = small_side(customers.withColumn("_salt", no_salt(["user_id"])), max_broadcast_rows)
    return salted.join(known, ["user_id", "_salt"], "left").drop("_salt")


def daily_spend(transactions: DataFrame) -> DataFrame:
    """Amount per customer and day, summed as decimals, with a flag for the join."""
    return transactions.groupBy(
        F.col("customer_id").alias("user_id"), F.col("transaction_date").alias("event_date")
    ).agg(F.lit(True).alias("has_transaction"), F.sum("amount_usd").alias("transaction_amount_usd"))


def join_daily_spend(events: DataFrame, transactions: DataFrame, spread_by: str = "event_id") -> DataFrame:
    """Flag events on days on which the same user also bought, with the day's amount.

    The totals get their salt after the aggregation, so that the join shuffles them once more: only then can
    Spark split a day on which one user has very many events.
    """
    spend = daily_spend(transactions).withColumn("_salt", no_salt(["user_id", "event_date"]))
    salted = events.withColumn("_salt", salt_where_null(["user_id", "event_date"], [spread_by]))
    return (
        salted.join(spend, ["user_id", "event_date", "_salt"], "left")
        .withColumn("has_same_day_transaction", F.coalesce("has_transaction", F.lit(False)))
        .drop("_salt", "has_transaction")
    )
