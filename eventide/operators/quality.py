"""Data tests, freshness, value gates and reconciliation. Results are small frames, one row per test."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.constants import (
    ACCEPTED_EVENT_TYPES,
    FRESHNESS_EVENTS,
    FRESHNESS_TRANSACTIONS,
    GATE_MAX_DRIFT,
    GATE_MIN_ROWS,
    GATE_PASS_VALUE,
    GATE_TOLERANCE,
)
from eventide.context import RunContext


class GateFailed(RuntimeError):
    """A data test or gate of severity error did not pass."""


@dataclass(frozen=True)
class TableTests:
    """What is declared about one table."""

    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: dict[str, Sequence[str]] = field(default_factory=dict)
    freshness: tuple[str, int, int] | None = None  # column, hours to warn, hours to error


# The tests declared for the source tables.
SOURCE_TESTS = [
    TableTests(
        "raw_events",
        not_null=["event_id", "event_timestamp", "source_system", "_ingestion_timestamp", "_partition_date"],
        unique=["event_id"],
        accepted={"event_type": ACCEPTED_EVENT_TYPES},
        freshness=("_ingestion_timestamp", *FRESHNESS_EVENTS),
    ),
    TableTests(
        "raw_customers",
        not_null=["customer_id", "email_hash", "created_at"],
        unique=["customer_id"],
        freshness=("_ingestion_timestamp", *FRESHNESS_EVENTS),
    ),
    TableTests(
        "transactions",
        not_null=["transaction_id", "amount_usd", "transaction_date", "customer_id"],
        unique=["transaction_id"],
        freshness=("synapse_load_timestamp", *FRESHNESS_TRANSACTIONS),
    ),
    TableTests("events", not_null=["event_id", "event_timestamp"]),
]


def _result(test: str, table: str, column: str, failures: Column) -> list[Column]:
    return [
        F.lit(test).alias("test"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        failures.cast("long").alias("failures"),
    ]


def row_tests(df: DataFrame, tests: TableTests) -> DataFrame:
    """All not-null and accepted-values tests of a table in one pass over it.

    Accepted values counts failing rows; NULL passes that test.
    """
    checks: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in tests.not_null]
    checks += [("accepted_values", c, ~F.col(c).isin(list(v))) for c, v in tests.accepted.items()]
    counts = df.agg(*[F.count_if(bad).alias(f"f{i}") for i, (_, _, bad) in enumerate(checks)])
    lines = F.array(
        *[F.struct(*_result(t, tests.table, c, F.col(f"f{i}"))) for i, (t, c, _) in enumerate(checks)]
    )
    return counts.select(F.inline(lines))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unique_test(df: DataFrame, table: str, column: str) -> DataFrame:
    return repeated_values(df, column).agg(F.count(F.lit(1)).alias("n")).select(
        *_result("unique", table, column, F.col("n"))
    )


def unaccepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones, with their number of rows."""
    return (
        df.groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(~F.col("value_field").isin(list(values)))
    )


def run_tests(df: DataFrame, tests: TableTests, severity: str = "error") -> DataFrame:
    """One row per declared test: failures, severity, status."""
    parts = [unique_test(df, tests.table, c) for c in tests.unique]
    if tests.not_null or tests.accepted:
        parts.insert(0, row_tests(df, tests))
    results = reduce(DataFrame.unionByName, parts)
    passed = F.col("failures") == 0
    return results.withColumns(
        {"severity": F.lit(severity), "status": F.when(passed, F.lit("pass")).otherwise(F.lit(severity))}
    )


def failing_rows(df: DataFrame, tests: TableTests) -> dict[str, DataFrame]:
    """What each test would store when it fails: the rows, or the offending values with counts."""
    frames = {f"not_null_{tests.table}_{c}": df.filter(F.col(c).isNull()) for c in tests.not_null}
    frames |= {f"unique_{tests.table}_{c}": repeated_values(df, c) for c in tests.unique}
    frames |= {
        f"accepted_values_{tests.table}_{c}": unaccepted_values(df, c, v) for c, v in tests.accepted.items()
    }
    return frames


def test_and_store(df: DataFrame, tests: TableTests, folder: str, severity: str = "error") -> list[dict]:
    """Run the tests, store the failing rows of each failed one under `folder`, and give the results.

    A failure of severity error raises after its rows are stored; a warning is only reported.
    """
    results = [r.asDict() for r in run_tests(df, tests, severity).collect()]  # one row per test
    stored = failing_rows(df, tests)
    for r in results:
        if r["failures"]:
            name = f"{r['test']}_{r['table_name']}_{r['column_name']}"
            stored[name].write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
    failed = [r for r in results if r["status"] == "error"]
    if failed:
        raise GateFailed(f"data tests failed: {failed}")
    return results


def freshness(
    df: DataFrame, table: str, column: str, ctx: RunContext, warn_hours: int, error_hours: int
) -> DataFrame:
    """Age of the newest row and its status; a table without rows is an error."""
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), ctx.now_col)
    status = (
        F.when(age.isNull() | (age > error_hours * 3600), F.lit("error"))
        .when(age > warn_hours * 3600, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return newest.select(
        F.lit(table).alias("table_name"), "max_loaded_at", age.alias("age_seconds"), status.alias("status")
    )


def day_counts(df: DataFrame, day: str, user: str = "user_id") -> DataFrame:
    """Rows and rows without a user per day: the input of all day gates, in one pass."""
    return df.groupBy(F.col(day).alias("event_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(user).isNull()).alias("null_users")
    )


def day_gates(
    counts: DataFrame,
    pass_value: float = GATE_PASS_VALUE,
    tolerance: float = GATE_TOLERANCE,
    min_rows: int = GATE_MIN_ROWS,
) -> DataFrame:
    """Judge each day: rows near the expected number, rows at least the minimum, no row without user."""
    rows = F.col("row_count")
    return counts.withColumns(
        {
            "value_ok": rows.between(F.lit(pass_value * (1 - tolerance)), F.lit(pass_value * (1 + tolerance))),
            "minimum_ok": rows >= min_rows,
            "users_ok": F.col("null_users") == 0,
        }
    )


def reconcile(
    left: DataFrame, right: DataFrame, day: str = "day", max_drift: float = GATE_MAX_DRIFT
) -> DataFrame:
    """Compare rows per day of two sources; a day that only one of them has is a full drift."""
    a = left.groupBy(day).agg(F.count(F.lit(1)).alias("left_rows"))
    b = right.groupBy(day).agg(F.count(F.lit(1)).alias("right_rows"))
    both = a.join(b, day, "full_outer").select(
        day,
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
    )
    drift = F.abs(F.col("left_rows") - F.col("right_rows")) / F.greatest("left_rows", "right_rows")
    return both.withColumn("drift", drift).withColumn("drift_ok", F.col("drift") < max_drift)


def require(gates: DataFrame, *columns: str) -> None:
    """Stop when any of the Boolean columns is not true; gate frames hold a row per day."""
    ok = reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit(False)) for c in columns])
    failed = gates.filter(~ok).limit(20).collect()
    if failed:
        raise GateFailed(f"gate failed: {[r.asDict() for r in failed]}")
