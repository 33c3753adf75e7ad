"""The jobs of one day in order: stage, fact table, data tests, load, scoring, gates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.constants import (
    GATE_MAX_DRIFT,
    GATE_MIN_ROWS,
    GATE_PASS_VALUE,
    GATE_TOLERANCE,
    LOOKBACK_DAYS,
)
from eventide.context import RunContext
from eventide.functions import in_days, utc_day
from eventide.operators.checksums import reconcile_rows
from eventide.operators.membership import repeated_in_history, store_filters
from eventide.operators.merge import upsert_table
from eventide.operators.privacy import require_impersonal, scan_text
from eventide.operators.quality import (
    SOURCE_TESTS,
    GateFailed,
    day_counts,
    day_gates,
    freshness,
    reconcile,
    require,
    test_and_store,
)
from eventide.operators.scoring import score, user_features
from eventide.plans.facts import fct_events, recent
from eventide.plans.sessions import read_state, recount, state_before, write_state
from eventide.plans.staging import stage_events
from eventide.sources.lake import Lake, read_table, replace_days, write_days
from eventide.storage import materialize, table_exists


@dataclass(frozen=True)
class GateLimits:
    pass_value: float = GATE_PASS_VALUE
    tolerance: float = GATE_TOLERANCE
    min_rows: int = GATE_MIN_ROWS
    max_drift: float = GATE_MAX_DRIFT


def materialize_model(df: DataFrame, name: str, how: str, path: str | None = None) -> DataFrame:
    """Keep a model as `view`, as `table` (written to `path`), or `ephemeral` (used in place)."""
    if how == "view":
        df.createOrReplaceTempView(name)
    elif how == "table":
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    elif how != "ephemeral":
        raise ValueError(f"unknown materialization {how!r}")
    return df


def test_sources(
    spark: SparkSession, lake: Lake, sources: dict[str, DataFrame], ctx: RunContext, severity: str
) -> list[dict]:
    """All tests and the freshness declared for the given tables, one result each; the rest of a table's row is its name.

    Failing rows are stored by day. Everything is run before a failure of severity error stops the day.
    """
    results, failed = [], []
    folder = lake.path("test_results", ctx.ds.isoformat())
    for declared in SOURCE_TESTS:
        if declared.table not in sources:
            continue
        rows = sources[declared.table]
        try:
            results += test_and_store(rows, declared, folder, severity)
        except GateFailed as error:
            failed.append(str(error))
        if declared.freshness:
            column, warn, late = declared.freshness
            age = freshness(rows, declared.table, column, ctx, warn, late).first()
            status = severity if age.status == "error" else age.status
            line = {"test": "freshness", "table_name": declared.table, "column_name": column}
            results.append({**line, "failures": int(age.status != "pass"), "severity": severity, "status": status})
            if status == "error":
                failed.append(f"{declared.table} is stale: {age.asDict()}")
    if failed:
        raise GateFailed("; ".join(failed))
    return results


def test_history(spark: SparkSession, lake: Lake, raw: DataFrame, ctx: RunContext, severity: str) -> list[dict]:
    """Uniqueness of the day's event ids against the days before, by the membership filters kept beside the lake."""
    day = ctx.ds.isoformat()
    landed = raw.filter(F.col("_partition_date") == ctx.ds_col)
    older = raw.filter(F.col("_partition_date") < ctx.ds_col)
    path = lake.path("test_results", "event_filters")
    others = store_filters(spark, path, landed, "event_id", "_partition_date", [day])
    others = others.filter(F.col("event_date") < ctx.ds_col)
    found = repeated_in_history(landed, older, others, "event_id", "_partition_date")
    found = materialize(found.filter(F.size("known_days") > 0), "known-before")
    failures = found.count()
    line = {"test": "unique_in_history", "table_name": "raw_events", "column_name": "event_id", "failures": failures}
    if failures:
        found.write.mode("overwrite").parquet(lake.path("test_results", f"{day}/unique_in_history_raw_events_event_id"))
        if severity == "error":
            raise GateFailed(f"{failures} event ids of {day} are known from earlier days")
    return [{**line, "severity": severity, "status": severity if failures else "pass"}]


def test_impersonal(rows: DataFrame, table: str, severity: str) -> list[dict]:
    """No text of a table may look like personal data: one result for each column and pattern that does.

    All texts of the rows are read. Keys are left out: digits of a digest may look like anything.
    """
    columns = [n for n, t in rows.dtypes if t == "string" and not n.endswith(("_key", "_id", "_hash"))]
    found = scan_text(rows, columns).filter("matching_rows > 0").collect()  # a row per column and pattern at most
    results = [
        {
            "test": f"no_{r.pattern}",
            "table_name": table,
            "column_name": r.column_name,
            "failures": r.matching_rows,
            "severity": severity,
            "status": severity,
        }
        for r in found
    ]
    if results and severity == "error":
        raise GateFailed(f"texts that look like personal data: {results}")
    return results


def run_day(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    streamed: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    ctx: RunContext,
    model: PipelineModel | None = None,
    limits: GateLimits = GateLimits(),
    lookback_days: int = LOOKBACK_DAYS,
    severity: str = "error",
    features: DataFrame | None = None,
    raw_customers: DataFrame | None = None,
) -> dict[str, object]:
    """Run one day. A failed test or gate stops the day where it stands; a rerun gives the same tables.

    Staged events go to the silver layer and the fact rows of the last days are merged into the mart, which is
    clustered and takes over new columns. Sessions that reach back further are continued from the session state, and older
    fact rows of a session that grew take its new size (events without a session are left as they were, see
    `sessions.current_counts`); days run in order. If the declared tests and freshness of all source tables hold (`raw_customers` as
    declared, with customer_id, if given), the day's event ids are new, and none of its fact rows' texts looks like personal data, the day is loaded into the served table
    and scored. Gates judge it last, and the served rows must be those of the mart. Give `features` where user features are kept in a table;
    otherwise they are computed from the whole mart.
    """
    day, first = ctx.ds.isoformat(), ctx.ds - dt.timedelta(days=lookback_days)
    staged = materialize_model(
        stage_events(raw, streamed, ctx, lookback_days), "stg_events", "table", lake.path("silver", "stg_events")
    )
    state = lake.path("gold", "session_days")
    earlier = materialize(state_before(read_state(spark, state), first), "sessions-before")
    facts = fct_events(staged, customers, transactions, ctx, True, lookback_days, earlier=earlier)
    facts = require_impersonal(facts)
    mart = lake.path("gold", "fct_events")
    keys, shape = ["event_date", "event_key"], facts.schema
    layout = {"partition_by": "event_date", "schema": shape, "evolve": True, "cluster_by": ["event_type", "user_id"]}
    merged = upsert_table(spark, mart, facts, keys, **layout)
    days = [(first + dt.timedelta(days=i)).isoformat() for i in range(lookback_days + 1)]
    grown = write_state(spark, state, recent(staged, "event_date", ctx, lookback_days), first, days)
    resized = recount(read_table(spark, mart, shape), grown, read_state(spark, state), first, named_only=True)
    resized = materialize(resized, "resized")
    recounted = resized.count()
    if recounted:
        upsert_table(spark, mart, resized, keys, **layout)

    landed = raw.filter(F.col("_partition_date") == ctx.ds_col)
    sources = {"raw_events": landed, "transactions": transactions, "events": streamed}
    if raw_customers is not None:
        sources["raw_customers"] = raw_customers
    tests = test_sources(spark, lake, sources, ctx, severity) + test_history(spark, lake, raw, ctx, severity)

    served = lake.path("gold", "fact_events")
    mart_day = read_table(spark, mart, shape, [("event_date", "=", ctx.ds)])
    tests += test_impersonal(mart_day, "fct_events", severity)
    loaded = replace_days(mart_day, served, "event_date", [day], cluster_by=["event_type", "user_id"])

    scored = None
    fact_day = read_table(spark, served, shape, [("event_date", "=", ctx.ds)])
    if model is not None:
        known = user_features(read_table(spark, mart, shape)) if features is None else features
        predictions = score(fact_day, known, model, ctx)
        scored = replace_days(predictions, lake.path("gold", "ml_predictions"), "event_date", [day])

    require(
        day_gates(day_counts(fact_day, "event_date"), limits.pass_value, limits.tolerance, limits.min_rows),
        "value_ok",
        "minimum_ok",
        "users_ok",
    )
    lake_day = landed.select(F.col("_partition_date").alias("day"))
    stream_day = streamed.filter(in_days("event_timestamp", ctx.ds, ctx.ds)).select(
        utc_day("event_timestamp").alias("day")
    )
    require(reconcile(lake_day, stream_day, "day", limits.max_drift), "drift_ok")
    unequal = reconcile_rows(mart_day, fact_day, "event_date", ["event_key"], mart_day.columns).limit(20).collect()
    if unequal:
        raise GateFailed(f"served rows are not those of the mart: {[r.asDict() for r in unequal]}")
    return {"merge": merged, "recounted": recounted, "tests": tests, "loaded": loaded, "scored": scored}


def append_predictions(predictions: DataFrame, path: str) -> int:
    """Add predictions to the table; a rerun of the day adds them again (see `replace_days`)."""
    mode = "append" if table_exists(predictions.sparkSession, path) else "overwrite"
    return write_days(predictions, path, "event_date", mode)["rows"]
