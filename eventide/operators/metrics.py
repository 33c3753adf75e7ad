"""Daily metrics, computed anew or kept up by taking old rows out and new rows in."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.keyed import same_keys
from eventide.operators.merge import on_values, touched_partitions, upsert_table
from eventide.sources.lake import read_table, replace_days
from eventide.storage import materialize, table_exists


def daily_user_metrics(events: DataFrame, amount: str | None = None) -> DataFrame:
    """One row per day, user and event type."""
    aggregates = [
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("session_id").alias("session_count"),
        F.min("event_timestamp").alias("first_event_at"),
        F.max("event_timestamp").alias("last_event_at"),
    ]
    if amount:
        aggregates.append(F.sum(amount).alias("amount_usd"))
    return events.groupBy("event_date", "user_id", "event_type").agg(*aggregates)


GROUP = ["event_date", "user_id", "event_type"]
PART = [*GROUP, "session_id"]
#: What a change is told by: two rows that agree in these change nothing.
MEASURED = [*PART, "event_timestamp", "amount"]
AMOUNT = "decimal(28,2)"
_GROUP_TYPES = "user_id string, event_type string"
PARTS_SCHEMA = f"{_GROUP_TYPES}, session_id string, events long, amounts long, amount {AMOUNT}, event_date date"
METRICS_SCHEMA = (
    f"{_GROUP_TYPES}, event_count long, session_count long, first_event_at timestamp, last_event_at timestamp, "
    f"amount_usd {AMOUNT}, event_date date"
)


def signed_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The measured values of rows that go (`weight` below zero) and come (above), as often as they do.

    Rows that are the same before and after cancel out, so a merge that repeats rows changes nothing.
    """
    sides = [rows.select(*MEASURED, F.lit(sign).alias("weight")) for rows, sign in ((before, -1), (after, 1))]
    weighed = sides[0].unionByName(sides[1]).groupBy(*MEASURED).agg(F.sum("weight").alias("weight"))
    return weighed.filter("weight != 0")


def metric_parts(events: DataFrame) -> DataFrame:
    """Counted sets: events, events with an amount, and amount of every session in a group."""
    amount = F.sum(F.coalesce("amount", F.lit(0))).cast(AMOUNT).alias("amount")
    return events.groupBy(*PART).agg(F.count(F.lit(1)).alias("events"), F.count("amount").alias("amounts"), amount)


def metrics_of_parts(parts: DataFrame, bounds: DataFrame) -> DataFrame:
    """Daily metrics from the counted sets and the first and last event of each group."""
    sums = parts.groupBy(*GROUP).agg(
        F.sum("events").alias("event_count"),
        F.count(F.col("session_id")).alias("session_count"),  # a row per session
        F.when(F.sum("amounts") > 0, F.sum("amount")).cast(AMOUNT).alias("amount_usd"),  # a sum of nothing is NULL
    )
    both = sums.alias("s").join(bounds.alias("b"), same_keys("s", "b", GROUP))
    return both.select(
        *[F.col(f"s.{c}") for c in GROUP],
        "event_count",
        "session_count",
        "first_event_at",
        "last_event_at",
        "amount_usd",
    )


def bounds_of(events: DataFrame) -> DataFrame:
    at = "event_timestamp"
    return events.groupBy(*GROUP).agg(F.min(at).alias("first_event_at"), F.max(at).alias("last_event_at"))


def retract(
    parts: DataFrame, metrics: DataFrame, changes: DataFrame, events: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The counted sets and metrics of all groups that `changes` touch, after the changes.

    Counts and amounts are the old ones plus signed sums. A least or latest time is only looked up in `events`
    (the rows after the changes) where the row that held it went; else the old and the new rows give it. A count
    that would fall below zero stops the job: the changes do not belong to these metrics.
    """
    at, went, came = F.col("event_timestamp"), F.col("weight") < 0, F.col("weight") > 0
    weight = F.col("weight")
    amount = F.coalesce(F.col("amount"), F.lit(0))
    delta = changes.groupBy(*PART).agg(
        F.sum(weight).alias("events"),
        F.sum(F.when(F.col("amount").isNotNull(), weight).otherwise(0)).alias("amounts"),
        F.sum(weight * amount).cast(AMOUNT).alias("amount"),
    )
    groups = changes.groupBy(*GROUP).agg(
        F.min(F.when(went, at)).alias("lost_first"),
        F.max(F.when(went, at)).alias("lost_last"),
        F.min(F.when(came, at)).alias("new_first"),
        F.max(F.when(came, at)).alias("new_last"),
    )
    groups = materialize(groups, "metric-groups")

    def of_groups(rows: DataFrame, some: DataFrame = groups) -> DataFrame:
        return rows.alias("r").join(some.alias("g"), same_keys("r", "g", GROUP), "left_semi")

    summed = of_groups(parts).select(*PART, "events", "amounts", "amount").unionByName(delta)
    summed = summed.groupBy(*PART).agg(
        F.sum("events").alias("events"),
        F.sum("amounts").alias("amounts"),
        F.sum("amount").cast(AMOUNT).alias("amount"),
    )
    wrong = F.raise_error(F.concat(F.lit("more rows retracted than counted on "), "event_date")).cast("long")
    summed = summed.withColumn("events", F.when(F.col("events") < 0, wrong).otherwise(F.col("events")))
    fresh = materialize(summed.filter("events != 0"), "metric-parts")

    held = metrics.alias("m").join(groups.alias("g"), same_keys("m", "g", GROUP), "right")
    held = held.select(*[F.col(f"g.{c}") for c in groups.columns], "m.first_event_at", "m.last_event_at")
    edge = (F.col("lost_first") <= F.col("first_event_at")) | (F.col("lost_last") >= F.col("last_event_at"))
    held = materialize(held.withColumn("edge", F.coalesce(edge, F.lit(False))), "metric-bounds")
    kept = held.filter(~F.col("edge")).select(
        *GROUP,
        F.least("first_event_at", "new_first").alias("first_event_at"),
        F.greatest("last_event_at", "new_last").alias("last_event_at"),
    )
    looked_up = bounds_of(of_groups(events, held.filter("edge").select(*GROUP)))
    return fresh, metrics_of_parts(fresh, kept.unionByName(looked_up))


def update_daily_metrics(
    spark: SparkSession, metrics_path: str, parts_path: str, changes: DataFrame, events: DataFrame
) -> list[Any]:
    """Bring the stored metrics and counted sets up to date with `signed_changes`; gives the days touched.

    `changes` is used several times and should be a table. Only these days are read, of `events` too, and written. Other groups of these days are copied. Tables that
    are missing are made from the changes alone.
    """
    events, days = touched_partitions(events, changes, "event_date")
    if days == []:
        return []
    own, there = [], {path: table_exists(spark, path) for path in (parts_path, metrics_path)}
    for path, schema in ((parts_path, PARTS_SCHEMA), (metrics_path, METRICS_SCHEMA)):
        stored = read_table(spark, path, schema) if there[path] else spark.createDataFrame([], schema)
        if days is None:
            own.append(touched_partitions(stored, changes, "event_date")[0])
        else:
            own.append(on_values(stored, "event_date", days))
    parts, metrics = retract(*own, changes, events)
    groups = changes.select(*GROUP).distinct()
    for path, old, new in ((parts_path, own[0], parts), (metrics_path, own[1], metrics)):
        rows = new
        if there[path]:  # a folder can't be overwritten while it is read
            others = old.alias("r").join(groups.alias("g"), same_keys("r", "g", GROUP), "left_anti")
            rows = materialize(others.unionByName(new), "metric-days")
        # Days that lose all rows have to be named; a table has as many as it has day folders.
        listed = days if days is not None else [r[0] for r in changes.select("event_date").distinct().collect()]
        listed = [d.isoformat() for d in listed]
        replace_days(rows, path, "event_date", listed)
    return days


def merge_and_count(
    spark: SparkSession,
    facts_path: str,
    metrics_path: str,
    parts_path: str,
    updates: DataFrame,
    keys: Sequence[str],
    deletes: DataFrame | None = None,
) -> dict[str, Any]:
    """Merge rows into day-partitioned facts and let their daily metrics follow.

    `keys` hold event_date, so an event that moves to another day is deleted there and inserted here.
    """
    updates = materialize(updates, "metric-updates")
    if table_exists(spark, facts_path):
        moved = updates.select(*keys)
        if deletes is not None:
            moved = moved.unionByName(deletes.select(*keys))
        stored, _ = touched_partitions(read_table(spark, facts_path, updates.schema), moved, "event_date")
        before = stored.join(moved.dropna().distinct(), list(keys), "left_semi")
        changes = materialize(signed_changes(before, updates), "metric-changes")
    else:  # all rows come, and none cancels out
        changes = updates.select(*MEASURED, F.lit(1).alias("weight"))
    done = upsert_table(
        spark, facts_path, updates, keys, partition_by="event_date", schema=updates.schema, deletes=deletes, stored=True
    )
    facts = read_table(spark, facts_path, updates.schema)
    return {**done, "days": update_daily_metrics(spark, metrics_path, parts_path, changes, facts)}
