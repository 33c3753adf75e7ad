"""Session columns kept up from day to day, with the numbers of a full refresh.

A run computes the events of its last days only, while a session may reach back further. What it needs of a
session's past is small: how many events there were, and the last one. The state table holds, for each session
and day on which it was active, the events of that day, those so far, and the last event. A run
reads the state before its first day, adds it to the windows over its own events, and writes the state of its days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.functions import whole_seconds_between
from eventide.operators.keyed import MAX_GROUP_ROWS, same_keys, small_side, with_neighbours
from eventide.operators.merge import touched_partitions
from eventide.sources.lake import read_table, replace_days
from eventide.storage import materialize, table_exists

STATE = "session_id string, events long, so_far long, last_at timestamp, last_type string, event_date date"


def session_days(events: DataFrame) -> DataFrame:
    """One row per session and day: events, and time and type of the last one. NULL is a session like others."""
    last = F.max(F.struct("event_timestamp", "event_id", "event_type")).alias("last")
    days = events.groupBy("session_id", "event_date").agg(F.count(F.lit(1)).alias("events"), last)
    return days.select(
        "session_id",
        "event_date",
        "events",
        F.col("last.event_timestamp").alias("last_at"),
        F.col("last.event_type").alias("last_type"),
    )


def read_state(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], STATE)
    return read_table(spark, path, STATE)


def state_before(state: DataFrame, first: dt.date | None) -> DataFrame:
    """For each session what was known of it before a day: events so far, and the last one. One row each."""
    if first is not None:
        state = state.filter(F.col("event_date") < F.lit(first.isoformat()).cast("date"))
    newest = F.max(F.struct("event_date", "so_far", "last_at", "last_type")).alias("s")
    return state.groupBy("session_id").agg(newest).select("session_id", "s.so_far", "s.last_at", "s.last_type")


def continue_sessions(
    events: DataFrame, before: DataFrame, max_group_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """`events` of some days with the session columns that a window over all days would give.

    `before` comes from `state_before` for the first of these days, and may hold other sessions too. Events of
    equal time are ordered by id; no event of the days lies before one that the state has counted.
    """
    rows = with_neighbours(
        events,
        ["session_id"],
        ["event_timestamp", "event_id"],
        size="_size",
        position="_place",
        previous={"_prev_type": "event_type", "_prev_at": "event_timestamp"},
        max_group_rows=max_group_rows,
    )
    here = events.select("session_id").distinct()
    known = before.alias("b").join(here.alias("h"), same_keys("b", "h", ["session_id"]), "left_semi")
    known = materialize(known, "session-offsets")
    both = rows.alias("r").join(known.alias("k"), same_keys("r", "k", ["session_id"]), "left")
    earlier = F.coalesce("k.so_far", F.lit(0))
    first = F.col("r._place") == 1
    previous_at = F.when(first, F.col("k.last_at")).otherwise(F.col("r._prev_at"))
    return both.select(
        *[F.col(f"r.{c}") for c in events.columns],
        (F.col("r._size") + earlier).alias("session_event_count"),
        (F.col("r._place") + earlier).alias("session_event_sequence"),
        F.when(first, F.col("k.last_type")).otherwise(F.col("r._prev_type")).alias("prev_event_type"),
        whole_seconds_between(F.col("r.event_timestamp"), previous_at).alias("seconds_since_prev_event"),
    )


def advance_state(days: DataFrame, before: DataFrame) -> DataFrame:
    """State rows of some days, from their `session_days` and the state before them."""
    so_far = Window.partitionBy("session_id").orderBy("event_date")  # a row per day of the run
    rows = days.withColumn("_here", F.sum("events").over(so_far)).alias("d")
    both = rows.join(before.alias("b"), same_keys("d", "b", ["session_id"]), "left")
    return both.select(
        "d.session_id",
        "d.events",
        (F.col("d._here") + F.coalesce("b.so_far", F.lit(0))).alias("so_far"),
        "d.last_at",
        "d.last_type",
        "d.event_date",
    )


def write_state(
    spark: SparkSession, path: str, events: DataFrame, first: dt.date | None, days: Sequence[str]
) -> DataFrame:
    """Replace the state of `days`, the first of which is `first`, and give the sessions whose size changed.

    The result has session_id and total, for sessions with events before `first` and another number of events
    than when the state was last written. Their older events still hold the old number, see `recount`. Days are
    written in order: once later days are there, earlier ones are refused.
    """
    old = read_state(spark, path)
    if old.filter(F.col("event_date") > F.lit(max(days)).cast("date")).limit(1).count():
        raise ValueError(f"the session state has days after {max(days)}; remove them and run them again")
    before = materialize(state_before(old, first), "state-before")
    fresh = materialize(advance_state(session_days(events), before), "state-days")
    latest = state_before(old, None).select("session_id", F.col("so_far").alias("was"))
    # A session that has no events in these days any more shrinks to what it was before them.
    now = fresh.groupBy("session_id").agg(F.max("so_far").alias("now"))
    both = before.alias("b").join(now.alias("n"), same_keys("b", "n", ["session_id"]), "left")
    both = both.select("b.session_id", F.coalesce("n.now", "b.so_far").alias("total")).alias("t")
    changed = both.join(latest.alias("l"), same_keys("t", "l", ["session_id"])).filter("t.total != l.was")
    changed = materialize(changed.select("t.session_id", "t.total"), "sessions-changed")
    replace_days(fresh, path, "event_date", days)
    return changed


def recount(
    facts: DataFrame, changed: DataFrame, state: DataFrame, first: dt.date, named_only: bool = False
) -> DataFrame:
    """Fact rows before the day `first` whose session has changed its size, with the new one.

    Only days are read on which such sessions were active, as the state knows. Events without a session are one
    group that is active every day; `named_only` leaves their old rows alone (see `current_counts`).
    """
    if named_only:
        changed = changed.filter(F.col("session_id").isNotNull())
    older = F.col("event_date") < F.lit(first.isoformat()).cast("date")
    days = state.filter(older).alias("s").join(changed.alias("c"), same_keys("s", "c", ["session_id"]), "left_semi")
    facts, _ = touched_partitions(facts.filter(older), days, "event_date")
    both = facts.alias("f").join(changed.alias("c"), same_keys("f", "c", ["session_id"]))
    both = both.filter("f.session_event_count != c.total")
    count = F.col("c.total").alias("session_event_count")
    return both.select(*[count if c == "session_event_count" else F.col(f"f.{c}") for c in facts.columns])


def recounted_days(facts: DataFrame, changed: DataFrame, state: DataFrame, first: dt.date) -> DataFrame:
    """All fact rows of the days before `first` on which sessions that changed their size were active, with the new sizes.

    `_corrected` says which rows differ from the old ones.
    """
    older = F.col("event_date") < F.lit(first.isoformat()).cast("date")
    days = state.filter(older).alias("s").join(changed.alias("c"), same_keys("s", "c", ["session_id"]), "left_semi")
    facts, _ = touched_partitions(facts.filter(older), days, "event_date")
    both = facts.alias("f").join(small_side(changed).alias("c"), same_keys("f", "c", ["session_id"]), "left")
    count = F.coalesce("c.total", "f.session_event_count").alias("session_event_count")
    columns = [count if c == "session_event_count" else F.col(f"f.{c}") for c in facts.columns]
    return both.select(*columns, F.coalesce(F.col("f.session_event_count") != F.col("c.total"), F.lit(False)).alias("_corrected"))


def current_counts(facts: DataFrame, state: DataFrame) -> DataFrame:
    """Facts with the sizes that their sessions have by now, looked up when they are read."""
    latest = state_before(state, None).select("session_id", "so_far")
    both = facts.alias("f").join(latest.alias("l"), same_keys("f", "l", ["session_id"]), "left")
    count = F.coalesce("l.so_far", "f.session_event_count").alias("session_event_count")
    return both.select(*[count if c == "session_event_count" else F.col(f"f.{c}") for c in facts.columns])


def run_sessions(
    spark: SparkSession,
    events: DataFrame,
    facts_path: str,
    state_path: str,
    days: Sequence[str],
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> dict[str, Any]:
    """Write the session columns of the events of `days`, which follow each other, into a day-partitioned table.

    `events` holds all events of these days and no others. Older rows of sessions that grew or shrank are
    corrected. A rerun gives the same tables.
    """
    first = dt.date.fromisoformat(min(days))
    before = state_before(read_state(spark, state_path), first)
    rows = continue_sessions(events, before, max_group_rows)
    written = replace_days(rows, facts_path, "event_date", days)
    changed = write_state(spark, state_path, events, first, days)
    facts = read_table(spark, facts_path, rows.schema)
    if not changed.limit(1).count():
        return {"rows": written, "corrected": 0}
    older = materialize(recounted_days(facts, changed, read_state(spark, state_path), first), "corrected-days")
    corrected = older.filter("_corrected").count()
    if corrected:
        replace_days(older.drop("_corrected"), facts_path, "event_date")
    return {"rows": written, "corrected": corrected}
