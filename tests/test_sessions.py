import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventide.catalogue import roles
from eventide.context import RunContext
from eventide.operators import merge
from eventide.operators.metrics import (
    GROUP,
    METRICS_SCHEMA,
    PARTS_SCHEMA,
    bounds_of,
    merge_and_count,
    metric_parts,
    metrics_of_parts,
    retract,
    signed_changes,
)
from eventide.operators.snapshots import snapshot_amend, snapshot_history, vanished_keys
from eventide.plans.facts import fct_events, session_columns
from eventide.plans.sessions import (
    advance_state,
    current_counts,
    read_state,
    run_sessions,
    session_days,
    state_before,
)
from eventide.plans.staging import stage_events
from eventide.storage import materialize
from tests.conftest import SMALL, rows, ts

EVENTS = "event_id string, session_id string, event_timestamp timestamp, event_type string, event_date date"
COLUMNS = ["session_event_count", "session_event_sequence", "prev_event_type", "seconds_since_prev_event"]


def visits(spark, seed, days=8, n=120):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        at = dt.datetime(2024, 1, rng.randint(1, days), rng.choice([0, 12, 23]), rng.choice([0, 0, 59]))
        session = rng.choice(["a", "b", "c", None, f"s{i % 20}"])
        data.append((f"e{rng.randrange(10**6):06}", session, at, rng.choice("xyz"), at.date()))
    unique = {r[0]: r for r in data}
    return spark.createDataFrame(list(unique.values()), EVENTS)


def days(first, last):
    return [f"2024-01-{d:02}" for d in range(first, last + 1)]


def between(events, first, last):
    return events.filter(F.dayofmonth("event_date").between(first, last))


@pytest.mark.parametrize("max_group_rows", [None, 10])
def test_runs_give_the_numbers_of_a_full_refresh(spark, folder, max_group_rows):
    events = materialize(visits(spark, 3), "visits")
    early = F.col("event_type") != "z"  # z events of days 3 and 6 come one run later
    runs = [(1, 3, ~((F.dayofmonth("event_date") == 3) & ~early)), (2, 6, ~((F.dayofmonth("event_date") == 6) & ~early))]
    for first, last, there in [*runs, (5, 8, F.lit(True)), (5, 8, F.lit(True))]:
        own = materialize(between(events, first, last).filter(there), "run-visits")
        done = run_sessions(spark, own, f"{folder}/f", f"{folder}/s", days(first, last), max_group_rows)
    assert done["corrected"] == 0  # the last run was there already
    full = session_columns(events, None).select("event_id", *COLUMNS)
    assert rows(spark.read.parquet(f"{folder}/f").select("event_id", *COLUMNS)) == rows(full)


def test_corrected_days_keep_rows_of_one_id_and_of_none(spark, folder):
    """Events without an id, and one id in two sessions of which one grows: each row stays, once."""
    first = [(None, "a"), ("x", "a"), ("x", "b"), (None, "b"), ("y", None)]
    data = [(i, s, ts(f"2024-01-01T0{n}:00:00"), "view", dt.date(2024, 1, 1)) for n, (i, s) in enumerate(first)]
    more = [("z", "a", ts("2024-01-02T00:00:00"), "view", dt.date(2024, 1, 2))]
    run_sessions(spark, materialize(spark.createDataFrame(data, EVENTS), "v"), f"{folder}/f", f"{folder}/s", days(1, 1))
    done = run_sessions(spark, materialize(spark.createDataFrame(more, EVENTS), "v"), f"{folder}/f", f"{folder}/s", days(2, 2))
    assert done == {"rows": 1, "corrected": 2}
    got = spark.read.parquet(f"{folder}/f").select("event_id", "session_id", "session_event_count")
    assert rows(got) == rows(spark.createDataFrame([(None, "a", 3), ("x", "a", 3), ("x", "b", 2), (None, "b", 2), ("y", None, 1), ("z", "a", 3)], got.schema))


def test_counts_looked_up_at_reading_time(spark):
    events = materialize(visits(spark, 4), "visits")
    whole = advance_state(session_days(events), state_before(read_state(spark, "/nowhere"), None))
    old = session_columns(between(events, 1, 5), None)
    read = current_counts(old, whole).select("event_id", "session_event_count")
    full = session_columns(events, None).join(old.select("event_id"), "event_id")
    assert rows(read) == rows(full.select("event_id", "session_event_count"))


def test_a_session_that_shrinks_and_earlier_days_refused(spark, folder):
    events = visits(spark, 5)
    run_sessions(spark, between(events, 1, 4), f"{folder}/f", f"{folder}/s", days(1, 4))
    run_sessions(spark, between(events, 4, 6), f"{folder}/f", f"{folder}/s", days(4, 6))
    fewer = materialize(between(events, 5, 7).filter("event_type = 'x'"), "fewer")
    run_sessions(spark, fewer, f"{folder}/f", f"{folder}/s", days(5, 7))
    left = between(events, 1, 4).unionByName(fewer)
    full = session_columns(left, None).select("event_id", *COLUMNS)
    assert rows(spark.read.parquet(f"{folder}/f").select("event_id", *COLUMNS)) == rows(full)
    with pytest.raises(ValueError, match="days after"):
        run_sessions(spark, between(events, 1, 2), f"{folder}/f", f"{folder}/s", days(1, 2))


def test_fact_rows_of_an_incremental_run_count_from_the_beginning(spark):
    ctx = RunContext.of("2024-01-15", "2024-01-16 03:00:00", "test")
    staged = stage_events(roles.lake(spark, SMALL), roles.streamed(spark, SMALL), ctx, None)
    staged = staged.withColumn("session_id", F.col("user_id")).filter("event_date <= '2024-01-15'")
    staged = materialize(staged, "staged")
    people, bought = roles.customers(spark, SMALL), roles.transactions(spark, SMALL)
    state = advance_state(session_days(staged), state_before(read_state(spark, "/nowhere"), None))
    before = state_before(materialize(state, "state"), dt.date(2024, 1, 12))
    part = fct_events(staged, people, bought, ctx, True, earlier=before).select("event_id", *COLUMNS)
    full = fct_events(staged, people, bought, ctx).filter("event_date >= '2024-01-12'").select("event_id", *COLUMNS)
    assert rows(part) == rows(full)


# ---- metrics by retraction --------------------------------------------------------------------

FACTS = (
    "event_id string, event_date date, user_id string, event_type string, session_id string, "
    "event_timestamp timestamp, amount decimal(18,2)"
)


def measured(spark, seed, ids, days=4):
    rng = random.Random(seed)
    data = []
    for i in ids:
        at = dt.datetime(2024, 1, 1 + i % days, rng.randrange(24), rng.randrange(60))
        user, session = rng.choice(["u", "v", None]), rng.choice(["s", "t", None])
        amount = rng.choice([None, rng.randrange(1000)])
        data.append((f"e{i}", at.date(), user, rng.choice("ab"), session, at, amount))
    frame = spark.createDataFrame(data, FACTS.replace("decimal(18,2)", "int"))
    return frame.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def recomputed(facts):
    return metrics_of_parts(metric_parts(facts), bounds_of(facts)).select(*GROUP, "event_count", "session_count",
                                                                          "first_event_at", "last_event_at", "amount_usd")


def test_metrics_follow_merges(spark, folder):
    keys, paths = ["event_date", "event_id"], [f"{folder}/{n}" for n in "fmp"]
    merges = [
        (measured(spark, 1, range(60)), None),
        (measured(spark, 2, range(40, 80)), None),
        (measured(spark, 2, range(40, 80)), measured(spark, 1, range(0, 12)).select(*keys)),
        (measured(spark, 3, []), measured(spark, 1, [i for i in range(80) if i % 4 == 1]).select(*keys)),
    ]
    seen = []
    for updates, deletes in merges:
        done = merge_and_count(spark, *paths, materialize(updates, "updates"), keys, deletes)
        seen.append([d.day for d in done["days"]])
        facts = spark.read.schema(FACTS).parquet(paths[0])
        stored = spark.read.schema(METRICS_SCHEMA).parquet(paths[1])
        columns = recomputed(facts).columns
        assert rows(stored.select(*columns)) == rows(recomputed(facts))
    assert seen[3] == [2] and done["rows_deleted"] > 0
    assert stored.filter("event_date = '2024-01-02'").count() == 0
    before = spark.read.schema(FACTS).parquet(paths[0])
    assert merge_and_count(spark, *paths, before.limit(0), keys)["days"] == []


def test_stored_updates_are_not_copied_again(spark, folder, monkeypatch):
    copied = []
    monkeypatch.setattr(merge, "materialize", lambda df, name, *path: copied.append(name) or materialize(df, name, *path))
    paths = [f"{folder}/{n}" for n in "fmp"]
    for some in (range(30), range(20, 50)):
        merge_and_count(spark, *paths, measured(spark, 1, some), ["event_date", "event_id"])
    assert copied == []
    assert spark.read.parquet(paths[0]).count() == 50


def test_rows_that_do_not_change_touch_nothing(spark):
    facts = measured(spark, 1, range(30))
    assert signed_changes(facts, facts).count() == 0


def test_retracting_what_was_not_counted_fails(spark):
    facts = materialize(measured(spark, 1, range(30)), "facts")
    changes = signed_changes(measured(spark, 1, range(30)), facts.limit(0))
    with pytest.raises(Exception, match="retracted"):
        none = facts.limit(0)
        retract(spark.createDataFrame([], PARTS_SCHEMA), spark.createDataFrame([], METRICS_SCHEMA), changes, none)


# ---- snapshots in any order -------------------------------------------------------------------

VERSION = "k int, at timestamp, v int"


def spans(df):
    return rows(df.select("k", "at", "v", "valid_from", "valid_to"))


def empty(spark):
    return spark.createDataFrame([], f"{VERSION}, valid_from timestamp, valid_to timestamp")


@pytest.mark.parametrize("max_group_rows", [None, 3])
def test_any_order_of_arrival_gives_the_history(spark, max_group_rows):
    rng = random.Random(8)
    data = [(rng.choice([1, 2, 3, None]), ts(f"2024-01-{rng.randint(1, 9):02}"), i) for i in range(40)]
    whole = spark.createDataFrame([r for r in data if r[0]], VERSION)
    snapshot = empty(spark)
    for part in (data[30:], data[:10], data[10:30], data[5:35]):
        arrivals = spark.createDataFrame(part, VERSION)
        snapshot = materialize(
            snapshot_amend(snapshot, arrivals, "k", "at", "v", max_group_rows=max_group_rows), "amended"
        )
    assert spans(snapshot) == spans(snapshot_history(whole, "k", "at", "v", None))


def test_vanished_keys_close_and_open_again(spark):
    at = lambda d: ts(f"2024-01-{d:02}")
    first = spark.createDataFrame([(1, at(1), 1), (2, at(1), 1), (3, at(1), 1)], VERSION)
    snapshot = materialize(snapshot_amend(empty(spark), first, "k", "at", "v"), "spans")
    gone = vanished_keys(snapshot, first.filter("k = 3"), "k", F.lit("2024-01-05").cast("timestamp"))
    snapshot = materialize(snapshot_amend(snapshot, first.limit(0), "k", "at", "v", vanished=gone), "spans")
    assert spans(snapshot) == [
        (1, at(1), 1, at(1), at(5)),
        (2, at(1), 1, at(1), at(5)),
        (3, at(1), 1, at(1), None),
    ]
    # A late version before the end takes the end over; a newer one opens the key again.
    later = spark.createDataFrame([(1, at(3), 2), (2, at(8), 2)], VERSION)
    snapshot = materialize(snapshot_amend(snapshot, later, "k", "at", "v"), "spans")
    assert spans(snapshot) == [
        (1, at(1), 1, at(1), at(3)),
        (1, at(3), 2, at(3), at(5)),
        (2, at(1), 1, at(1), at(5)),
        (2, at(8), 2, at(8), None),
        (3, at(1), 1, at(1), None),
    ]
    none = spark.createDataFrame([(9, at(2)), (None, at(2))], "k int, closed_at timestamp")
    again = snapshot_amend(snapshot, later.limit(0), "k", "at", "v", vanished=none)
    assert spans(again) == spans(snapshot)
