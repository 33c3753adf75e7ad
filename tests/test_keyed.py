import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.operators.enrich import join_customers, join_daily_spend
from eventide.operators.keyed import first_per_key, with_neighbours
from eventide.operators.merge import merge_actions
from tests.conftest import rows

START = dt.datetime(2024, 1, 1)
EVENT = st.tuples(
    st.sampled_from([None, None, "a", "b"]),
    st.integers(0, 12),
    st.sampled_from(["click", "view", None]),
)


def _frame(spark, events):
    data = [(s, START + dt.timedelta(hours=8 * t), i, e) for i, (s, t, e) in enumerate(events)]
    return spark.createDataFrame(data, "session string, at timestamp, id long, type string")


def _columns(df, limit):
    return with_neighbours(
        df,
        ["session"],
        ["at", "id"],
        size="n",
        position="i",
        previous={"before": "type", "before_at": "at"},
        following={"after": "type"},
        max_group_rows=limit,
    )


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(EVENT, min_size=1, max_size=40))
def test_slices_give_what_one_window_gives(spark, events):
    df = _frame(spark, events)
    assert rows(_columns(df, 3)) == rows(_columns(df, None))


def test_hot_key_with_all_times_equal(spark):
    df = _frame(spark, [(None, 1, "view")] * 60 + [("a", 1, "click")] * 2)
    assert rows(_columns(df, 10)) == rows(_columns(df, None))


def test_hot_key_of_equal_rows_is_spread_evenly(spark, monkeypatch):
    from eventide.operators import keyed

    written = {}
    keep = keyed.materialize
    monkeypatch.setattr(
        keyed, "materialize", lambda df, name, path=None: written.setdefault(name, keep(df, name, path))
    )
    df = spark.range(20000).select(
        F.when(F.col("id") < 8000, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
        .alias("session"),
        F.lit(START).alias("at"),
        F.lit(1).cast("long").alias("id"),
        F.lit("view").alias("type"),
    )
    result = _columns(df, 1000)
    assert result.filter("session is null").agg(F.max("i"), F.max("n")).first()[:] == (8000, 8000)
    sizes = [r["count"] for r in written["slices"].groupBy("_slice").count().collect()]
    assert sum(sizes) == 8000 and len(sizes) >= 8 and max(sizes) <= 1500


def test_no_detour_without_hot_keys(spark):
    df = _frame(spark, [("a", 1, "view"), ("b", 2, "view")])
    plan = _columns(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_first_per_key_takes_the_earliest_and_breaks_ties_by_row(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (1, 3, "z"), (2, 9, "q")], "k int, t int, v string")
    first = first_per_key(df, ["k"], [F.col("t")])
    again = first_per_key(df.repartition(7), ["k"], [F.col("t")])
    assert rows(first) == rows(again)
    assert {(r.k, r.t) for r in first.collect()} == {(1, 3), (2, 9)}


def test_first_per_key_cuts_copies_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def _events(spark):
    return spark.createDataFrame(
        [("e1", "u1"), ("e2", None), ("e3", "u9"), ("e4", None)], "event_id string, user_id string"
    )


def test_customers_join_keeps_every_event(spark):
    customers = spark.createDataFrame([("u1", "gold"), (None, "nobody")], "user_id string, segment string")
    joined = join_customers(_events(spark), customers).select("event_id", "segment")
    assert rows(joined) == [("e1", "gold"), ("e2", None), ("e3", None), ("e4", None)]


def test_rows_without_key_are_spread_by_the_join(spark):
    auto = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(auto, "-1")
    try:
        customers = spark.createDataFrame([("u1", "gold")], "user_id string, segment string")
        joined = join_customers(_events(spark), customers, max_broadcast_rows=0)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(auto)
    assert plan.count("hashpartitioning(user_id") == 2 and plan.count("_salt") > 2
    few = join_customers(_events(spark), customers)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in few and rows(joined) == rows(join_customers(_events(spark), customers))
    assert "_salt#" in plan.split("hashpartitioning(user_id")[1].split(")")[0]


def test_daily_spend_sums_and_flags(spark):
    day = dt.date(2024, 1, 1)
    events = _events(spark).withColumn("event_date", F.lit(day))
    bought = spark.createDataFrame(
        [("u1", day, "1.10"), ("u1", day, "2.20"), ("u9", dt.date(2024, 1, 2), "5.00")],
        "customer_id string, transaction_date date, amount string",
    ).withColumn("amount_usd", F.col("amount").cast("decimal(18,2)"))
    joined = join_daily_spend(events, bought).select(
        "event_id", "has_same_day_transaction", F.col("transaction_amount_usd").cast("string")
    )
    assert rows(joined) == [("e1", True, "3.30"), ("e2", False, None), ("e3", False, None), ("e4", False, None)]


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@pytest.fixture
def small_partitions(spark):
    """Sizes at which a test table counts as skewed."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SKEW_SETTINGS:
        spark.conf.unset(key)


def _executed(df):
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


def test_hot_user_and_hot_merge_key_are_split_at_run_time(spark, small_partitions):
    # A third of the rows belongs to user 7, a third to no user.
    user = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))
    events = spark.range(300_000).select(
        F.col("id").cast("string").alias("event_id"),
        user.cast("string").alias("user_id"),
        F.md5(F.col("id").cast("string")).alias("x"),
    )
    customers = spark.range(5000).select(F.col("id").cast("string").alias("user_id"), F.lit("gold").alias("segment"))
    joined = join_customers(events, customers, max_broadcast_rows=0)
    assert "skew=true" in _executed(joined)
    known = 100_000 + len(range(1, 5000, 3))
    assert joined.filter("segment is not null").count() == known
    updates = customers.select(F.lit("new").alias("event_id"), "user_id", F.lit("x").alias("x"))
    merged = merge_actions(events, updates, ["user_id"])
    assert "skew=true" in _executed(merged)
    assert merged.filter("_action = 'update'").count() == known


def test_hot_day_of_one_user_is_split_at_run_time(spark, small_partitions):
    hot = F.when(F.col("id") % 4 != 0, F.lit(7)).otherwise(F.col("id"))
    events = spark.range(400_000).select(
        F.col("id").cast("string").alias("event_id"),
        hot.cast("string").alias("user_id"),
        F.lit("2024-01-01").cast("date").alias("event_date"),
        F.md5(F.col("id").cast("string")).alias("x"),
    )
    bought = spark.range(5000).select(
        F.col("id").cast("string").alias("customer_id"),
        F.lit("2024-01-01").cast("date").alias("transaction_date"),
        F.lit(2).cast("decimal(10,2)").alias("amount_usd"),
    )
    joined = join_daily_spend(events, bought)
    assert "skew=true" in _executed(joined)
    assert joined.filter("has_same_day_transaction").count() == 300_000 + 1250
