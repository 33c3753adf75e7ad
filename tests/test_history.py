import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.evolve import add_column, append_additive, sync_columns
from eventide.operators.history import (
    append_commit,
    as_commit,
    read_as_of,
    read_log,
    read_version,
    table_history,
    vacuum,
)
from eventide.operators.snapshots import snapshot_history, snapshot_update
from tests.conftest import rows, ts


def log(spark):
    def commit(data, version, op="upsert"):
        df = spark.createDataFrame(data, "k int, v string")
        return as_commit(df, version, dt.datetime(2024, 1, version), op)

    return (
        commit([(1, "a"), (2, "a"), (None, "x")], 1)
        .unionByName(commit([(2, "b"), (3, "b")], 2))
        .unionByName(commit([(1, None)], 3, "delete"))
        .unionByName(commit([(None, "y"), (3, "d")], 4))
    )


def test_versions(spark):
    assert rows(read_version(log(spark), 1, ["k"])) == [(None, "x"), (1, "a"), (2, "a")]
    assert rows(read_version(log(spark), 2, ["k"])) == [(None, "x"), (1, "a"), (2, "b"), (3, "b")]
    assert rows(read_version(log(spark), 3, ["k"])) == [(None, "x"), (2, "b"), (3, "b")]
    assert rows(read_as_of(log(spark), ["k"])) == [(None, "x"), (None, "y"), (2, "b"), (3, "d")]


COMMITS = st.lists(
    st.tuples(
        st.sampled_from(["upsert", "upsert", "delete"]),
        st.dictionaries(st.integers(0, 5), st.sampled_from("abc"), min_size=1, max_size=5),
    ),
    min_size=1,
    max_size=4,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(COMMITS)
def test_every_version_is_the_replay_of_its_commits(spark, commits):
    log, table, expected = None, {}, []
    for version, (op, values) in enumerate(commits, 1):
        df = as_commit(spark.createDataFrame(list(values.items()), "k int, v string"), version, dt.datetime(2024, 1, version), op)
        log = df if log is None else log.unionByName(df)
        table = {k: v for k, v in table.items() if k not in values} | (values if op == "upsert" else {})
        expected.append(sorted(table.items()))
    assert [rows(read_version(log, v, ["k"])) for v in range(1, len(commits) + 1)] == expected
    assert rows(read_as_of(log, ["k"])) == expected[-1]


def test_large_first_commit_is_not_shuffled(spark, folder):
    append_commit(spark.range(10000).withColumn("v", F.lit("a")), folder, 1, dt.datetime(2024, 1, 1))
    append_commit(spark.range(5).withColumn("v", F.lit("b")), folder, 2, dt.datetime(2024, 1, 2))
    latest = read_as_of(read_log(spark, folder), ["id"])
    assert latest.count() == 10000 and latest.filter("v = 'b'").count() == 5
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_without_keys_versions_only_add(spark):
    added = log(spark).filter("_op = 'upsert'")
    assert read_version(added, 2).count() == 5 and read_as_of(added).count() == 7


def test_moment_exactly_on_a_commit_and_before_the_first(spark):
    on = read_as_of(log(spark), ["k"], as_of=ts("2024-01-02 00:00:00"))
    assert rows(on) == rows(read_version(log(spark), 2, ["k"]))
    with pytest.raises(LookupError):
        read_as_of(log(spark), ["k"], as_of=ts("2023-12-31 23:59:59"))


def test_moment_goes_before_version(spark):
    both = read_as_of(log(spark), ["k"], as_of=ts("2024-01-01 12:00:00"), version=4)
    assert rows(both) == rows(read_version(log(spark), 1, ["k"]))


@pytest.mark.parametrize("version", [0, 5])
def test_unknown_version(spark, version):
    with pytest.raises(LookupError):
        read_version(log(spark), version, ["k"])


def test_history_newest_first(spark):
    found = [r.asDict() for r in table_history(log(spark), 2).collect()]
    assert [(r["_commit_version"], r["rows_written"], r["rows_deleted"]) for r in found] == [(4, 2, 0), (3, 0, 1)]


def test_vacuum_keeps_versions_of_the_period(spark):
    clean = vacuum(log(spark), ["k"], dt.datetime(2024, 1, 10))  # the period begins on the 3rd
    for version in (3, 4):
        assert rows(read_version(clean, version, ["k"])) == rows(read_version(log(spark), version, ["k"]))
    assert clean.count() == 5
    with pytest.raises(LookupError):
        read_version(clean, 2, ["k"])


def test_vacuum_before_the_first_commit_changes_nothing(spark):
    assert rows(vacuum(log(spark), ["k"], dt.datetime(2024, 1, 2))) == rows(log(spark))


def test_vacuum_refuses_a_short_period(spark):
    with pytest.raises(ValueError):
        vacuum(log(spark), ["k"], dt.datetime(2024, 1, 10), retention_hours=24)
    assert vacuum(log(spark), ["k"], dt.datetime(2024, 1, 10), 24, enforce=False).count() == 4


def test_commit_written_again_replaces_itself(spark, folder):
    for version, values in ((1, [(1, "a")]), (2, [(1, "b")]), (2, [(1, "b")])):
        df = spark.createDataFrame(values, "k int, v string")
        append_commit(df, folder, version, dt.datetime(2024, 1, version))
    stored = read_log(spark, folder)
    assert stored.count() == 2
    assert rows(read_as_of(stored, ["k"])) == [(1, "b")]
    assert rows(read_as_of(stored, ["k"], version=1)) == [(1, "a")]


def updates(spark):
    return spark.createDataFrame(
        [(1, ts("2024-01-01"), "a", 1), (1, ts("2024-01-03"), "b", 2), (1, ts("2024-01-03"), "c", 3), (2, ts("2024-01-02"), "z", 4)],
        "k int, updated_at timestamp, v string, id int",
    )


@pytest.mark.parametrize("limit", [None, 1])
def test_snapshot_history(spark, limit):
    spans = snapshot_history(updates(spark), "k", "updated_at", "id", limit)
    assert rows(spans.select("k", "v", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"))) == [
        (1, "a", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        (1, "c", "2024-01-03 00:00:00", None),
        (2, "z", "2024-01-02 00:00:00", None),
    ]


def test_snapshot_update_step_by_step_equals_history(spark):
    one_per_time = updates(spark).filter("v != 'b'")
    whole = snapshot_history(one_per_time, "k", "updated_at", "id", None)
    built = whole.filter("false")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-03"):
        seen = one_per_time.filter(F.col("updated_at") <= F.lit(day).cast("timestamp"))
        newest = seen.groupBy("k").agg(F.max("updated_at").alias("updated_at"))
        current = seen.join(newest, ["k", "updated_at"])
        built = snapshot_update(built, current.select(updates(spark).columns), "k", "updated_at")
    assert rows(built.select(whole.columns)) == rows(whole)


def test_add_column(spark, caplog):
    df = spark.range(2)
    assert add_column(df, "x", T.StringType()).columns == ["id", "x"]
    assert add_column(df, "id", T.StringType()).schema == df.schema and "already exists" in caplog.text
    with pytest.raises(ValueError):
        add_column(df, "x", T.StringType(), nullable=False)
    assert add_column(spark.range(0), "x", T.StringType(), nullable=False).columns == ["id", "x"]


def test_additive_append(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, 0.5)], "k int, score double")
    assert rows(append_additive(old, new)) == [(1, "a", None), (2, None, 0.5)]
    with pytest.raises(TypeError):
        append_additive(old, spark.createDataFrame([("x",)], "k string"))


def test_sync_columns(spark):
    old = spark.createDataFrame([(1, "7", "gone")], "k int, n string, x string")
    target = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("new", T.DateType()), T.StructField("k", T.IntegerType())])
    assert rows(sync_columns(old, target)) == [(7, None, 1)]
    bad = spark.createDataFrame([(1, "seven", "")], "k int, n string, x string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sync_columns(bad, target).collect()


def test_snapshot_update_takes_the_newest_of_equal_keys_and_no_row_without_key(spark):
    schema = "k int, v string, updated_at timestamp, valid_from timestamp, valid_to timestamp"
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5)
    snapshot = spark.createDataFrame([(1, "a", old, old, None)], schema)
    news = [(1, "b", dt.datetime(2024, 1, 3)), (1, "c", new), (None, "d", new), (2, "e", new), (2, "e", new)]
    current = spark.createDataFrame(news, "k int, v string, updated_at timestamp")
    for _ in range(2):
        snapshot = snapshot_update(snapshot, current, "k", "updated_at")
    assert rows(snapshot.select("k", "v", "valid_to")) == rows(
        spark.createDataFrame([(1, "a", new), (1, "c", None), (2, "e", None)], "k int, v string, valid_to timestamp")
    )
