import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.merge import AmbiguousSource
from eventide.plans.tables import VersionedTable
from tests.conftest import rows


def day(n):
    return dt.datetime(2024, 1, n)


def data(spark, *values):
    return spark.createDataFrame(list(values), "k int, v string")


def filled(spark, folder):
    table = VersionedTable(spark, folder, ["k"])
    first = table.upsert(data(spark, (1, "a"), (2, "a"), (None, "x")), day(1))
    second = table.upsert(data(spark, (2, "b"), (3, "b"), (None, "y")), day(2))
    return table, first, second


def test_upserts_and_metrics(spark, folder):
    table, first, second = filled(spark, folder)
    assert (first["created"], first["rows_inserted"], first["rows_updated"]) == (True, 3, 0)
    assert (second["created"], second["rows_inserted"], second["rows_updated"]) == (False, 2, 1)
    assert rows(table.read()) == [(None, "x"), (None, "y"), (1, "a"), (2, "b"), (3, "b")]
    assert rows(table.read(version=1)) == [(None, "x"), (1, "a"), (2, "a")]
    assert rows(table.read(as_of=day(1))) == rows(table.read(version=1))
    assert rows(table.read(filters=[("v", "=", "b")])) == [(2, "b"), (3, "b")]
    assert [r["_commit_version"] for r in table.history(1).collect()] == [2]


def test_filter_sees_only_current_rows(spark, folder):
    table, *_ = filled(spark, folder)
    # Key 2 held "a" once, but not any more.
    assert rows(table.read(filters=[("v", "=", "a")])) == [(1, "a")]


def test_retry_of_a_commit(spark, folder):
    table, _, second = filled(spark, folder)
    again = table.upsert(data(spark, (2, "b"), (3, "b"), (None, "y")), day(2), version=second["version"])
    assert (again["rows_inserted"], again["rows_updated"]) == (2, 1)
    assert table.last_version() == 2 and table.log().count() == 6


def test_ambiguous_rows_are_refused(spark, folder):
    table, *_ = filled(spark, folder)
    with pytest.raises(AmbiguousSource):
        table.upsert(data(spark, (9, "a"), (9, "b")), day(3))
    assert table.last_version() == 2


def test_added_column(spark, folder):
    table, *_ = filled(spark, folder)
    assert table.add_column("score", T.DoubleType(), day(3)) is True
    assert table.add_column("score", T.DoubleType(), day(3)) is False
    assert rows(table.read(filters=[("k", "=", 1)])) == [(1, "a", None)]
    wider = spark.createDataFrame([(1, "c", 0.5)], "k int, v string, score double")
    assert table.upsert(wider, day(4))["rows_updated"] == 1
    assert rows(table.read(filters=[("k", "<", 3)])) == [(1, "c", 0.5), (2, "b", None)]


def test_care_keeps_the_period_readable(spark, folder):
    table, *_ = filled(spark, folder)
    table.upsert(data(spark, (1, "c")), day(3))
    latest = rows(table.read())
    table = VersionedTable(spark, folder, ["k"], data(spark).schema)
    done = table.optimize_and_vacuum(dt.datetime(2024, 1, 9, 12), ["k"])
    assert done["rows_removed"] == 1 and done["files_after"] <= done["files_before"]
    assert rows(table.read()) == latest
    assert (1, "a") in rows(table.read(version=2))
    with pytest.raises(LookupError):
        table.read(version=1)


def test_care_bounds_the_rows_that_a_task_sorts(spark, folder):
    table = VersionedTable(spark, folder, ["k"], data(spark).schema)
    table.upsert(data(spark, *[(i, f"v{i}") for i in range(90)]), day(1))
    latest = rows(table.read())
    done = table.optimize_and_vacuum(dt.datetime(2024, 1, 9, 12), ["k"], rows_per_file=10)
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
    assert done["files_after"] == len(sizes) >= 9 and max(sizes) < 20
    assert rows(table.read()) == latest


def test_table_without_keys_grows(spark, folder):
    table = VersionedTable(spark, folder)
    for n in (1, 2):
        table.upsert(data(spark, (1, "a")), day(n))
    assert table.read().count() == 2 and table.read(version=1).count() == 1


def test_log_of_a_stream_is_a_versioned_table(spark, folder):
    from eventide.operators.history import append_commit

    append_commit(data(spark, (1, "a"), (2, "a")), folder, 0, day(1))  # streams count batches from 0
    table = VersionedTable(spark, folder, ["k"])
    assert table.upsert(data(spark, (1, "b")), day(2), version=1)["rows_updated"] == 1
    assert rows(table.read()) == [(1, "b"), (2, "a")] and rows(table.read(version=0)) == [(1, "a"), (2, "a")]
    assert table.upsert(data(spark, (1, "z"), (2, "a")), day(1), version=0)["version"] == 0
    assert rows(table.read()) == [(1, "b"), (2, "a")] and rows(table.read(version=0)) == [(1, "z"), (2, "a")]
