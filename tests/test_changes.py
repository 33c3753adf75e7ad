import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventide.operators.changes import apply_changes, snapshot_changes
from eventide.operators.checksums import block_sums, reconcile_rows
from eventide.operators.membership import day_filters, known_keys, repeated_in_history, store_filters
from eventide.operators.merge import AmbiguousSource, merge_actions, merge_metrics, touched_partitions, upsert_table
from eventide.storage import list_folders
from tests.conftest import rows

SCHEMA = "k int, j int, v string"
KEYS = st.one_of(st.none(), st.integers(0, 4))
ROWS = st.lists(st.tuples(KEYS, KEYS, st.sampled_from(["a", "b", None])), max_size=10)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def one_per_key(data):
    """Rows with a NULL key as they are, of the others the first of each key."""
    seen = {}
    loose = [r for r in data if None in r[:2]]
    for r in data:
        if None not in r[:2]:
            seen.setdefault(r[:2], r)
    return list(seen.values()), loose


@FEW
@given(ROWS, ROWS)
def test_changes_lead_from_one_extract_to_the_other(spark, old, new):
    (old, old_loose), (new, new_loose) = one_per_key(old), one_per_key(new)
    first, second = table(spark, *old, *old_loose), table(spark, *new, *new_loose)
    changes = snapshot_changes(first, second, ["k", "j"])
    got = Counter(tuple(r) for r in changes.collect())
    was, now = {r[:2]: r for r in old}, {r[:2]: r for r in new}
    expected = Counter((*now[k], "insert") for k in now.keys() - was.keys())
    expected += Counter((*was[k], "delete") for k in was.keys() - now.keys())
    expected += Counter((*now[k], "update") for k in was.keys() & now.keys() if was[k] != now[k])
    more, less = Counter(new_loose) - Counter(old_loose), Counter(old_loose) - Counter(new_loose)
    expected += Counter({(*r, "insert"): n for r, n in more.items()})
    expected += Counter({(*r, "delete"): n for r, n in less.items()})
    assert got == expected
    assert rows(apply_changes(first, changes, ["k", "j"])) == rows(second)


def test_copies_of_a_row_are_one_and_different_rows_are_refused(spark):
    old = table(spark, (1, 1, "a"), (1, 1, "a"), (2, 1, "a"))
    new = table(spark, (1, 1, "b"), (1, 1, "b"), (2, 1, "a"), (3, 1, "c"), (3, 1, "c"))
    assert rows(snapshot_changes(old, new, ["k"])) == [(1, 1, "b", "update"), (3, 1, "c", "insert")]
    with pytest.raises(AmbiguousSource):
        snapshot_changes(old, table(spark, (1, 1, "a"), (1, 2, "a")), ["k"])
    with pytest.raises(ValueError):
        snapshot_changes(old, new.drop("v"), ["k"])


def test_values_swapped_between_columns_are_a_change(spark):
    old = spark.createDataFrame([(1, None, "x"), (2, "x", "y")], "k int, a string, b string")
    new = spark.createDataFrame([(1, "x", None), (2, "y", "x")], "k int, a string, b string")
    assert rows(snapshot_changes(old, new, ["k"])) == [(1, "x", None, "update"), (2, "y", "x", "update")]


def test_deletes_of_a_merge(spark):
    target = table(spark, (1, 1, "a"), (2, 1, "a"), (3, 1, "a"), (None, 1, "n"))
    source = table(spark, (2, 1, "b"), (4, 1, "b"))
    gone = table(spark, (1, 1, "?"), (2, 1, "?"), (9, 1, "?"), (None, 1, "?"))
    actions = merge_actions(target, source, ["k"], gone)
    assert rows(actions) == [
        (None, 1, "n", "keep"),
        (1, 1, "a", "delete"),
        (2, 1, "b", "update"),
        (3, 1, "a", "keep"),
        (4, 1, "b", "insert"),
    ]
    assert merge_metrics(actions).first().asDict() == {"rows_inserted": 1, "rows_updated": 1, "rows_deleted": 1}


def test_a_partition_that_loses_all_rows_is_dropped(spark, folder):
    schema = "day date, k int, v string"
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    full = spark.createDataFrame([(d, k, "a") for d in days for k in (1, 2)], schema)
    upsert_table(spark, folder, full, ["day", "k"], partition_by="day")
    gone = spark.createDataFrame([(days[0], 1), (days[0], 2), (days[1], 1)], "day date, k int")
    done = upsert_table(
        spark, folder, full.limit(0), ["day", "k"], partition_by="day", schema=full.schema, deletes=gone
    )
    assert (done["rows_deleted"], done["rows_updated"], done["rows_inserted"]) == (3, 0, 0)
    assert [n for n in list_folders(spark, folder) if "=" in n] == ["day=2024-01-02", "day=2024-01-03"]
    left = spark.read.schema(full.schema).parquet(folder).select("day", "k", "v")
    assert rows(left) == rows(full.join(gone, ["day", "k"], "left_anti"))


@pytest.mark.parametrize("most", [1000, 1])
def test_only_touched_partitions_are_scanned(spark, folder, most):
    schema = "day date, k int"
    days = [dt.date(2024, 1, d) for d in range(1, 21)]
    spark.createDataFrame([(d, 1) for d in days], schema).write.partitionBy("day").parquet(folder)
    stored = spark.read.schema(schema).parquet(folder)
    changes = spark.createDataFrame([(days[3], 1), (days[4], 2)], schema)
    rows_of, values = touched_partitions(stored, changes, "day", most)
    assert rows(rows_of.select("day")) == [(days[3],), (days[4],)]
    plan = rows_of._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "PartitionFilters" in text and ("2024-01-04" in text or "19726" in text)
    scanned = text[text.index("PartitionFilters") :].split("]")[0]
    assert "isnotnull(day)" not in scanned or "IN" in scanned or ">=" in scanned
    assert (values is None) == (most == 1)


def test_changes_without_a_partition_value(spark, folder):
    schema = "day date, k int"
    spark.createDataFrame([(None, 1), (dt.date(2024, 1, 1), 2)], schema).write.partitionBy("day").parquet(folder)
    stored = spark.read.schema(schema).parquet(folder)
    only_null = spark.createDataFrame([(None, 5)], schema)
    assert rows(touched_partitions(stored, only_null, "day")[0].select("k")) == [(1,)]
    assert touched_partitions(stored, only_null.limit(0), "day")[0].count() == 0


# ---- checksums --------------------------------------------------------------------------------

EVENTS = "day date, id int, v string"


def events(spark, *data):
    return spark.createDataFrame([(dt.date(2024, 1, d) if d else None, i, v) for d, i, v in data], EVENTS)


def test_planted_differences_are_found_to_the_key(spark):
    base = [(d, 100 * d + i, "x") for d in (1, 2, 3) for i in range(50)] + [(None, None, "n")] * 3
    left = events(spark, *base)
    other = [r for r in base if r[1] != 107]  # lost
    other = [(d, i, "y" if i == 211 else v) for d, i, v in other]  # changed
    other += [(3, 301, "x"), (3, 301, "x"), (4, 999, "new"), (None, None, "n")]  # copied twice, extra, copied
    right = events(spark, *other)
    found = reconcile_rows(left, right, "day", ["id"], left.columns, buckets=8)
    day = lambda d: dt.date(2024, 1, d)
    assert rows(found) == rows(
        spark.createDataFrame(
            [
                (day(1), 107, 1, 0, "missing"),
                (day(2), 211, 1, 1, "changed"),
                (day(3), 301, 1, 3, "copied"),
                (day(4), 999, 0, 1, "extra"),
                (None, None, 3, 4, "copied"),
            ],
            found.schema,
        )
    )


def test_equal_sides_differ_in_nothing_whatever_their_order(spark):
    data = [(d, i, None if i % 3 else "v") for d in (1, 2) for i in range(40)]
    left, right = events(spark, *data), events(spark, *reversed(data))
    assert reconcile_rows(left, right, "day", ["id"], left.columns).count() == 0
    plan = block_sums(left, "day", ["id"], left.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bit_xor" in plan
    assert reconcile_rows(left.limit(0), right.limit(0), "day", ["id"], left.columns).count() == 0


# ---- membership -------------------------------------------------------------------------------


@pytest.mark.parametrize(("bits", "count"), [(1 << 26, 4), (64, 1), (128, 3)])
def test_known_keys_are_exact_however_full_the_filter(spark, bits, count):
    history = events(spark, *[(1 + i % 5, i, "h") for i in range(300)], (2, 7, "again"), (3, None, "n"))
    new = events(spark, (9, 7, "x"), (9, 298, "x"), (9, 5000, "x"), (9, 5001, "x"), (9, 5001, "y"), (9, None, "z"))
    filters = day_filters(history, "id", "day", bits, count)
    known = known_keys(new, history, filters, "id", "day", bits, count).collect()
    day = lambda d: dt.date(2024, 1, d)
    assert {r.key: r.days for r in known} == {7: [day(2), day(3)], 298: [day(4)]}
    found = repeated_in_history(new, history, filters, "id", "day", bits, count).collect()
    assert {r.unique_field: (r.n_records, len(r.known_days)) for r in found} == {7: (1, 2), 298: (1, 1), 5001: (2, 0)}
    assert repeated_in_history(new, history.limit(0), filters.limit(0), "id", "day", bits, count).count() == 1


def test_history_is_neither_shuffled_nor_read_on_other_days(spark, folder):
    history = events(spark, *[(1 + i % 20, i, "h") for i in range(200)])
    history.write.partitionBy("day").parquet(folder)
    history = spark.read.schema(EVENTS).parquet(folder)
    filters = day_filters(history, "id", "day")
    known = known_keys(events(spark, (25, 5, "x"), (25, 6, "x")), history, filters, "id", "day")
    known.collect()
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    scan = [line for line in plan.split("\n") if "PartitionFilters: [" in line and "day#" in line]
    assert scan and all("day" in x.split("PartitionFilters")[1][:120] and "2024-01-06,2024-01-07" in x for x in scan)


def test_filters_of_a_day_are_replaced(spark, folder):
    first = events(spark, (1, 1, "a"), (2, 2, "a"))
    assert store_filters(spark, folder, first, "id", "day", ["2024-01-01", "2024-01-02"]).count() == 0
    others = store_filters(spark, folder, events(spark, (2, 3, "a")), "id", "day", ["2024-01-02"])
    assert {r.event_date.day for r in others.collect()} == {1}
    assert known_keys(events(spark, (3, 1, "x"), (3, 2, "x")), first, others, "id", "day").count() == 1
