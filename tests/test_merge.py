import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventide.operators.merge import (
    AmbiguousSource,
    ambiguous_keys,
    merge_actions,
    merge_frames,
    merge_metrics,
    upsert_table,
)
from tests.conftest import rows

SCHEMA = "k int, j int, v string"


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_update_insert_keep(spark):
    target = table(spark, (1, 1, "old"), (2, 1, "old"), (2, 2, "old"))
    source = table(spark, (2, 1, "new"), (3, 1, "new"))
    actions = merge_actions(target, source, ["k", "j"])
    assert rows(actions) == [
        (1, 1, "old", "keep"),
        (2, 1, "new", "update"),
        (2, 2, "old", "keep"),
        (3, 1, "new", "insert"),
    ]
    assert merge_metrics(actions).first().asDict() == {"rows_inserted": 1, "rows_updated": 1, "rows_deleted": 0}


def test_null_keys_never_match(spark):
    merged = merge_frames(table(spark, (None, 1, "old")), table(spark, (None, 1, "new")), ["k", "j"])
    assert rows(merged) == [(None, 1, "new"), (None, 1, "old")]


def test_every_target_row_of_a_key_is_updated(spark):
    merged = merge_frames(table(spark, (1, 1, "a"), (1, 1, "b")), table(spark, (1, 1, "new")), ["k", "j"])
    assert rows(merged) == [(1, 1, "new"), (1, 1, "new")]


def test_null_values_overwrite(spark):
    assert rows(merge_frames(table(spark, (1, 1, "a")), table(spark, (1, 1, None)), ["k", "j"])) == [(1, 1, None)]


def test_empty_source_changes_nothing(spark):
    target = table(spark, (1, 1, "a"))
    assert rows(merge_frames(target, table(spark), ["k", "j"])) == rows(target)


def test_columns_must_agree(spark):
    with pytest.raises(ValueError):
        merge_frames(table(spark), table(spark).drop("v"), ["k"])


def test_column_order_of_the_source_does_not_matter(spark):
    source = table(spark, (1, 2, "new")).select("v", "j", "k")
    assert rows(merge_frames(table(spark, (1, 2, "old")), source, ["k", "j"])) == [(1, 2, "new")]


KEYS = st.integers(0, 6)
TABLE = st.dictionaries(st.tuples(KEYS, KEYS), st.sampled_from("abc"), max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(TABLE, TABLE)
def test_merge_again_changes_nothing(spark, old, new):
    target = table(spark, *[(*k, v) for k, v in old.items()])
    source = table(spark, *[(*k, v) for k, v in new.items()])
    once = merge_frames(target, source, ["k", "j"])
    assert rows(once) == sorted([(*k, v) for k, v in (old | new).items()], key=lambda r: [str(x) for x in r])
    assert rows(merge_frames(once, source, ["k", "j"])) == rows(once)


def test_ambiguous_keys(spark):
    source = table(spark, (1, 1, "a"), (1, 1, "b"), (2, 1, "a"), (2, 1, "b"), (None, 1, "a"), (None, 1, "b"))
    assert rows(ambiguous_keys(source, ["k", "j"])) == [(1, 1, 2), (2, 1, 2)]
    assert rows(ambiguous_keys(source, ["k", "j"], table(spark, (2, 1, "old")))) == [(2, 1, 2)]


def test_table_is_created_then_merged(spark, folder):
    assert upsert_table(spark, folder, table(spark, (1, 1, "a"), (2, 1, "a")), ["k"]) == {
        "created": True,
        "rows_inserted": 2,
    }
    outcome = upsert_table(spark, folder, table(spark, (2, 1, "b"), (3, 1, "b")), ["k"])
    assert outcome == {"created": False, "rows_inserted": 1, "rows_updated": 1, "rows_deleted": 0}
    assert rows(spark.read.parquet(folder)) == [(1, 1, "a"), (2, 1, "b"), (3, 1, "b")]


def test_ambiguous_source_leaves_the_table_alone(spark, folder):
    upsert_table(spark, folder, table(spark, (1, 1, "a")), ["k"])
    with pytest.raises(AmbiguousSource):
        upsert_table(spark, folder, table(spark, (1, 1, "b"), (1, 2, "c")), ["k"])
    assert rows(spark.read.parquet(folder)) == [(1, 1, "a")]


def test_newest_update_of_a_key_counts(spark, folder):
    upsert_table(spark, folder, table(spark, (1, 1, "a"), (1, 2, "b"), (None, 1, "n")), ["k"], newest_by="j")
    upsert_table(spark, folder, table(spark, (1, 5, "c"), (1, 4, "d"), (2, 1, "e")), ["k"], newest_by="j")
    assert rows(spark.read.parquet(folder)) == [(None, 1, "n"), (1, 5, "c"), (2, 1, "e")]


def test_only_touched_partitions_are_rewritten(spark, folder):
    from eventide.storage import list_files

    first = table(spark, (1, 1, "a"), (2, 2, "a"), (None, 3, "n"))
    upsert_table(spark, folder, first, ["k", "j"], partition_by="k")
    before = {path for path, _ in list_files(spark, folder) if "k=1" in path}
    upsert_table(spark, folder, table(spark, (2, 2, "b"), (None, 3, "m"), (4, 4, "b")), ["k", "j"], partition_by="k")
    assert {path for path, _ in list_files(spark, folder) if "k=1" in path} == before
    # The row without a partition value is kept beside the new one.
    assert rows(spark.read.parquet(folder).select("k", "j", "v")) == [
        (None, 3, "m"),
        (None, 3, "n"),
        (1, 1, "a"),
        (2, 2, "b"),
        (4, 4, "b"),
    ]


def test_evolving_table_follows_the_columns_of_its_updates(spark, folder):
    upsert_table(spark, folder, table(spark, (1, 1, "a"), (2, 1, "a")), ["k"])
    wider = spark.createDataFrame([(2, "b", 0.5)], "k int, v string, score double")
    upsert_table(spark, folder, wider, ["k"], evolve=True)
    assert rows(spark.read.parquet(folder).select("k", "v", "score")) == [(1, "a", None), (2, "b", 0.5)]


def test_empty_updates(spark, folder):
    none = table(spark)
    assert upsert_table(spark, folder, none, ["k", "j"], partition_by="k", schema=none.schema)["rows_inserted"] == 0
    done = upsert_table(spark, folder, table(spark, (1, 1, "a")), ["k", "j"], partition_by="k", schema=none.schema)
    assert (done["created"], done["rows_inserted"]) == (True, 1)
    done = upsert_table(spark, folder, none, ["k", "j"], partition_by="k", schema=none.schema)
    assert (done["rows_inserted"], done["rows_updated"]) == (0, 0)
    assert rows(spark.read.parquet(folder).select("k", "j", "v")) == [(1, 1, "a")]


def test_empty_first_load_without_schema(spark, folder):
    upsert_table(spark, folder, table(spark), ["k", "j"], partition_by="k")
    done = upsert_table(spark, folder, table(spark, (1, 1, "a")), ["k", "j"], partition_by="k")
    assert done["rows_inserted"] == 1
    assert rows(spark.read.parquet(folder).select("k", "j", "v")) == [(1, 1, "a")]
