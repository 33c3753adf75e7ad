import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from eventide.operators.merge import AmbiguousSource
from eventide.sources.switch import create_table, remove_unused, switch_partitions, switch_table, upsert_switched
from eventide.storage import list_folders
from tests.conftest import rows

SCHEMA = "k int, v string, day date"


def table(spark, *data):
    return spark.createDataFrame([(k, v, dt.date(2024, 1, d) if d else None) for k, v, d in data], SCHEMA)


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def held(spark, name):
    return [(k, v, d.day) for k, v, d in rows(spark.table(name).select("k", "v", "day"))]


def test_a_failed_write_leaves_the_old_rows(spark, folder, name):
    create_table(spark, name, table(spark).schema, folder)
    assert held(spark, name) == []
    switch_table(spark, name, table(spark, (1, "a", 1), (2, "a", 2)), folder)
    broken = spark.table(name).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("no"))).otherwise("b"))
    with pytest.raises(Exception, match="no"):
        switch_table(spark, name, broken, folder)
    assert held(spark, name) == [(1, "a", 1), (2, "a", 2)]
    switch_table(spark, name, spark.table(name).withColumn("v", F.lit("c")), folder)
    assert held(spark, name) == [(1, "c", 1), (2, "c", 2)]
    assert len(remove_unused(spark, name, folder)) == 3
    assert held(spark, name) == [(1, "c", 1), (2, "c", 2)] and len(list_folders(spark, folder)) == 1


def test_partitions_are_switched_one_by_one(spark, folder, name):
    create_table(spark, name, table(spark).schema, folder, "day")
    keys = ["day", "k"]
    first = table(spark, (1, "a", 1), (2, "a", 2), (3, "a", 2), (4, "a", 3))
    assert upsert_switched(spark, name, first, keys, "day", folder)["rows_inserted"] == 4
    reader = spark.table(name).filter("day = '2024-01-02'")  # planned before the switch
    assert reader.count() == 2
    deletes = table(spark, (4, "", 3)).select("k", "day")
    done = upsert_switched(spark, name, table(spark, (2, "b", 2), (9, "b", 5)), keys, "day", folder, deletes, ["k"])
    assert done == {"rows_inserted": 1, "rows_updated": 1, "rows_deleted": 1}
    assert held(spark, name) == [(1, "a", 1), (2, "b", 2), (3, "a", 2), (9, "b", 5)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == [
        "day=2024-01-01",
        "day=2024-01-02",
        "day=2024-01-05",
    ]
    broken = table(spark, (1, "z", 1)).withColumn("v", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        switch_partitions(spark, name, broken, "day", [dt.date(2024, 1, 1)], folder)
    remove_unused(spark, name, folder)
    assert held(spark, name) == [(1, "a", 1), (2, "b", 2), (3, "a", 2), (9, "b", 5)]


def test_what_is_refused(spark, folder, name):
    create_table(spark, name, table(spark).schema, folder, "day")
    with pytest.raises(ValueError, match="key"):
        upsert_switched(spark, name, table(spark, (1, "a", 1)), ["k"], "day", folder)
    with pytest.raises(ValueError, match="without day"):
        upsert_switched(spark, name, table(spark, (1, "a", None)), ["day", "k"], "day", folder)
    with pytest.raises(AmbiguousSource):
        upsert_switched(spark, name, table(spark, (1, "a", 1), (1, "b", 1)), ["day", "k"], "day", folder)
    none = table(spark)
    assert upsert_switched(spark, name, none, ["day", "k"], "day", folder)["rows_inserted"] == 0
