import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.layout import bucket_of, clustered, column_bounds, compact, z_ordered, z_value
from eventide.operators.merge import upsert_table
from eventide.schemas import EVENTS_SCHEMA, SchemaMismatch, compare_schemas
from eventide.sources.database import change_query
from eventide.sources.files import load_seed, register_table, take_landed
from eventide.sources.incremental import (
    advance_watermark,
    changed_between,
    day_folder,
    extract_changes,
    ingest_day,
    land_day,
    lookup_watermark,
    read_control,
    typed_copy,
)
from eventide.sources.lake import Lake, append_bronze, read_table, replace_days, required_nulls
from eventide.storage import list_files, list_folders
from tests.conftest import rows, ts

DAY = dt.date(2024, 1, 10)


def bronze(spark, n=3, **changes):
    base = {
        "event_id": F.col("id").cast("string"),
        "event_timestamp": F.lit(ts("2024-01-10 10:00:00")),
        "user_id": F.lit("u"),
        "session_id": F.lit(None).cast("string"),
        "event_type": F.lit("click"),
        "source_system": F.lit("app"),
        "country_code": F.lit("de"),
        "device_type": F.lit("web"),
        "payload": F.lit("{}"),
        "_ingestion_timestamp": F.lit(ts("2024-01-10 11:00:00")),
        "_partition_date": F.lit(DAY),
    } | changes
    return spark.range(n).select([v.alias(k) for k, v in base.items()])


def test_paths():
    assert Lake("s3://b/").path("silver", "t") == "s3://b/silver/t"
    assert day_folder("/x/", "2024-01-05") == "/x/2024/01/05"


def test_schema_gate_names_every_difference(spark):
    wrong = bronze(spark, user_id=F.lit(1)).drop("payload").withColumn("more", F.lit(1))
    diff = compare_schemas(wrong.schema, EVENTS_SCHEMA)
    assert (diff.extra, diff.missing) == (["more"], ["payload"])
    assert diff.retyped == ["user_id: int instead of string"]
    assert not compare_schemas(bronze(spark).schema, EVENTS_SCHEMA)
    assert compare_schemas(bronze(spark).select(*reversed(EVENTS_SCHEMA.names)).schema, EVENTS_SCHEMA).reordered


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("more", F.lit(1)),
        lambda df: df.drop("payload"),
        lambda df: df.withColumn("user_id", F.lit(1)),
        lambda df: df.select(*reversed(df.columns)),
    ],
)
def test_strict_gate_refuses(spark, folder, change):
    with pytest.raises(SchemaMismatch):
        append_bronze(change(bronze(spark)), folder)


def test_null_in_required_column_stops_the_write(spark, folder):
    append_bronze(bronze(spark), folder)
    bad = bronze(spark, event_type=F.when(F.col("id") != 1, F.lit("click")))
    assert required_nulls(bad, EVENTS_SCHEMA) == {"event_type": 1}
    with pytest.raises(Exception, match="NULL in required column event_type"):
        append_bronze(bad, folder)
    assert read_table(spark, folder).count() == 3


def test_append_counts_and_adds(spark, folder):
    assert append_bronze(bronze(spark), folder) == 3
    assert append_bronze(bronze(spark, 2, _partition_date=F.lit(dt.date(2024, 1, 11))), folder) == 2
    assert list_folders(spark, folder) == ["_partition_date=2024-01-10", "_partition_date=2024-01-11"]
    day = read_table(spark, folder, EVENTS_SCHEMA, [("_partition_date", "=", dt.date(2024, 1, 11))])
    assert day.count() == 2
    assert "PartitionFilters: [isnotnull(_partition_date" in day._jdf.queryExecution().executedPlan().toString()


def test_additive_gate_lets_new_columns_in(spark, folder):
    append_bronze(bronze(spark), folder)
    wider = bronze(spark).withColumn("campaign", F.lit("spring")).select("campaign", *EVENTS_SCHEMA.names)
    append_bronze(wider, folder, schema_mode="additive")
    assert rows(read_table(spark, folder).groupBy("campaign").count()) == [(None, 3), ("spring", 3)]
    with pytest.raises(SchemaMismatch):
        append_bronze(bronze(spark).drop("payload"), folder, schema_mode="additive")


def test_replace_days_empties_a_day(spark, folder):
    df = spark.range(30).select("id", F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("day"))
    replace_days(df, folder, "day")
    replace_days(df.filter("day = '2024-01-10'").limit(0), folder, "day", ["2024-01-11"])
    assert rows(read_table(spark, folder).groupBy(F.col("day").cast("string")).count()) == [
        ("2024-01-10", 10),
        ("2024-01-12", 10),
    ]


def test_filters_and_columns_reach_the_files(spark):
    df = read_table(spark, "/root/testdata/sf0.001/lineitem.parquet", None, [("l_quantity", ">", 49.0)], ["l_orderkey"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def control(spark, *loads):
    return spark.createDataFrame(
        [("p", t, ts(at), 1) for t, at in loads],
        "pipeline_name string, table_name string, last_load_timestamp timestamp, rows_copied long",
    )


def test_watermark_lookup(spark, folder):
    state = control(spark, ("a", "2024-01-01"), ("a", "2024-01-03"), ("b", "2024-01-09"))
    assert lookup_watermark(state, "p", "a") == ts("2024-01-03")
    assert lookup_watermark(state, "p", "none") is None
    assert lookup_watermark(read_control(spark, folder), "p", "a") is None
    advance_watermark(spark, folder, "p", "a", ts("2024-01-05 01:02:03.000004"), 7)
    assert lookup_watermark(read_control(spark, folder), "p", "a") == ts("2024-01-05 01:02:03.000004")


def moments(spark, *at):
    return spark.createDataFrame([(i, ts(t)) for i, t in enumerate(at)], "id long, updated_at timestamp")


def test_range_bounds(spark):
    df = moments(spark, "2024-01-01", "2024-01-01 00:00:01", "2024-01-02 23:59:59", "2024-01-02 23:59:59.5", "2024-01-03")
    ids = lambda *args, **kw: [r[0] for r in rows(extract_changes(df, *args, **kw).select("id"))]
    assert ids(ts("2024-01-01"), "2024-01-02") == [1, 2]
    assert ids(None, "2024-01-02") == [0, 1, 2]
    assert ids(ts("2024-01-01"), "2024-01-02", upper="next_midnight") == [1, 2, 3]
    # The next run takes what the second 23:59:59 left behind.
    assert ids(ts("2024-01-02"), "2024-01-03") == [2, 3, 4]
    with pytest.raises(ValueError):
        changed_between("updated_at", None, "2024-01-02", "noon")


def test_landing_a_day_twice_leaves_one_copy(spark, folder):
    df = moments(spark, "2024-01-02", "2024-01-02 05:00:00")
    for _ in range(2):
        path, count = land_day(df, folder, "2024-01-02")
        assert (path, count) == (f"{folder}/2024/01/02", 2)
    assert spark.read.parquet(path).count() == 2
    assert all(name.endswith(".snappy.parquet") for name, _ in list_files(spark, path))


@pytest.mark.parametrize("advance,expected", [("partition_date", "2024-01-02"), ("max_seen", "2024-01-02 05:00:00")])
def test_ingest_is_repeatable(spark, folder, advance, expected):
    df = moments(spark, "2024-01-01 03:00:00", "2024-01-02 05:00:00", "2024-01-03 01:00:00")

    def run(day):
        return ingest_day(
            spark,
            lambda: df,
            lambda new: upsert_table(spark, f"{folder}/table", new, ["id"]),
            f"{folder}/control",
            f"{folder}/landed",
            "p",
            "t",
            day,
            advance=advance,
        )

    first = run("2024-01-02")
    assert (first["watermark"], first["rows_copied"], first["load"]["created"]) == (None, 2, True)
    assert lookup_watermark(read_control(spark, f"{folder}/control"), "p", "t") == ts(expected)
    run("2024-01-02")
    run("2024-01-03")
    assert rows(spark.read.parquet(f"{folder}/table").select("id")) == [(0,), (1,), (2,)]


def test_ingest_converts_and_sets_aside(spark, folder):
    df = moments(spark, "2024-01-01", "2024-01-01").withColumn("n", F.when(F.col("id") == 0, "7").otherwise("x"))
    schema = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("updated_at", T.TimestampType()),
            T.StructField("n", T.IntegerType()),
        ]
    )
    done = ingest_day(
        spark, lambda: df, lambda new: new.count(), f"{folder}/c", f"{folder}/l", "p", "t", "2024-01-02", schema=schema
    )
    assert (done["rows_copied"], done["rows_refused"], done["load"]) == (1, 1, 1)
    assert rows(spark.read.parquet(f"{folder}/l_refused/2024/01/02").select("id", "n")) == [(1, "x")]


def test_day_without_changes(spark, folder):
    df = moments(spark, "2024-01-01 03:00:00")

    def run(day):
        return ingest_day(
            spark, lambda: df, lambda new: upsert_table(spark, f"{folder}/t", new, ["id"]), f"{folder}/c", f"{folder}/l",
            "p", "t", day, advance="max_seen",
        )

    assert run("2023-12-31")["rows_copied"] == 0
    assert run("2024-01-01")["rows_copied"] == 1
    assert run("2024-01-02")["rows_copied"] == 0
    assert lookup_watermark(read_control(spark, f"{folder}/c"), "p", "t") == ts("2024-01-01 03:00:00")
    assert spark.read.parquet(f"{folder}/t").count() == 1


def test_failed_load_leaves_the_watermark(spark, folder):
    def fail(_):
        raise RuntimeError("no load")

    with pytest.raises(RuntimeError):
        ingest_day(
            spark, lambda: moments(spark, "2024-01-01"), fail, f"{folder}/c", f"{folder}/l", "p", "t", "2024-01-02"
        )
    assert read_control(spark, f"{folder}/c").count() == 0


def test_typed_copy_loses_nothing(spark):
    df = spark.createDataFrame(
        [("1", 1.25, "2024-01-01"), ("x", 1.25, "2024-01-01"), ("2", 1.255, None), ("99999999999", 1.0, None), (None, None, "2024-01-01 10:00:00"), ("3", None, "2024-01-01 00:00:00")],
        "n string, d double, t string",
    )
    target = T.StructType(
        [
            T.StructField("n", T.IntegerType()),
            T.StructField("d", T.DecimalType(10, 2)),
            T.StructField("t", T.DateType()),
        ]
    )
    good, bad = typed_copy(df, target)
    assert [r[0] for r in rows(good.select("n"))] == [1, 3] and good.schema.simpleString() == "struct<n:int,d:decimal(10,2),t:date>"
    assert bad.count() == 4 and bad.columns == df.columns


def test_boolean_is_not_a_number(spark):
    df = spark.createDataFrame([(True,)], "b boolean")
    with pytest.raises(TypeError):
        typed_copy(df, T.StructType([T.StructField("b", T.IntegerType())]))


def test_change_query():
    text = change_query("dbo.t", "updated_at", ts("2024-01-01"), "2024-01-02")
    assert text == (
        "(SELECT * FROM dbo.t WHERE updated_at <= TIMESTAMP '2024-01-02 23:59:59'"
        " AND updated_at > TIMESTAMP '2024-01-01 00:00:00') changes"
    )
    assert " AND " not in change_query("t", "u", None, "2024-01-02", "next_midnight")


def test_landed_files_are_taken_once(spark, folder):
    for i in range(2):
        spark.range(i * 10, i * 10 + 5).write.mode("append").json(f"{folder}/raw/20240101")
        take_landed(spark, f"{folder}/raw/20240101", f"{folder}/t", f"{folder}/c", "id long")
    take_landed(spark, f"{folder}/raw/20240101", f"{folder}/t", f"{folder}/c", "id long")
    assert spark.read.parquet(f"{folder}/t").count() == 10


def test_registered_table_sees_new_partitions(spark, folder):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.StringType())])
    for day in "abc":
        spark.range(3).withColumn("day", F.lit(day)).write.mode("append").partitionBy("day").parquet(folder)
        if day == "a":
            assert register_table(spark, "reg_test", folder, schema, "day").count() == 3
    assert register_table(spark, "reg_test", folder, schema, "day", ["a", "c"]).count() == 6
    assert register_table(spark, "reg_test", folder, schema, "day").count() == 9
    spark.sql("DROP TABLE reg_test")


def test_seed(spark, folder):
    spark.createDataFrame([(1, "a,b"), (2, None)], "k int, v string").write.csv(folder, header=True)
    assert rows(load_seed(spark, folder, "k int, v string")) == [(1, "a,b"), (2, None)]
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|malformed"):
        load_seed(spark, folder, "k int, v date").collect()


def test_compaction(spark, folder):
    spark.range(1000).repartition(20, "id").write.parquet(f"{folder}/small")
    before, after = compact(spark, f"{folder}/small", f"{folder}/large")
    assert before == 20 and after < 5
    assert rows(spark.read.parquet(f"{folder}/large")) == rows(spark.range(1000))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) != "256m"


def test_clustering_splits_a_hot_combination(spark):
    df = spark.range(4000).select(F.lit(DAY).alias("day"), F.lit("view").alias("type"), "id")
    sizes = clustered(df, "day", ["type"], 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(s["count"] for s in sizes) < 1000


def test_layouts_split_exact_copies_of_a_stored_table(spark, folder):
    spark.range(4000).select(F.lit(DAY).alias("day"), F.lit("view").alias("type")).write.parquet(folder)
    df = spark.read.parquet(folder)
    for laid_out in (clustered(df, "day", ["type"], 8, stored=True), z_ordered(df, ["type"], files=8, stored=True)):
        assert laid_out.columns == df.columns
        sizes = laid_out.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 8 and max(s["count"] for s in sizes) < 1000


def test_z_buckets_and_bits(spark):
    df = spark.createDataFrame([(None,), (1,), (5,), (9,)], "x int")
    buckets = [r[0] for r in df.select(bucket_of("x", [2, 5, 8])).collect()]
    assert buckets == [0, 0, 2, 3]
    z = spark.range(1).select(z_value([F.lit(0b11), F.lit(0b01)], 2)).first()[0]
    assert z == 0b0111


def test_z_order_skips_files_for_both_columns(spark, folder):
    df = spark.range(20000).select((F.col("id") % 200).alias("a"), F.floor(F.col("id") / 100).alias("b"))
    z_ordered(df, ["a", "b"], files=16).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert rows(stored.groupBy().agg(F.count("*"), F.sum("a"), F.sum("b"))) == rows(
        df.groupBy().agg(F.count("*"), F.sum("a"), F.sum("b"))
    )
    for column in ("a", "b"):
        spans = stored.groupBy(F.input_file_name()).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        hit = spans.filter("lo <= 20 and hi >= 20").count()
        assert hit <= 8
    assert len(column_bounds(df, ["a"], 64)["a"]) <= 63


def test_conversions_that_would_lose_digits_are_refused(spark):
    def kept(values, source, target):
        df = spark.createDataFrame([(v,) for v in values], f"x {source}")
        good, bad = typed_copy(df, T.StructType([T.StructField("x", T._parse_datatype_string(target))]))
        return [r.x for r in good.collect()], bad.count()

    whole = "1234567890123456789012345"
    assert kept([whole, "1.5", "2.0", "9" * 39], "string", "decimal(38,0)") == ([D(whole), D(2)], 2)
    assert kept(["1.234", "1.230", " -1.2 ", "1e2", "x"], "string", "decimal(9,2)") == ([D("1.23"), D("-1.2"), D(100)], 2)
    assert kept([9007199254740992, 9007199254740993], "bigint", "double") == ([9007199254740992.0], 1)
    assert kept([0.5, 0.1, float("inf")], "double", "float") == ([0.5, float("inf")], 1)
    assert kept([1.0, 1.5], "double", "int") == ([1], 1)
    times = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 5)]
    assert kept(times, "timestamp", "date") == ([dt.date(2024, 1, 1)], 1)


def test_text_is_cut_at_its_quantiles(spark):
    ids = spark.range(1000).selectExpr("concat('user_', lpad(id, 6, '0')) as u", "id % 7 as n").repartition(5)
    bounds = column_bounds(ids, ["u", "n"], 8)["u"]
    assert len(bounds) == 7 and bounds == sorted(bounds)
    sizes = [r["count"] for r in ids.groupBy(bucket_of("u", bounds)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 250
    assert column_bounds(ids.filter("n > 9"), ["u"], 8) == {"u": []}
    assert len(column_bounds(ids.withColumn("u", F.lit("same")), ["u"], 8)["u"]) <= 1
