import hashlib

import pytest
from pyspark.sql import functions as F

from eventide.functions import (
    all_of,
    in_days,
    json_scalar,
    parse_payload,
    sha256_hex,
    surrogate_key,
    url_origin,
    whole_seconds_between,
)
from eventide.sources.incremental import changed_between
from tests.conftest import ts


@pytest.mark.parametrize(
    "payload,expected",
    [
        ('{"k":"x"}', "x"),
        ('{"other":1}', None),
        ('{"k":null}', None),
        ('{"k":{"c":2}}', None),
        ('{"k":[1,2]}', None),
        ('{"k":"{not an object}"}', "{not an object}"),
        ('{"k":"[text]"}', "[text]"),
        ('{"k":true}', "true"),
        ('{"k":7}', "7"),
        ('{"k":1.50}', "1.5"),
        ('{"k":"é"}', "é"),
        ('{"k":""}', ""),
        ('{"k":"cut off', None),
        ("plain text", None),
        ("", None),
        (None, None),
    ],
)
def test_json_scalar(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "p string").withColumn("_j", parse_payload("p", ["k", "z"]))
    assert df.select(json_scalar("_j", "p", "k")).first()[0] == expected


def test_payload_keys_are_plain_names(spark):
    with pytest.raises(ValueError):
        parse_payload("p", ["a.b"])


def test_url_origin(spark):
    urls = ["http://a/b", "https://a", "https://a.b:80/c?d", "ftp://x/y", "", None, "see http://a"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(url_origin("u"))
    assert [r[0] for r in df.collect()] == ["http://a", "https://a", "https://a.b:80", None, None, None, None]


@pytest.mark.parametrize(
    "start,end,seconds",
    [
        ("2024-01-01 00:00:00.900", "2024-01-01 00:00:02.100", 1),
        ("2024-01-01 00:00:02.100", "2024-01-01 00:00:00.900", -1),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:01", 2),
        ("2024-01-01 00:00:00", None, None),
    ],
)
def test_whole_seconds(spark, start, end, seconds):
    df = spark.createDataFrame([(ts(start), ts(end) if end else None)], "s timestamp, e timestamp")
    assert df.select(whole_seconds_between("e", "s")).first()[0] == seconds


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string").select(surrogate_key(["x", "y"]))
    marker = "_dbt_utils_surrogate_key_null_"
    assert [r[0] for r in df.collect()] == [
        hashlib.md5(f"a-{marker}".encode()).hexdigest(),
        hashlib.md5(b"a-").hexdigest(),
    ]


def test_sha256_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string").select(sha256_hex("x"))
    assert [r[0] for r in df.collect()] == [hashlib.sha256(b"a").hexdigest(), None]


def test_filters(spark):
    df = spark.range(10)
    assert df.filter(all_of([("id", ">=", 3), ("id", "not in", [4, 5]), ("id", "!=", 9)])).count() == 4
    assert df.filter(all_of(None)).count() == 10
    with pytest.raises(ValueError):
        all_of([("id", "~", 1)])


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_filters_reach_the_files(spark, kind):
    df = spark.read.schema(f"event_id long, ts {kind}").parquet("/root/testdata/sf0.001/events.parquet")
    for condition in (
        all_of([("ts", ">=", ts("2024-01-05 06:00:00")), ("event_id", "in", [200, 201])]),
        changed_between("ts", ts("2024-01-05"), "2024-01-06"),
    ):
        plan = df.filter(condition)._jdf.queryExecution().executedPlan().toString()
        pushed = plan.split("PushedFilters: ")[1].split("]")[0]
        assert "(ts,2024-01-05" in pushed
    assert df.filter(changed_between("ts", ts("2024-01-05"), "2024-01-06")).count() == 80


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_day_filter_reaches_the_files(spark, kind):
    schema = f"event_id long, ts {kind}"
    df = spark.read.schema(schema).parquet("/root/testdata/sf0.001/events.parquet")
    day = ts("2024-01-05").date()
    plan = df.filter(in_days("ts", day, day))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert df.filter(in_days("ts", day, day)).count() == df.filter(F.to_date("ts") == F.lit(day)).count()
