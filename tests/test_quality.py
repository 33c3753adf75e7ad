import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.context import RunContext
from eventide.operators.privacy import personal_columns, pseudonymize, redact_payload, require_impersonal, scan_text
from eventide.operators.quality import (
    SOURCE_TESTS,
    GateFailed,
    TableTests,
    day_counts,
    day_gates,
    freshness,
    reconcile,
    require,
    run_tests,
    test_and_store,
)
from tests.conftest import rows, ts

test_and_store.__test__ = False
CTX = RunContext.of("2024-01-10", "2024-01-10 12:00:00")
TESTS = TableTests("t", not_null=["a", "b"], unique=["a"], accepted={"b": ["x", "y"]})


def frame(spark):
    return spark.createDataFrame([(1, "x"), (1, "X"), (None, None), (None, "y")], "a int, b string")


def test_run_tests(spark):
    found = {(r.test, r.column_name): (r.failures, r.status) for r in run_tests(frame(spark), TESTS).collect()}
    assert found == {
        ("not_null", "a"): (2, "error"),
        ("not_null", "b"): (1, "error"),
        ("unique", "a"): (1, "error"),  # NULL is not a repeated value
        ("accepted_values", "b"): (1, "error"),  # case counts, NULL passes
    }


def test_row_tests_take_one_pass(spark):
    from eventide.operators.quality import row_tests

    plan = row_tests(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), TableTests("o", ["o_orderkey", "o_custkey"], accepted={"o_orderstatus": ["F"]}))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_failures_are_stored_before_the_error(spark, folder):
    with pytest.raises(GateFailed):
        test_and_store(frame(spark), TESTS, folder)
    assert rows(spark.read.parquet(f"{folder}/unique_t_a")) == [(1, 2)]
    assert rows(spark.read.parquet(f"{folder}/accepted_values_t_b")) == [("X", 1)]
    assert spark.read.parquet(f"{folder}/not_null_t_a").count() == 2


def test_warnings_do_not_stop(spark, folder):
    results = test_and_store(frame(spark), TESTS, folder, "warn")
    assert {r["status"] for r in results} == {"warn"}


def test_declared_tests_cover_the_sources():
    assert sum(len(t.not_null) for t in SOURCE_TESTS) == 14
    assert sum(len(t.unique) for t in SOURCE_TESTS) == 3
    assert sum(len(t.accepted) for t in SOURCE_TESTS) == 1


@pytest.mark.parametrize(
    "newest,status",
    [("2024-01-10 06:00:00", "pass"), ("2024-01-10 05:59:59", "warn"), ("2024-01-09 23:59:59", "error"), (None, "error")],
)
def test_freshness(spark, newest, status):
    df = spark.createDataFrame([(ts(newest) if newest else None,)], "at timestamp")
    assert freshness(df, "t", "at", CTX, 6, 12).first().status == status


@pytest.mark.parametrize("n,ok", [(949, False), (950, True), (1050, True), (1051, False)])
def test_value_gate_bounds(spark, n, ok):
    df = spark.range(n).select(F.lit(dt.date(2024, 1, 1)).alias("day"), F.lit("u").alias("user_id"))
    gates = day_gates(day_counts(df, "day"))
    assert gates.first().value_ok is ok and gates.first().minimum_ok is (n >= 1000)
    if ok:
        require(gates, "value_ok", "users_ok")
    else:
        with pytest.raises(GateFailed):
            require(gates, "value_ok", "users_ok")


def test_null_users_fail_the_gate(spark):
    df = spark.range(1000).select(F.lit(dt.date(2024, 1, 1)).alias("day"), F.nullif(F.col("id"), F.lit(5)).alias("user_id"))
    assert day_gates(day_counts(df, "day")).first().users_ok is False


def test_reconcile(spark):
    def side(**days):
        out = None
        for day, n in days.items():
            part = spark.range(n).select(F.lit(day).alias("day"))
            out = part if out is None else out.unionByName(part)
        return out

    found = {r.day: (r.left_rows, r.right_rows, r.drift_ok) for r in reconcile(side(a=1000, b=1000, c=5), side(a=991, b=990, d=2)).collect()}
    assert found == {"a": (1000, 991, True), "b": (1000, 990, False), "c": (5, 0, False), "d": (0, 2, False)}


def test_pseudonymize(spark):
    df = pseudonymize(spark.createDataFrame([("a@b.de", 1), (None, 2)], "email string, k int"), ["email"])
    assert df.columns == ["k", "email_hash"]
    assert [len(r.email_hash or "") for r in df.collect()] == [64, 0]


@pytest.mark.parametrize(
    "payload,expected",
    [
        ('{"email":"a@b.de","n":1,"t":true,"x":null,"o":{"c":[1,"2"]}}', '{"n":1,"t":true,"x":null,"o":{"c":[1,"2"]}}'),
        ('{"n":"1"}', '{"n":"1"}'),
        ('{"email":"a"}', "{}"),
        ('{"\\u0065mail":"a","n":1}', '{"n":1}'),
        ('{"n": 1.50}', '{"n": 1.50}'),
        ("[1]", None),
        ("broken", None),
        (None, None),
    ],
)
def test_redaction_keeps_types(spark, payload, expected):
    df = redact_payload(spark.createDataFrame([(payload,)], "p string"), "p", ["email"])
    assert df.first().p == expected


def test_scan_text(spark):
    df = spark.createDataFrame([("mail a.b@c.org now", "10.0.0.1"), (None, "none")], "x string, y string")
    found = {(r.column_name, r.pattern): r.matching_rows for r in scan_text(df).collect()}
    assert found[("x", "email")] == 1 and found[("y", "ip_address")] == 1 and sum(found.values()) == 2


def test_personal_column_names_are_refused(spark):
    df = spark.createDataFrame([("a", "b")], "user_id string, Email string")
    assert require_impersonal(df.drop("Email")).columns == ["user_id"]
    with pytest.raises(ValueError, match="Email"):
        require_impersonal(df)


def test_nested_and_differently_cased_keys_are_redacted(spark):
    payloads = [
        ('{"ctx":{"email":"x"},"a":1}', '{"a":1}'),
        ('{"Email":"x","b":[1,2]}', '{"b":[1,2]}'),
        ('{"c":[{"d":{"EMAIL":"x"}}],"e":"email: none"}', '{"e":"email: none"}'),
        ('{"f":{"\\u0065mail":"x"},"g":2}', '{"g":2}'),
        ('{"h":{"mail":"x"}}', '{"h":{"mail":"x"}}'),
    ]
    df = redact_payload(spark.createDataFrame([(p,) for p, _ in payloads], "p string"), "p", ["email"])
    assert [r.p for r in df.collect()] == [clean for _, clean in payloads]
    frame = spark.createDataFrame([], "user_email string, email_hash string, mailing string, ip_address string")
    assert personal_columns(frame) == ["user_email", "ip_address"]
