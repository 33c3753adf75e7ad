import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.operators.payloads import choose_columns, discover, typed_payload, whole_schema
from eventide.operators.ranking import by_score, evaluate
from tests.conftest import rows

SCORED = "score double, label int"


def auc(data):
    pos, neg = [s for s, x in data if x == 1], [s for s, x in data if x != 1]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def buckets(data, n):
    """(rows, positives) of each bucket, each score's rows spread evenly over its ranks."""
    order = sorted(data, key=lambda r: -r[0])
    share = {s: sum(x for t, x in data if t == s) / sum(t == s for t, _ in data) for s, _ in data}
    size, out = len(order) / n, [[0.0, 0.0] for _ in range(n)]
    for i, (s, _) in enumerate(order):
        for b in range(n):
            part = min(i + 1, (b + 1) * size) - max(i, b * size)
            if part > 0:
                out[b][0] += part
                out[b][1] += part * share[s]
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=1, max_size=40))
def test_auc_and_lift_are_exact_with_ties(spark, data):
    found = evaluate(spark.createDataFrame([(float(s), x) for s, x in data], SCORED), "score", "label", 4)
    got = {r.bucket: r for r in found.collect()}
    expected, share = buckets(data, 4), sum(x for _, x in data) / len(data)
    for b, (n, p) in enumerate(expected, 1):
        assert got[b].rows == pytest.approx(n) and got[b].positives == pytest.approx(p)
        assert got[b].lift == (pytest.approx(p / n / share) if share else None)
        assert got[b].auc == (pytest.approx(auc(data)) if auc(data) is not None else None)


def test_ranks_over_many_ranges_and_a_hot_score(spark):
    rng = random.Random(2)
    data = [(rng.choice([0.5, rng.random()]), rng.randint(0, 1)) for _ in range(3000)]
    frame = spark.createDataFrame(data, SCORED).repartition(9)
    ranks = {r.score: r for r in by_score(frame, "score", "label").collect()}
    for s in [0.5, *rng.sample(sorted(ranks), 20)]:
        assert ranks[s].positives_above == sum(x for t, x in data if t > s)
        assert ranks[s].negatives_above == sum(1 - x for t, x in data if t > s)
    assert evaluate(frame, "score", "label").first().auc == pytest.approx(auc(data))


def test_rows_without_score_or_label_and_empty_input(spark):
    frame = spark.createDataFrame([(0.9, 1), (0.1, 0), (None, 1), (0.5, None)], SCORED)
    assert {r.auc for r in evaluate(frame, "score", "label", 2).collect()} == {1.0}
    assert evaluate(frame.limit(0), "score", "label").count() == 0


# ---- payloads ---------------------------------------------------------------------------------

PAYLOADS = [
    '{"a":1,"b":"x"}',
    '{"a":2.5,"b":"y","c":{"d":[1]}}',
    '{"a":3,"b":null,"B":"other"}',
    '{"a":"text","b":"z","long":123456789012345678901234567890}',
    "{}",
    "[1]",
    "broken",
    None,
    '{"b":"{\\"q\\":1}","new":true}',
]


def frame(spark, payloads=PAYLOADS):
    return spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "id int, payload string")


def test_keys_and_kinds(spark):
    found = {(r.key, r.kind): r.rows for r in discover(frame(spark), "payload").collect()}
    assert found == {
        ("a", "BIGINT"): 2,
        ("a", "DECIMAL"): 1,
        ("a", "STRING"): 1,
        ("b", "STRING"): 4,
        ("b", "VOID"): 1,
        ("B", "STRING"): 1,
        ("c", "OBJECT"): 1,
        ("long", "DECIMAL"): 1,
        ("new", "BOOLEAN"): 1,
    }
    assert "c: OBJECT<d: ARRAY<BIGINT>>" in whole_schema(frame(spark).filter("id in (0, 1)"), "payload")


def test_nothing_is_lost_between_columns_and_rest(spark):
    rows_of = frame(spark)
    columns = choose_columns(discover(rows_of, "payload"), 9, share=0.0)
    assert {(c.key, c.type) for c in columns} == {("b", "string"), ("long", "double"), ("new", "boolean")}
    typed = typed_payload(rows_of, "payload", columns, prefix="p_").orderBy("id").collect()
    assert [r.p_b for r in typed] == ["x", "y", None, "z", None, None, None, None, '{"q":1}']
    assert [r.payload_rest for r in typed] == [
        '{"a":1}',
        '{"a":2.5,"c":{"d":[1]}}',
        '{"a":3,"b":null,"B":"other"}',
        '{"a":"text","long":123456789012345678901234567890}',
        None,
        "[1]",
        "broken",
        None,
        None,
    ]
    assert typed[8].p_new is True and typed[3].p_long is None  # a double would lose digits


def test_a_new_key_adds_a_column(spark):
    old = frame(spark, ['{"a":1}'] * 3)
    new = frame(spark, ['{"a":1,"n":2}'] * 3)
    assert [c.key for c in choose_columns(discover(old, "payload"), 3)] == ["a"]
    columns = choose_columns(discover(new, "payload"), 3)
    assert [(c.key, c.type) for c in columns] == [("a", "bigint"), ("n", "bigint")]
    both = typed_payload(old.unionByName(new), "payload", columns)
    assert rows(both.select("a", "n", "payload_rest").distinct()) == [(1, None, None), (1, 2, None)]


def test_numbers_of_two_kinds_make_a_double_and_names_that_are_taken_are_refused(spark):
    some = frame(spark, ['{"a":1}', '{"a":2.5}', '{"a":"3"}'])
    columns = choose_columns(discover(some.filter("id < 2"), "payload"), 2)
    assert [(c.key, c.type) for c in columns] == [("a", "double")]
    typed = typed_payload(some, "payload", columns).orderBy("id").collect()
    assert [(r.a, r.payload_rest) for r in typed] == [(1.0, None), (2.5, None), (None, '{"a":"3"}')]
    with pytest.raises(ValueError):
        typed_payload(some.withColumn("A", F.lit(1)), "payload", columns)


def test_a_frequent_key_is_counted_in_map_tasks(spark):
    plan = discover(frame(spark), "payload")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Python" not in plan


def test_a_trained_model_ranks_planted_churners_first(spark):
    from eventide.operators.scoring import FEATURES, train_churn

    rng = random.Random(4)
    data = []
    for i in range(400):
        churned = int(rng.random() < 0.3)
        active = rng.randint(1, 6) if churned else rng.randint(4, 25)
        data.append((f"u{i}", active * 3, active, active // 2, active * 10.0, rng.randint(0, 900), i % 2, churned))
    schema = "user_id string, " + ", ".join(
        f"{c} {'double' if c == 'spend_usd' else 'long'}" for c in FEATURES
    ) + ", label int"
    features = spark.createDataFrame(data, schema)
    model = train_churn(features)
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(features).withColumn("p", vector_to_array("_probability")[1])
    rows_of = [(r.p, r.label) for r in scored.select("p", "label").collect()]
    found = evaluate(scored, "p", "label").collect()
    assert found[0].auc == pytest.approx(auc(rows_of)) and found[0].auc > 0.95
    assert max(r.lift for r in found) == next(r.lift for r in found if r.bucket == 1) > 2.5
