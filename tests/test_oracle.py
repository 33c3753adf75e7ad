"""Every registered query against its SQL, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from eventide.catalogue import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import SMALL

# One query has no SQL: it trains a model.
WITHOUT_SQL = {"churn_scores"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_but_the_model_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert step not in plan
    assert differences(df, con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_scores_are_probabilities_for_every_fact_row(spark):
    scores = QUERIES["churn_scores"](spark, SMALL).collect()
    assert len(scores) == 1000
    assert all(abs(r.churn_probability + r.stay_probability - 1) < 1e-9 for r in scores)
    assert {r.predicted_label for r in scores} <= {0, 1}
