"""Queries on user features and churn scores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.catalogue import roles
from eventide.catalogue.activity import facts
from eventide.catalogue.registry import query
from eventide.operators.ranking import evaluate
from eventide.operators.scoring import fixed_churn, score, train_churn, user_features
from eventide.storage import materialize

CHURNED_BEFORE = dt.date(2024, 1, 30)


WEIGHTS = {
    "event_count": -0.05,
    "active_days": -0.2,
    "purchase_count": -0.1,
    "spend_usd": -0.000001,
    "tenure_days": 0.0005,
    "premium": -0.4,
}
INTERCEPT = 1.5

_FEATURES_SQL = f"""{roles.facts_sql()}, days AS (
      SELECT user_id, event_date, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
        max(transaction_amount_usd) AS spend, max(customer_tenure_days) AS tenure,
        max(CAST(is_premium_subscriber AS INTEGER)) AS premium
      FROM facts WHERE user_id IS NOT NULL GROUP BY 1, 2
    ), features AS (
      SELECT user_id, CAST(sum(events) AS BIGINT) AS event_count, count(*) AS active_days,
        CAST(sum(purchases) AS BIGINT) AS purchase_count,
        coalesce(CAST(sum(CAST(spend AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS spend_usd,
        coalesce(max(tenure), 0) AS tenure_days, CAST(coalesce(max(premium), 0) AS BIGINT) AS premium,
        max(event_date) AS last_event_date
      FROM days WHERE event_date < DATE '{CHURNED_BEFORE}' GROUP BY user_id
    )"""


@query(
    f"""WITH {_FEATURES_SQL}
    SELECT *, CAST(user_id NOT IN (SELECT user_id FROM days WHERE event_date >= DATE '{CHURNED_BEFORE}') AS INTEGER)
      AS label
    FROM features"""
)
def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_features(facts(spark, sf_dir), CHURNED_BEFORE)


@query(
    f"""WITH {_FEATURES_SQL}, scored AS (
      SELECT f.user_id, f.event_date,
        1 / (1 + exp(-({" + ".join(f"{w!r} * coalesce({c}, 0)" for c, w in WEIGHTS.items())} + {INTERCEPT!r}))) AS p
      FROM facts f LEFT JOIN features u ON u.user_id = f.user_id
    )
    SELECT user_id, event_date, CAST(p > 0.5 AS INTEGER) AS predicted_label,
      round(p, 6) AS churn_probability, round(1 - p, 6) AS stay_probability FROM scored"""
)
def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact row scored by a model of given weights."""
    rows = materialize(facts(spark, sf_dir), "facts")
    features = user_features(rows, CHURNED_BEFORE)
    predictions = score(rows, features, fixed_churn(WEIGHTS, INTERCEPT), roles.CTX)
    probs = F.col("predicted_label_probs")
    return predictions.select(
        "user_id",
        "event_date",
        "predicted_label",
        F.round(probs[0]["prob"], 6).alias("churn_probability"),
        F.round(probs[1]["prob"], 6).alias("stay_probability"),
    )


@query()
def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact row scored by a model trained on all users; no SQL, since SQL cannot train it."""
    rows = materialize(facts(spark, sf_dir), "facts")
    features = materialize(user_features(rows, CHURNED_BEFORE), "features")
    predictions = score(rows, features, train_churn(features), roles.CTX)
    probs = F.col("predicted_label_probs")
    return predictions.select(
        "user_id",
        "event_date",
        "predicted_label",
        probs[0]["prob"].alias("churn_probability"),
        probs[1]["prob"].alias("stay_probability"),
        "scored_at",
    )


@query(
    f"""WITH {_FEATURES_SQL}, scored AS (
      SELECT round(1 / (1 + exp(-({" + ".join(f"{w!r} * {c}" for c, w in WEIGHTS.items())} + {INTERCEPT!r}))), 6) AS score,
        user_id NOT IN (SELECT user_id FROM days WHERE event_date >= DATE '{CHURNED_BEFORE}') AS churned
      FROM features
    ), counted AS (
      SELECT score, count(*) FILTER (churned) AS p, count(*) FILTER (NOT churned) AS n FROM scored GROUP BY score
    ), ranked AS (
      SELECT *, p + n AS here, coalesce(sum(p + n) OVER w, 0) AS above, coalesce(sum(n) OVER w, 0) AS n_above
      FROM counted WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), totals AS (SELECT sum(p) AS all_p, sum(n) AS all_n, sum(p * (n_above + n / 2)) AS beaten FROM ranked),
    parts AS (
      SELECT b, p / here AS share,
        greatest(0, least(above + here, (b + 1) * (all_p + all_n) / 10) - greatest(above, b * (all_p + all_n) / 10)) AS part
      FROM ranked, totals, (SELECT unnest(range(10)) AS b)
    )
    SELECT CAST(b + 1 AS INTEGER) AS bucket, round(sum(part), 6) AS rows, round(sum(part * share), 6) AS positives,
      round(sum(part * share) / sum(part) / (any_value(all_p) / any_value(all_p + all_n)), 6) AS lift,
      round(any_value(1 - beaten / (all_p * all_n)), 6) AS auc
    FROM parts, totals GROUP BY b"""
)
def churn_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC and lift of the model of given weights: features before the cut, labels after it."""
    features = materialize(user_features(facts(spark, sf_dir), CHURNED_BEFORE), "features")
    churn = fixed_churn(WEIGHTS, INTERCEPT).transform(features).withColumn("_churn", F.round("_churn", 6))
    found = evaluate(churn, "_churn", "label")
    return found.select("bucket", *[F.round(c, 6).alias(c) for c in ("rows", "positives", "lift", "auc")])
