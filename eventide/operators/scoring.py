"""Churn: user features from the fact table, training, and scoring of a day's fact rows."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.context import RunContext
from eventide.functions import no_salt, salt_where_null
from eventide.storage import scratch_path

log = logging.getLogger(__name__)

FEATURES = ["event_count", "active_days", "purchase_count", "spend_usd", "tenure_days", "premium"]


def user_features(facts: DataFrame, churned_before: dt.date | None = None) -> DataFrame:
    """One row per known user. With a day, the features are of earlier days only, and `label` is 1 when the
    user has no event from that day on; a user without earlier events has no row.

    Spend sums each day's amount once, though every event of the day carries it.
    """
    per_day = (
        facts.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "event_date")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
            F.max("transaction_amount_usd").alias("spend"),
            F.max("customer_tenure_days").alias("tenure"),
            F.max(F.col("is_premium_subscriber").cast("int")).alias("premium"),
        )
    )
    zero, past = F.lit(0), per_day
    if churned_before is not None:
        cut = F.lit(churned_before.isoformat()).cast("date")
        past = per_day.filter(F.col("event_date") < cut)
    features = past.groupBy("user_id").agg(
        F.sum("events").alias("event_count"),
        F.count(F.lit(1)).alias("active_days"),
        F.sum("purchases").alias("purchase_count"),
        F.coalesce(F.sum("spend").cast("double"), F.lit(0.0)).alias("spend_usd"),
        F.coalesce(F.max("tenure"), zero).cast("long").alias("tenure_days"),
        F.coalesce(F.max("premium"), zero).cast("long").alias("premium"),
        F.max("event_date").alias("last_event_date"),
    )
    if churned_before is None:
        return features
    came_back = per_day.filter(F.col("event_date") >= cut).select("user_id").distinct()
    labels = features.join(came_back.withColumn("_back", F.lit(True)), "user_id", "left")
    return labels.withColumn("label", F.col("_back").isNull().cast("int")).drop("_back")


def train_churn(features: DataFrame, path: str | None = None, max_iter: int = 100) -> PipelineModel:
    """Fit a logistic regression; Spark ML sums the gradients over the partitions.

    The model is stored and read back: scoring on other days needs it, and the stored model does not
    carry the training session into every scoring task.
    """
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features"),
        LogisticRegression(maxIter=max_iter, predictionCol="predicted_label", probabilityCol="_probability"),
    ]
    path = path or scratch_path(features.sparkSession, "churn-model")
    fitted = Pipeline(stages=stages).fit(features)
    taken = fitted.stages[-1].summary.totalIterations
    if taken >= max_iter:
        log.warning("churn model stopped after %d iterations without converging", taken)
    fitted.write().overwrite().save(path)
    return PipelineModel.load(path)


def fixed_churn(weights: dict[str, float], intercept: float) -> PipelineModel:
    """A logistic model of given weights per feature, as a pipeline that `score` takes."""
    terms = [f"{weight!r} * CAST({name} AS DOUBLE)" for name, weight in weights.items()]
    churn = f"1 / (1 + exp(-({' + '.join([*terms, repr(intercept)])})))"
    return PipelineModel(
        [
            SQLTransformer(statement=f"SELECT *, {churn} AS _churn FROM __THIS__"),
            SQLTransformer(
                statement="SELECT *, 1 - _churn AS _stay, CAST(_churn > 0.5 AS DOUBLE) AS predicted_label FROM __THIS__"
            ),
            VectorAssembler(inputCols=["_stay", "_churn"], outputCol="_probability"),
        ]
    )


def score(rows: DataFrame, features: DataFrame, model: PipelineModel, ctx: RunContext) -> DataFrame:
    """One prediction per fact row. Rows without a known user are scored on zero features."""
    zeros = {c: 0 for c in FEATURES}
    salted = rows.select("event_id", "user_id", "event_date").withColumn(
        "_salt", salt_where_null(["user_id"], ["event_id"])
    )
    known = features.select("user_id", *FEATURES).withColumn("_salt", no_salt(["user_id"]))
    inputs = salted.join(known, ["user_id", "_salt"], "left").fillna(zeros, FEATURES)
    p = vector_to_array(F.col("_probability"))
    return model.transform(inputs).select(
        "user_id",
        "event_date",
        F.col("predicted_label").cast("int").alias("predicted_label"),
        F.array(
            F.struct(F.lit(1).alias("label"), p[1].alias("prob")),
            F.struct(F.lit(0).alias("label"), p[0].alias("prob")),
        ).alias("predicted_label_probs"),
        ctx.now_col.alias("scored_at"),
    )
