"""Exact ranks of scored rows over all tasks, and what they say about a model: AUC and lift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.keyed import small_side
from eventide.storage import materialize


def running_sums(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Add, for each column, `<name>_above`: its sum over all rows with a larger value of `order`.

    `order` has distinct values. Rows are cut into ranges of it, each range adds up for itself, and takes what the
    ranges above it hold in all; no task sees more than its range.
    """
    ranged = df.repartitionByRange(F.desc(order)).withColumn("_slice", F.spark_partition_id())
    rows = materialize(ranged, "ranked")
    slices = rows.groupBy("_slice").agg(*[F.sum(c).alias(c) for c in columns])
    above = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    slices = slices.select("_slice", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"_{c}") for c in columns])
    inside = Window.partitionBy("_slice").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({f"{c}_above": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in columns})
    joined = local.join(small_side(materialize(slices, "rank-offsets")), "_slice")
    total = {f"{c}_above": F.col(f"{c}_above") + F.col(f"_{c}") for c in columns}
    return joined.withColumns(total).drop("_slice", *[f"_{c}" for c in columns])


def by_score(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score with its positive and negative rows, and those of all larger scores.

    Rows without score or label are left out. Equal scores are one row, so that a frequent one is no hot key.
    """
    known = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    )
    return running_sums(counts, "score", ["positives", "negatives"])


def evaluate(scored: DataFrame, score: str, label: str, buckets: int = 10) -> DataFrame:
    """Lift by buckets of equal numbers of rows, the best scores first, with the AUC of all rows.

    Columns: bucket (from 1), rows, positives, lift (the share of positives in the bucket against that of all),
    auc. Rows of one score that a bucket's edge cuts count in both buckets by their part, with their average label, so that
    the result does not depend on an order among equals. The AUC counts ties by half; it is NULL, as is the lift, where
    a label is missing altogether.
    """
    ranks = materialize(by_score(scored, score, label), "score-ranks")
    positives, negatives = F.sum("positives"), F.sum("negatives")
    below = F.col("negatives_above") + F.col("negatives") / 2
    totals = ranks.agg(
        positives.alias("p"), negatives.alias("n"), F.sum(F.col("positives") * below).alias("beaten")
    ).first()
    p, n = totals.p or 0, totals.n or 0
    rows = p + n
    auc = F.lit(1 - float(totals.beaten) / (p * n) if p and n else None).cast("double")
    here, above = F.col("positives") + F.col("negatives"), F.col("positives_above") + F.col("negatives_above")
    size = rows / buckets if rows else 1.0
    # Ranks of one score lie from `above` to `above + here`; the buckets they reach are one after the other.
    first = F.floor(above / size)
    last = F.least(F.lit(buckets - 1), F.ceil((above + here) / size) - 1)
    each = ranks.select(
        F.explode(F.sequence(first, F.greatest(first, last))).alias("b"),
        above.alias("above"),
        here.alias("here"),
        (F.col("positives") / here).alias("share"),
    )
    inside = F.least(F.col("above") + F.col("here"), (F.col("b") + 1) * size) - F.greatest(F.col("above"), F.col("b") * size)
    found = each.withColumn("part", F.greatest(inside.cast("double"), F.lit(0.0))).groupBy("b").agg(
        F.sum("part").alias("rows"), F.sum(F.col("part") * F.col("share")).alias("positives")
    )
    base = p / rows if p else None
    lift = F.col("positives") / F.col("rows") / F.lit(base).cast("double")
    return found.filter("rows > 0").select(
        (F.col("b") + 1).cast("int").alias("bucket"), "rows", "positives", lift.alias("lift"), auc.alias("auc")
    )
