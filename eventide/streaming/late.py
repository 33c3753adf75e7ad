"""Late events of a stream: written beside it instead of dropped, and brought into the days they belong to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.constants import LOOKBACK_DAYS
from eventide.operators.merge import touched_partitions
from eventide.sources.lake import read_table, replace_days
from eventide.storage import list_folders, materialize, remove_path, scratch_path, table_exists

LIMITS = "before timestamp, through timestamp, batch long"
ON_TIME, LATE = "on_time", "late"


def _limit_before(spark: SparkSession, path: str, batch_id: int) -> dt.datetime | None:
    """The latest event time that batches before this one have seen."""
    if not table_exists(spark, path):
        return None
    rows = read_table(spark, path, LIMITS).collect()  # those of the last two batches at most
    own = [r.before for r in rows if r.batch == batch_id]  # this batch has been run before
    return own[0] if own else max((r.through for r in rows if r.through), default=None)


def route_late(
    events: DataFrame, folder: str, checkpoint: str, delay_days: int = LOOKBACK_DAYS
) -> StreamingQuery:
    """Write each batch's events to `folder`: on_time, or late if more than `delay_days` behind.

    An event is measured against the latest event time of all batches before its own, the limit that Spark's
    watermark has in this batch. Events without a time can't be placed and count as late, on the NULL day. Both tables
    are partitioned by event_date and batch; a batch that is run again replaces its own rows, with the same limit. Limits
    older than the last batch are removed.
    """
    limits = f"{folder}/limits"

    def split(batch: DataFrame, batch_id: int) -> None:
        spark, copy = batch.sparkSession, scratch_path(batch.sparkSession, "stream-batch")
        at = F.col("event_timestamp").cast("timestamp")
        taken = materialize(batch.withColumn("event_timestamp", at), "stream-batch", copy)
        before = _limit_before(spark, limits, batch_id)
        newest = taken.agg(F.max("event_timestamp")).first()[0]
        seen = [t for t in (before, newest) if t is not None]
        late = F.col("event_timestamp").isNull()
        if before is not None:
            late = late | (F.col("event_timestamp") < F.lit(before - dt.timedelta(days=delay_days)))
        # NULL compares to neither; a missing time is late.
        rows = taken.withColumns({"_late": F.coalesce(late, F.lit(True)), "event_date": F.to_date("event_timestamp")})
        for name, wanted in ((ON_TIME, ~F.col("_late")), (LATE, F.col("_late"))):
            own = rows.filter(wanted).drop("_late").withColumn("batch", F.lit(batch_id).cast("long"))
            own = own.hint("rebalance", F.col("event_date")).write.mode("overwrite")
            own = own.option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch")
            own.parquet(f"{folder}/{name}")
        state = spark.createDataFrame([(before, max(seen, default=None))], "before timestamp, through timestamp")
        state.coalesce(1).write.mode("overwrite").parquet(f"{limits}/batch={batch_id}")
        for name in list_folders(spark, limits):
            if name.startswith("batch=") and int(name[6:]) < batch_id - 1:
                remove_path(spark, f"{limits}/{name}")
        remove_path(spark, copy)

    sink = events.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return sink.trigger(availableNow=True).start()


def read_routed(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """One of the two tables, with event_date and batch; empty if nothing has been written."""
    whole = f"{schema}, event_date date, batch long"
    path = f"{folder}/{name}"
    return read_table(spark, path, whole) if table_exists(spark, path) else spark.createDataFrame([], whole)


def settle_days(spark: SparkSession, folder: str, totals_path: str, schema: str, since_batch: int = 0) -> DataFrame:
    """Bring daily totals up to date with the late events of all batches from one on.

    The days of those events, and no others, are counted anew from on-time and late rows, so that running it again
    gives the same. Totals have event_date, row_count and late_count. Events without a time belong to no day.
    """
    on_time, late = (read_routed(spark, folder, n, schema) for n in (ON_TIME, LATE))
    named = F.col("event_date").isNotNull()
    moved = materialize(late.filter(named & (F.col("batch") >= since_batch)).select("event_date").distinct(), "late-days")
    own, days = touched_partitions(on_time, moved, "event_date")
    other, _ = touched_partitions(late, moved, "event_date")
    rows = own.select("event_date", F.lit(0).alias("late")).unionByName(other.select("event_date", F.lit(1).alias("late")))
    totals = rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"), F.sum("late").alias("late_count"))
    totals = materialize(totals, "late-totals")
    if not days == []:
        replace_days(totals, totals_path, "event_date")
    return totals


def daily_totals(spark: SparkSession, folder: str, totals_path: str, schema: str) -> None:
    """Totals of all days from the on-time events alone, as the stream by itself would have them."""
    counts = read_routed(spark, folder, ON_TIME, schema).groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))
    counts = counts.withColumn("late_count", F.lit(0).cast("long"))
    counts.write.mode("overwrite").partitionBy("event_date").parquet(totals_path)
