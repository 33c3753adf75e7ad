"""Events as a stream: reading, hashing personal data, dropping replays, writing exactly once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventide.constants import LOOKBACK_DAYS
from eventide.context import utc_literal
from eventide.functions import any_null
from eventide.operators.keyed import first_per_key
from eventide.operators.privacy import pseudonymize, redact_payload
from eventide.schemas import STREAM_EVENTS_SCHEMA
from eventide.sources.lake import read_table
from eventide.storage import materialize, remove_path, scratch_path


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str = STREAM_EVENTS_SCHEMA,
    file_format: str = "json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files landing in a folder."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """JSON messages of a Kafka topic (needs Spark's Kafka package on the cluster)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    messages = raw.option("subscribe", topic).load()
    event = F.from_json(F.col("value").cast("string"), STREAM_EVENTS_SCHEMA)
    return messages.select(event.alias("event")).select("event.*")


def without_personal_data(
    events: DataFrame, hashed: Sequence[str] = (), dropped: Sequence[str] = (), denied: Sequence[str] = ()
) -> DataFrame:
    """Hash columns, drop columns and drop payload keys before anything is written."""
    events = pseudonymize(events, hashed) if hashed else events
    events = events.drop(*dropped)
    return redact_payload(events, "payload", denied) if denied else events


def _first_copies(columns: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep the first of the rows of a batch that agree in some columns."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = pa.array(np.arange(batch.num_rows))
            keys = pa.table([batch.column(c) for c in columns] + [numbers], [*columns, "_row"])
            first = keys.group_by(list(columns)).aggregate([("_row", "min")])["_row_min"].combine_chunks()
            yield batch.take(first.take(pc.sort_indices(first)))

    return cut


def without_replays(
    events: DataFrame, delay: str = f"{LOOKBACK_DAYS} days", ids: Sequence[str] = ("event_id",)
) -> DataFrame:
    """Drop events later than `delay`, and copies of an id that arrive within it.

    Spark's streaming deduplication sends all copies of an id to one task. Each task therefore first drops
    copies of equal id and time from its batches, so that few copies of an often repeated event travel.
    """
    at = F.col("event_timestamp").cast("timestamp")  # a watermark needs a zoned timestamp
    timed = events.withColumn("event_timestamp", at)
    return (
        timed.mapInArrow(_first_copies([*ids, "event_timestamp"]), timed.schema)
        .withWatermark("event_timestamp", delay)
        .dropDuplicatesWithinWatermark(list(ids))
    )


def append_files(events: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> StreamingQuery:
    """Write a stream to Parquet. Checkpoint and file sink together write every row exactly once."""
    writer = events.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(availableNow=True).start(path)


WRITER, BATCH, COMMITTED = "_writer", "_batch", "_commit_ts"


def upsert_batches(
    events: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[Column],
    clock: Callable[[int], dt.datetime],
    output_mode: str = "append",
) -> StreamingQuery:
    """Write each batch's rows, one per key, to a table partitioned by writer and batch; see `latest_rows`.

    The writer is the query's own id, which is kept in its checkpoint. A batch that is run again therefore replaces its
    own rows and no others, and a stream that has lost its checkpoint, or another stream, writes beside them, so any
    number of streams can feed one table at the same time. A batch is written down before it is used twice, since
    computing it again would run the stream's state again.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        copy = scratch_path(spark, "batch")
        taken = materialize(batch, "batch", copy)
        complete = first_per_key(taken.filter(~any_null(keys)), keys, order_by)
        rows = complete.unionByName(taken.filter(any_null(keys)))
        rows = rows.withColumns({COMMITTED: utc_literal(clock(batch_id)), WRITER: F.lit(writer), BATCH: F.lit(batch_id)})
        sink = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        sink.partitionBy(WRITER, BATCH).parquet(path)
        remove_path(spark, copy)

    sink = events.writeStream.foreachBatch(commit).outputMode(output_mode)
    return sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All rows that streams have written to a table, with their writer, batch and commit time."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is not None:
        own = [T.StructField(COMMITTED, T.TimestampType()), T.StructField(WRITER, T.StringType())]
        schema = T.StructType([*schema, *own, T.StructField(BATCH, T.LongType())])
    return read_table(spark, path, schema).withColumn(BATCH, F.col(BATCH).cast("long"))


def latest_rows(batches: DataFrame, keys: Sequence[str], until: dt.datetime | None = None) -> DataFrame:
    """The newest row of each key, by commit time, then batch, then writer; as of a moment if one is given.

    Rows with a NULL in their key never replace each other.
    """
    if until is not None:
        batches = batches.filter(F.col(COMMITTED) <= utc_literal(until))
    order = [F.desc(COMMITTED), F.desc(BATCH), F.desc(WRITER)]
    newest = first_per_key(batches.filter(~any_null(keys)), keys, order)
    return newest.unionByName(batches.filter(any_null(keys))).drop(COMMITTED, WRITER, BATCH)


def daily_counts(events: DataFrame, delay: str = f"{LOOKBACK_DAYS} days") -> DataFrame:
    """Events per day and how many of them lack a user, kept open for late events."""
    at = F.col("event_timestamp").cast("timestamp")
    days = (
        events.withColumn("event_timestamp", at)
        .withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", "1 day"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("user_id").isNull()).alias("null_users"))
    )
    return days.select(F.to_date("window.start").alias("event_date"), "row_count", "null_users")


def drain(*queries: StreamingQuery) -> None:
    """Wait until queries started with `availableNow` have taken everything there is."""
    for query in queries:
        query.awaitTermination()
