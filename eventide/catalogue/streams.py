"""Streaming queries: events land as files, a stream drains them into a table, the table is read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.catalogue import roles
from eventide.catalogue.registry import query
from eventide.functions import json_scalar, parse_payload
from eventide.schemas import STREAM_EVENTS_SCHEMA
from eventide.sources.lake import read_table
from eventide.storage import materialize, scratch_path
from eventide.streaming.ingest import (
    append_files,
    daily_counts,
    drain,
    latest_rows,
    read_batches,
    read_files,
    upsert_batches,
    without_personal_data,
    without_replays,
)
from eventide.streaming.late import daily_totals, read_routed, route_late, settle_days


_STREAM = "event_id string, event_timestamp timestamp, user_id string, event_type string, payload string"


def _batch_time(batch: int) -> dt.datetime:
    return dt.datetime(2024, 2, 1) + dt.timedelta(hours=batch)


def _landed(spark: SparkSession, sf_dir: str, replay: bool) -> str:
    """Events as JSON files in a landing folder; with a replay, the purchases landed a second time."""
    path = scratch_path(spark, "landing")
    events = roles.raw_events(spark, sf_dir)
    columns = STREAM_EVENTS_SCHEMA.names
    events.select(*columns).write.json(path, timestampFormat=roles.JSON_TIME)
    if replay:
        events.filter(F.col("kind") == "purchase").select(*columns).write.mode("append").json(path, timestampFormat=roles.JSON_TIME)
    return path


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT event_id, event_timestamp, user_id, event_type, session_id, country_code FROM raw"""
)
def stream_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with replays, appended once each."""
    table = scratch_path(spark, "streamed")
    events = without_replays(read_files(spark, _landed(spark, sf_dir, replay=True)))
    drain(append_files(events, table, f"{table}-checkpoint"))
    stored = read_table(spark, table, STREAM_EVENTS_SCHEMA)
    keys = ["session_id", "country_code"]
    parsed = stored.withColumn("_parsed", parse_payload("payload", keys))
    return parsed.select(
        "event_id",
        "event_timestamp",
        "user_id",
        "event_type",
        *[json_scalar("_parsed", "payload", k).alias(k) for k in keys],
    )


@query(f"WITH {roles.RAW_SQL} SELECT event_id, event_timestamp, user_id, event_type FROM raw")
def stream_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with replays, merged on their id batch by batch, one file per batch."""
    log = scratch_path(spark, "stream-log")
    events = read_files(spark, _landed(spark, sf_dir, replay=True), files_per_batch=1)
    order = [F.desc("event_timestamp")]
    drain(upsert_batches(events, log, f"{log}-checkpoint", ["event_id"], order, _batch_time))
    latest = latest_rows(read_batches(spark, log, _STREAM), ["event_id"])
    return latest.select("event_id", "event_timestamp", "user_id", "event_type")


@query(f"WITH {roles.RAW_SQL} SELECT event_id, event_timestamp, user_id, event_type FROM raw")
def stream_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, each of half of the event ids, into one table: neither replaces the other's rows."""
    log = scratch_path(spark, "shared-log")
    landed = _landed(spark, sf_dir, replay=True)
    for name, odd in (("even", 0), ("odd", 1)):
        events = read_files(spark, landed).filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == odd)
        order = [F.desc("event_timestamp")]
        drain(upsert_batches(events, log, f"{log}-{name}", ["event_id"], order, _batch_time))
    latest = latest_rows(read_batches(spark, log, _STREAM), ["event_id"])
    return latest.select("event_id", "event_timestamp", "user_id", "event_type")


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS row_count,
      count(*) FILTER (user_id IS NULL) AS null_users
    FROM raw GROUP BY 1"""
)
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per day, each batch writing the days it changed; the newest count of a day holds."""
    log = scratch_path(spark, "count-log")
    counts = daily_counts(read_files(spark, _landed(spark, sf_dir, replay=False)))
    drain(
        upsert_batches(
            counts,
            log,
            f"{log}-checkpoint",
            ["event_date"],
            [F.desc("row_count")],
            _batch_time,
            output_mode="update",
        )
    )
    stored = read_batches(spark, log, "event_date date, row_count long, null_users long")
    return latest_rows(stored, ["event_date"]).select("event_date", "row_count", "null_users")


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT event_id, sha256(user_id) AS user_id_hash, event_type,
      '{{' || concat_ws(',', '"referrer":"' || referrer || '"',
        '"device_type":"' || device_type || '"', '"country_code":"' || country_code || '"') || '}}' AS payload
    FROM raw"""
)
def stream_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users hashed and addresses dropped before anything is written."""
    table = scratch_path(spark, "streamed-clean")
    events = without_personal_data(
        read_files(spark, _landed(spark, sf_dir, replay=False)),
        hashed=["user_id"],
        dropped=["event_timestamp"],
        denied=["session_id", "page_url"],
    )
    drain(append_files(events, table, f"{table}-checkpoint"))
    return read_table(spark, table, "event_id string, event_type string, payload string, user_id_hash string")


#: Landings of the late stream: all events of some days, but errors arrive with the third landing and sign-ups with the
#: last. Against the limit of the landing before, those of the last three days are in time.
_LANDINGS = """landed AS (
  SELECT event_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date, CASE
      WHEN kind = 'error' THEN greatest(3, CAST(ceil(day(event_timestamp) / 6) AS INTEGER))
      WHEN kind = 'signup' THEN 5 ELSE CAST(ceil(day(event_timestamp) / 6) AS INTEGER) END AS landing
  FROM raw
), limits AS (
  SELECT landing, max(max(event_timestamp)) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 3 DAY AS low FROM landed GROUP BY landing
), routed AS (
  SELECT l.*, coalesce(event_timestamp < low, FALSE) AS late FROM landed l JOIN limits USING (landing)
)"""


def _late_stream(spark: SparkSession, sf_dir: str) -> str:
    """Five landings, each a run of the stream that takes what has landed as one batch."""
    folder, landing = scratch_path(spark, "late-stream"), scratch_path(spark, "landing")
    kind, usual = F.col("kind"), F.ceil(F.dayofmonth("event_timestamp") / 6)
    number = F.when(kind == "error", F.greatest(F.lit(3), usual)).when(kind == "signup", 5).otherwise(usual)
    events = materialize(roles.raw_events(spark, sf_dir).withColumn("landing", number), "landings")
    for n in range(1, 6):
        own = events.filter(F.col("landing") == n).select(*STREAM_EVENTS_SCHEMA.names)
        own.write.mode("append").json(landing, timestampFormat=roles.JSON_TIME)
        drain(route_late(read_files(spark, landing), folder, f"{folder}-checkpoint"))
    return folder


@query(f"WITH {roles.RAW_SQL}, {_LANDINGS} SELECT event_id, event_timestamp, late FROM routed")
def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is in one of two tables: on time, or late and beside the stream."""
    folder = _late_stream(spark, sf_dir)
    both = [
        read_routed(spark, folder, name, _STREAM).select("event_id", "event_timestamp", F.lit(late).alias("late"))
        for name, late in (("on_time", False), ("late", True))
    ]
    return both[0].unionByName(both[1])


@query(
    f"""WITH {roles.RAW_SQL}, {_LANDINGS}
    SELECT event_date, count(*) AS row_count, count(*) FILTER (late) AS late_count FROM routed GROUP BY 1"""
)
def stream_settled_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the stream, then corrected for the days of late events."""
    folder, totals = _late_stream(spark, sf_dir), scratch_path(spark, "totals")
    daily_totals(spark, folder, totals, _STREAM)
    settle_days(spark, folder, totals, _STREAM)
    return read_table(spark, totals, "row_count long, late_count long, event_date date")
