"""From raw lake and streamed events to one clean, deduplicated relation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.constants import DEFAULT_COUNTRY, DEFAULT_DEVICE, PAYLOAD_KEYS, STREAM_SOURCE
from eventide.context import RunContext
from eventide.functions import (
    hour_floor,
    in_days,
    json_scalar,
    parse_payload,
    url_origin,
    utc_day,
    whole_seconds_between,
)
from eventide.operators.keyed import first_per_key


def _unpacked(df: DataFrame, source: Column, ingested: str, day: Column) -> DataFrame:
    """The common shape of both sources, with the payload parsed once per row."""
    parsed = df.withColumn("_parsed", parse_payload("payload", PAYLOAD_KEYS))
    return parsed.select(
        "event_id",
        "event_timestamp",
        "user_id",
        "event_type",
        source.alias("source_system"),
        *[json_scalar("_parsed", "payload", k).alias(k) for k in PAYLOAD_KEYS],
        F.col(ingested).alias("_ingestion_timestamp"),
        day.alias("event_date"),
    )


def lake_events(raw: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Bronze events, pruned to day partitions when days are given."""
    if first and last:
        day = F.col("_partition_date")
        raw = raw.filter(
            day == F.lit(last.isoformat()).cast("date")
            if first == last
            else day.between(F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date"))
        )
    return _unpacked(raw, F.col("source_system"), "_ingestion_timestamp", F.col("_partition_date"))


def streamed_events(events: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Streamed events: their source has one name, and they count as ingested when they happened."""
    if first and last:
        events = events.filter(in_days("event_timestamp", first, last))
    return _unpacked(events, F.lit(STREAM_SOURCE), "event_timestamp", utc_day("event_timestamp"))


def union_sources(
    lake: DataFrame, stream: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    return lake_events(lake, first, last).unionByName(streamed_events(stream, first, last))


def earliest_copies(events: DataFrame) -> DataFrame:
    """One row per event id, the one that was ingested first.

    Rows without an id are left out before the shuffle (they would be dropped later, and all of them are
    one key); rows without a time may be the first copy and are judged afterwards.
    """
    return first_per_key(
        events.filter(F.col("event_id").isNotNull()),
        ["event_id"],
        [F.col("_ingestion_timestamp"), F.col("event_timestamp"), F.col("source_system")],
    )


def clean_columns(events: DataFrame, ctx: RunContext) -> DataFrame:
    """Business-ready columns of deduplicated events."""
    kept = events.filter(F.col("event_id").isNotNull() & F.col("event_timestamp").isNotNull())
    at = F.col("event_timestamp")
    return kept.select(
        "event_id",
        "event_timestamp",
        utc_day(at).alias("event_date"),
        whole_seconds_between(at, hour_floor(at)).alias("seconds_into_hour"),
        "user_id",
        "session_id",
        F.lower("event_type").alias("event_type"),
        F.lower("source_system").alias("source_system"),
        F.upper(F.coalesce("country_code", F.lit(DEFAULT_COUNTRY))).alias("country_code"),
        F.lower(F.coalesce("device_type", F.lit(DEFAULT_DEVICE))).alias("device_type"),
        url_origin("page_url").alias("page_domain"),
        "page_url",
        "referrer",
        "_ingestion_timestamp",
        ctx.now_col.alias("dbt_updated_at"),
        F.lit(ctx.invocation_id).alias("dbt_invocation_id"),
    )


def stage_events(
    lake: DataFrame,
    stream: DataFrame,
    ctx: RunContext,
    lookback_days: int | None = 0,
) -> DataFrame:
    """Staged events of the run day, of some days before it too, or of all days.

    With 0 days only the run day is read, so a copy of an event in another day's partition is not seen;
    3 days bring late events to the fact table; None is a full refresh.
    """
    first = last = None
    if lookback_days is not None:
        first, last = ctx.ds - dt.timedelta(days=lookback_days), ctx.ds
    return clean_columns(earliest_copies(union_sources(lake, stream, first, last)), ctx)
