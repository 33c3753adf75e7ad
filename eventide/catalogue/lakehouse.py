"""Queries on reads and writes, incremental loads, merges, versions, snapshots, schema and layout."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.catalogue import roles
from eventide.catalogue.registry import query
from eventide.operators.evolve import add_column, append_additive, sync_columns
from eventide.operators.history import append_commit, as_commit, read_as_of, read_log, vacuum
from eventide.operators.history import table_history as commit_history
from eventide.operators.layout import clustered, compact, z_ordered
from eventide.operators.merge import ambiguous_keys, merge_actions, merge_frames, upsert_table
from eventide.operators.merge import merge_metrics as action_counts
from eventide.operators.metrics import daily_user_metrics
from eventide.operators.snapshots import snapshot_history, snapshot_update
from eventide.operators.keyed import first_per_key
from eventide.plans.tables import VersionedTable
from eventide.schemas import EVENTS_SCHEMA
from eventide.sources.files import load_seed, register_table, take_landed
from eventide.sources.incremental import (
    extract_changes,
    ingest_day,
    latest_watermarks,
    lookup_watermark,
    read_control,
    typed_copy,
)
from eventide.sources.lake import append_bronze, read_table, replace_days, write_days
from eventide.storage import materialize, remove_path, scratch_path

# ---- reads and writes -------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' AND l_returnflag IN ('A', 'R')
      AND l_linestatus <> 'O' AND l_quantity > 10"""
)
def filtered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(
        spark,
        f"{sf_dir}/lineitem.parquet",
        filters=[
            ("l_shipdate", ">=", dt.datetime(1999, 1, 1)),
            ("l_returnflag", "in", ["A", "R"]),
            ("l_linestatus", "!=", "O"),
            ("l_quantity", ">", 10),
        ],
        columns=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
    )


@query(
    f"""WITH {roles.RAW_SQL}
    SELECT event_date, count(*) AS row_count, min(_ingestion_timestamp) AS first_ingested,
      max(_ingestion_timestamp) AS last_ingested, count(DISTINCT event_id) AS event_count
    FROM lake GROUP BY event_date"""
)
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append through the schema gate, then read the day-partitioned table back."""
    path = scratch_path(spark, "bronze")
    append_bronze(roles.lake(spark, sf_dir), path)
    return (
        read_table(spark, path, EVENTS_SCHEMA)
        .groupBy(F.col("_partition_date").alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("_ingestion_timestamp").alias("first_ingested"),
            F.max("_ingestion_timestamp").alias("last_ingested"),
            F.count_distinct("event_id").alias("event_count"),
        )
    )


@query(
    """SELECT CAST(ts AS DATE) AS event_date, count(*) AS row_count, count(DISTINCT event_id) AS event_count,
      min(scored) AS first_run, max(scored) AS last_run
    FROM (SELECT *, 1 AS scored FROM events UNION ALL SELECT *, 2 FROM events) GROUP BY 1"""
)
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of a query appended by two runs: rows of a run that is repeated are there twice."""
    path = scratch_path(spark, "appended")
    rows = roles.events(spark, sf_dir).select("event_id", F.to_date("ts").alias("event_date"))
    for run in (1, 2):
        write_days(rows.withColumn("run", F.lit(run)), path, "event_date", "append")
    stored = read_table(spark, path, "event_id long, run int, event_date date")
    return stored.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("event_id").alias("event_count"),
        F.min("run").alias("first_run"),
        F.max("run").alias("last_run"),
    )


@query(
    """SELECT CAST(ts AS DATE) AS event_date, event_id, event_type, value FROM events
    WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-13'
    UNION ALL
    SELECT CAST(ts AS DATE), event_id, event_type, value * 2 FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'
      AND event_type <> 'error' AND CAST(ts AS DATE) <> DATE '2024-01-11'"""
)
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all days, then replace three of them with recomputed rows; one of these comes out empty."""
    day = F.col("event_date")
    rows = roles.events(spark, sf_dir).select(
        F.to_date("ts").alias("event_date"), "event_id", "event_type", "value"
    )
    path, days = scratch_path(spark, "days"), ["2024-01-10", "2024-01-11", "2024-01-12"]
    replace_days(rows, path, "event_date", cluster_by=["event_type", "event_id"])
    again = rows.filter(day.isin(days) & (F.col("event_type") != "error") & (day != "2024-01-11"))
    replace_days(again.withColumn("value", F.col("value") * 2), path, "event_date", days)
    return read_table(spark, path, rows.schema)


@query(
    """SELECT event_type, count(*) AS row_count, max(ts) AS newest FROM events GROUP BY event_type"""
)
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Take landed JSON files into a table, twice; the second call finds nothing new."""
    raw, table = scratch_path(spark, "raw"), scratch_path(spark, "taken")
    roles.events(spark, sf_dir).write.json(raw, timestampFormat=roles.JSON_TIME)
    for _ in range(2):
        take_landed(spark, raw, table, f"{table}-checkpoint", roles.EVENTS, "json")
    taken = read_table(spark, table, roles.EVENTS)
    return taken.groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"), F.max("ts").alias("newest"))


@query(
    """SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS row_count, min(event_id) AS first_id
    FROM events GROUP BY 1, 2"""
)
def catalog_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register a partitioned folder, query it by name, and take the name out of the catalog again."""
    path = scratch_path(spark, "registered")
    rows = roles.events(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    rows.hint("rebalance", F.col("event_date")).write.partitionBy("event_date").parquet(path)
    name = "registered_" + path.rsplit("-", 1)[1]
    table = register_table(spark, name, path, rows.schema, "event_date")
    counted = table.groupBy("event_date", "event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("event_id").alias("first_id")
    )
    result = materialize(counted, "registered-counts")
    spark.sql(f"DROP TABLE {name}")
    return result


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def seed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "seed")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    roles.customer(spark, sf_dir).select(*columns).write.csv(path, header=True)
    return load_seed(spark, path, "c_custkey long, c_name string, c_mktsegment string")


@query(
    """SELECT event_id,
      CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,2))::DOUBLE END AS amount,
      event_type <> 'error' AS converted
    FROM events"""
)
def cast_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as text, some of them not numbers, to decimals; the others are kept aside."""
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    rows = roles.events(spark, sf_dir).select(F.col("event_id").cast("string"), text.alias("amount"))
    target = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2))]
    )
    good, bad = typed_copy(rows, target)
    return good.select("event_id", F.col("amount").cast("double"), F.lit(True).alias("converted")).unionByName(
        bad.select(
            F.col("event_id").cast("long"), F.lit(None).cast("double").alias("amount"), F.lit(False).alias("converted")
        )
    )


# ---- incremental loads ------------------------------------------------------------------------


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows as daily loads of each event type would have left them."""
    return (
        roles.events(spark, sf_dir)
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("rows_copied"))
        .select(
            F.lit("ingest_events").alias("pipeline_name"),
            F.col("event_type").alias("table_name"),
            F.col("day").cast("timestamp").alias("last_load_timestamp"),
            "rows_copied",
        )
    )


@query(
    """SELECT 'ingest_events' AS pipeline_name, event_type AS table_name,
      CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) AS watermark
    FROM events GROUP BY event_type"""
)
def watermark_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_watermarks(control(spark, sf_dir))


@query(
    """SELECT event_id, ts AS updated_at, event_type FROM events
    WHERE ts > (SELECT CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) FROM events
                WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-11')
      AND ts <= TIMESTAMP '2024-01-12 23:59:59'"""
)
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows changed since the load of the 10th, up to the end of the 12th."""
    until = F.col("last_load_timestamp") < F.lit("2024-01-11").cast("timestamp")
    watermark = lookup_watermark(control(spark, sf_dir).filter(until), "ingest_events", "view")
    changes = extract_changes(roles.events(spark, sf_dir), watermark, "2024-01-12", "ts")
    return changes.select("event_id", F.col("ts").alias("updated_at"), "event_type")


def _ingest(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Three runs of the incremental load, up to the 10th, the 20th, and the 20th again: table, control."""
    table, folder, state = (scratch_path(spark, n) for n in ("loaded", "landed", "control"))
    for day in ("2024-01-10", "2024-01-20", "2024-01-20"):
        ingest_day(
            spark,
            lambda: roles.events(spark, sf_dir),
            lambda rows: upsert_table(spark, table, rows, ["event_id"], newest_by="ts"),
            state,
            folder,
            "ingest_events",
            "events",
            day,
            column="ts",
        )
    return table, state


@query(
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS place FROM events
      WHERE ts <= TIMESTAMP '2024-01-20 23:59:59'
    ) WHERE place = 1"""
)
def ingest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _ingest(spark, sf_dir)
    return read_table(spark, table, roles.EVENTS)


def _run_sql(after: str, day: str) -> str:
    rows = f"ts > TIMESTAMP '{after}' AND ts <= TIMESTAMP '{day} 23:59:59'"
    return (
        f"SELECT 'ingest_events' AS pipeline_name, 'events' AS table_name, TIMESTAMP '{day}' AS "
        f"last_load_timestamp, count(*) AS rows_copied FROM events WHERE {rows}"
    )


@query(
    f"""{_run_sql("1900-01-01", "2024-01-10")}
    UNION ALL {_run_sql("2024-01-10", "2024-01-20")}
    UNION ALL {_run_sql("2024-01-20", "2024-01-20")}"""
)
def ingest_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control rows of these runs, with the rows each of them copied."""
    _, state = _ingest(spark, sf_dir)
    return read_control(spark, state)


# ---- merges -----------------------------------------------------------------------------------

_ORDERS_LOG = """target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
source AS (
  SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01'
),
closed AS (SELECT * REPLACE ('X' AS o_orderstatus) FROM orders WHERE o_orderstatus = 'F')"""


def _before_1999(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.orders(spark, sf_dir).filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))


def _from_1998(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.orders(spark, sf_dir).filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))
    return rows.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def _closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.orders(spark, sf_dir).filter(F.col("o_orderstatus") == "F")
    return rows.withColumn("o_orderstatus", F.lit("X"))


@query(
    f"""WITH {_ORDERS_LOG}
    SELECT * FROM source
    UNION ALL SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)"""
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_frames(_before_1999(spark, sf_dir), _from_1998(spark, sf_dir), ["o_orderkey"])


@query(
    f"""WITH {_ORDERS_LOG}
    SELECT count(*) FILTER (t.o_orderkey IS NULL) AS rows_inserted,
      count(*) FILTER (t.o_orderkey IS NOT NULL) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted
    FROM source s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey"""
)
def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_counts(
        merge_actions(_before_1999(spark, sf_dir), _from_1998(spark, sf_dir), ["o_orderkey"])
    )


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS source_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def merge_ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return ambiguous_keys(lines, ["l_orderkey", "l_linenumber"])


_METRICS = """SELECT CAST(event_timestamp AS DATE) AS event_date, user_id, kind AS event_type,
      count(*) AS event_count, count(DISTINCT session_id) AS session_count,
      min(event_timestamp) AS first_event_at, max(event_timestamp) AS last_event_at
    FROM raw WHERE {rows} GROUP BY 1, 2, 3"""


@query(
    f"""WITH {roles.RAW_SQL},
    target AS ({_METRICS.format(rows="event_timestamp < TIMESTAMP '2024-01-15 12:00:00'")}),
    source AS ({_METRICS.format(rows="event_timestamp >= TIMESTAMP '2024-01-12'")})
    SELECT * FROM source
    UNION ALL
    SELECT t.* FROM target t WHERE NOT EXISTS (
      SELECT 1 FROM source s
      WHERE s.event_date = t.event_date AND s.user_id = t.user_id AND s.event_type = t.event_type)"""
)
def merge_incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics as of noon of the 15th, then merged with those of the days from the 12th on.

    Metrics without a user have a NULL in their key, match nothing, and are added again.
    """
    raw = roles.raw_events(spark, sf_dir)
    tracked = F.when(F.col("kind") != "error", F.concat("user_id", F.lit("-"), F.to_date("event_timestamp")))
    events = raw.select(
        F.to_date("event_timestamp").alias("event_date"),
        "user_id",
        F.col("kind").alias("event_type"),
        tracked.alias("session_id"),
        "event_timestamp",
    )
    keys, path = ["event_date", "user_id", "event_type"], scratch_path(spark, "daily-metrics")
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp")
    first = daily_user_metrics(events.filter(F.col("event_timestamp") < noon))
    upsert_table(spark, path, first, keys, partition_by="event_date")
    late = F.col("event_timestamp") >= F.lit("2024-01-12").cast("timestamp")
    upsert_table(spark, path, daily_user_metrics(events.filter(late)), keys, partition_by="event_date")
    return read_table(spark, path, first.schema)


# ---- versions ---------------------------------------------------------------------------------

_LOG_SQL = f"""{_ORDERS_LOG},
log AS (
  SELECT *, 1 AS v, TIMESTAMP '2024-01-01' AS committed FROM target
  UNION ALL SELECT *, 2, TIMESTAMP '2024-01-02' FROM source
  UNION ALL SELECT *, 3, TIMESTAMP '2024-01-03' FROM closed
)"""


def _as_of_sql(version: int) -> str:
    return f"""WITH {_LOG_SQL}
    SELECT * EXCLUDE (v, committed, place) FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS place
      FROM log WHERE v <= {version}
    ) WHERE place = 1"""


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_before_1999(spark, sf_dir), _from_1998(spark, sf_dir), _closed(spark, sf_dir)]
    commits = [as_commit(p, i + 1, dt.datetime(2024, 1, i + 1)) for i, p in enumerate(parts)]
    return commits[0].unionByName(commits[1]).unionByName(commits[2])


@query(_as_of_sql(2))
def asof_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_as_of(orders_log(spark, sf_dir), ["o_orderkey"], version=2)


@query(_as_of_sql(1))
def asof_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noon of the first day is after commit 1; the version given besides is not used."""
    return read_as_of(orders_log(spark, sf_dir), ["o_orderkey"], as_of=dt.datetime(2024, 1, 1, 12), version=3)


@query(_as_of_sql(3))
def asof_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_as_of(orders_log(spark, sf_dir), ["o_orderkey"])


@query(
    f"""WITH {_LOG_SQL}
    SELECT CAST(v AS BIGINT) AS _commit_version, committed AS _commit_ts, count(*) AS rows_written,
      CAST(0 AS BIGINT) AS rows_deleted
    FROM log GROUP BY v, committed ORDER BY v DESC LIMIT 10"""
)
def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of a stored log; its second commit is written twice, as after a retry."""
    path = scratch_path(spark, "log")
    parts = {1: _before_1999(spark, sf_dir), 2: _from_1998(spark, sf_dir), 3: _closed(spark, sf_dir)}
    for version in (1, 2, 2, 3):
        append_commit(parts[version], path, version, dt.datetime(2024, 1, version))
    return commit_history(read_log(spark, path))


@query(
    f"""WITH {_LOG_SQL}
    SELECT * EXCLUDE (v, committed, place), CAST(2 AS BIGINT) AS _commit_version,
      TIMESTAMP '2024-01-02' AS _commit_ts, 'upsert' AS _op
    FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS place FROM log WHERE v <= 2
    ) WHERE place = 1
    UNION ALL SELECT * EXCLUDE (v, committed), v, committed, 'upsert' FROM log WHERE v > 2"""
)
def vacuum_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week before the run lies between commits 2 and 3, so rows replaced by commit 2 go."""
    return vacuum(orders_log(spark, sf_dir), ["o_orderkey"], dt.datetime(2024, 1, 9, 12))


def _versioned(spark: SparkSession, sf_dir: str) -> tuple[VersionedTable, list[dict]]:
    schema = roles.orders(spark, sf_dir).schema
    table = VersionedTable(spark, scratch_path(spark, "versioned"), ["o_orderkey"], schema)
    parts = [_before_1999(spark, sf_dir), _from_1998(spark, sf_dir), _closed(spark, sf_dir)]
    return table, [table.upsert(p, dt.datetime(2024, 1, i + 1)) for i, p in enumerate(parts)]


@query(
    f"""WITH {_LOG_SQL}, latest AS (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS place
      FROM log WHERE v <= 2
    )
    SELECT * EXCLUDE (v, committed, place), CAST(NULL AS VARCHAR) AS channel FROM latest
    WHERE place = 1 AND o_totalprice > 100000 AND o_orderstatus <> 'P'"""
)
def versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three upserts and a new column; then an old version is read through a filter."""
    table = replace(_versioned(spark, sf_dir)[0], schema=None)
    table.add_column("channel", T.StringType(), dt.datetime(2024, 1, 4))
    return table.read(version=2, filters=[("o_totalprice", ">", 100000), ("o_orderstatus", "!=", "P")])


@query(
    f"""WITH {_LOG_SQL}, marked AS (
      SELECT v, EXISTS (SELECT 1 FROM log b WHERE b.o_orderkey = log.o_orderkey AND b.v < log.v) AS known
      FROM log
    )
    SELECT CAST(v AS BIGINT) AS version, count(*) FILTER (NOT known) AS rows_inserted,
      count(*) FILTER (known) AS rows_updated
    FROM marked GROUP BY v"""
)
def versioned_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, outcomes = _versioned(spark, sf_dir)
    lines = [(o["version"], o["rows_inserted"], o["rows_updated"]) for o in outcomes]
    return spark.createDataFrame(lines, "version long, rows_inserted long, rows_updated long")


@query(_as_of_sql(3))
def optimized_and_vacuumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current rows of a table after its care; replaced rows and small files are gone."""
    table, _ = _versioned(spark, sf_dir)
    table.optimize_and_vacuum(dt.datetime(2024, 1, 9, 12), ["o_custkey", "o_orderpriority"])
    return table.read()


# ---- snapshots --------------------------------------------------------------------------------


@query(
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from,
      lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to
    FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS place
      FROM orders
    ) WHERE place = 1"""
)
def scd2_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = snapshot_history(roles.orders(spark, sf_dir), "o_custkey", "o_orderdate", "o_orderkey")
    return versions.select("o_custkey", "o_orderkey", "o_orderstatus", "valid_from", "valid_to")


_LATEST = """SELECT * EXCLUDE (place) FROM (
      SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
      FROM orders WHERE {rows}
    ) WHERE place = 1"""


@query(
    f"""WITH old AS ({_LATEST.format(rows="o_orderdate < TIMESTAMP '1999-01-01'")}),
    new AS ({_LATEST.format(rows="TRUE")})
    SELECT old.*, old.o_orderdate AS valid_from,
      CASE WHEN new.o_orderdate > old.o_orderdate THEN new.o_orderdate END AS valid_to
    FROM old LEFT JOIN new ON old.o_custkey = new.o_custkey
    UNION ALL
    SELECT new.*, new.o_orderdate, NULL FROM new LEFT JOIN old ON old.o_custkey = new.o_custkey
    WHERE old.o_custkey IS NULL OR new.o_orderdate > old.o_orderdate"""
)
def scd2_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of every customer's latest order before 1999, brought up to date."""

    def latest(rows: DataFrame) -> DataFrame:
        newest = [F.desc("o_orderdate"), F.desc("o_orderkey")]
        columns = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"]
        return first_per_key(rows.select(*columns), ["o_custkey"], newest)

    open_rows = latest(_before_1999(spark, sf_dir)).withColumns(
        {"valid_from": F.col("o_orderdate"), "valid_to": F.lit(None).cast("timestamp")}
    )
    snapshot = materialize(open_rows, "snapshot")
    current = materialize(latest(roles.orders(spark, sf_dir)), "current")
    return snapshot_update(snapshot, current, "o_custkey", "o_orderdate")


# ---- schema -----------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS channel, CAST(o_custkey AS VARCHAR) AS o_custkey,
      o_totalprice
    FROM orders"""
)
def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new column, dropped columns and a changed type."""
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("channel", T.StringType()),
            T.StructField("o_custkey", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    return sync_columns(roles.orders(spark, sf_dir), schema)


@query(
    """SELECT o_orderkey, o_totalprice, NULL AS channel FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
    UNION ALL
    SELECT o_orderkey, o_totalprice, lower(o_orderpriority) FROM orders
    WHERE o_orderdate >= TIMESTAMP '1999-01-01'"""
)
def schema_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with one column more are appended to a table written without it."""
    path = scratch_path(spark, "additive")
    rows = roles.orders(spark, sf_dir)
    later = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp")
    _before_1999(spark, sf_dir).select("o_orderkey", "o_totalprice").write.parquet(path)
    wider = rows.filter(later).select("o_orderkey", "o_totalprice", F.lower("o_orderpriority").alias("channel"))
    append_additive(read_table(spark, path), wider)  # refuses changed types
    wider.write.mode("append").parquet(path)
    return read_table(spark, path)


@query("SELECT *, CAST(NULL AS DECIMAL(18,2))::DOUBLE AS discount FROM orders")
def schema_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new column, and one that exists already and is left alone."""
    wider = add_column(roles.orders(spark, sf_dir), "discount", T.DoubleType())
    return add_column(wider, "o_orderkey", T.StringType())


# ---- layout -----------------------------------------------------------------------------------


@query("SELECT * FROM events")
def compact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as many small files, then compacted: other files, the same rows."""
    small, large = scratch_path(spark, "small"), scratch_path(spark, "compacted")
    roles.events(spark, sf_dir).repartition(40, "event_id").write.parquet(small)
    compact(spark, small, large)
    remove_path(spark, small)
    return read_table(spark, large, roles.EVENTS)


@query("SELECT * FROM events")
def zorder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "zorder")
    z_ordered(roles.events(spark, sf_dir), ["user_id", "event_type"], stored=True).write.parquet(path)
    return read_table(spark, path, roles.EVENTS)


@query("SELECT *, CAST(ts AS DATE) AS event_date FROM events")
def clustered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    rows = roles.events(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    laid_out = clustered(rows, "event_date", ["event_type", "user_id"], stored=True)
    laid_out.write.partitionBy("event_date").parquet(path)
    return read_table(spark, path, rows.schema)
