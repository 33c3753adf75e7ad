"""Queries on tables that are kept up from run to run instead of being computed anew."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.catalogue import roles
from eventide.catalogue.registry import query
from eventide.operators.changes import snapshot_changes
from eventide.operators.checksums import reconcile_rows
from eventide.operators.membership import day_filters, repeated_in_history
from eventide.operators.merge import upsert_table
from eventide.operators.metrics import METRICS_SCHEMA, merge_and_count
from eventide.operators.snapshots import snapshot_amend, snapshot_history, vanished_keys
from eventide.plans.sessions import run_sessions
from eventide.sources.lake import read_table
from eventide.sources.switch import create_table, remove_unused, switch_table, upsert_switched
from eventide.storage import materialize, scratch_path

# ---- sessions over days -----------------------------------------------------------------------

#: Runs of the incremental job: each takes some new days and, again, the days just before them.
RUNS = [("2024-01-01", "2024-01-10"), ("2024-01-08", "2024-01-17"), ("2024-01-15", "2024-01-24"), ("2024-01-22", "2024-01-30")]


def days_between(first: str, last: str) -> list[str]:
    begin, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    return [(begin + dt.timedelta(days=i)).isoformat() for i in range((end - begin).days + 1)]


def month_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with one session per user, which lasts all month; errors have none."""
    session = F.when(F.col("event_type") != "error", F.col("user_id").cast("string"))
    return roles.events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("event_id"),
        session.alias("session_id"),
        F.col("ts").alias("event_timestamp"),
        "event_type",
        F.to_date("ts").alias("event_date"),
    )


@query(
    """SELECT event_id, session_id, event_timestamp, event_type, event_date,
      count(*) OVER (PARTITION BY session_id) AS session_event_count,
      row_number() OVER w AS session_event_sequence,
      lag(event_type) OVER w AS prev_event_type,
      date_sub('second', lag(event_timestamp) OVER w, event_timestamp) AS seconds_since_prev_event
    FROM (
      SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp, event_type, CAST(ts AS DATE) AS event_date,
        CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS session_id
      FROM events
    ) WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id)"""
)
def session_windows_continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over ten days each give what a window over the whole month gives.

    Before an overlapping run, some events of its days arrive late: clicks are missing at first on the last three days.
    """
    events = materialize(month_visits(spark, sf_dir), "visits")
    facts, state = scratch_path(spark, "session-facts"), scratch_path(spark, "session-state")
    for first, last in RUNS:
        own = events.filter(F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        if last != RUNS[-1][1]:
            late = dt.date.fromisoformat(last) - dt.timedelta(days=2)
            own = own.filter((F.col("event_type") != "click") | (F.col("event_date") < F.lit(late.isoformat()).cast("date")))
        run_sessions(spark, own, facts, state, days_between(first, last))
    columns = ["session_event_count", "session_event_sequence", "prev_event_type", "seconds_since_prev_event"]
    return read_table(spark, facts).select(*events.columns, *columns)


# ---- differences of extracts ------------------------------------------------------------------

_EXTRACTS = """old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
new AS (
  SELECT * REPLACE (CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE o_orderstatus <> 'F' AND year(o_orderdate) <> 1996
)"""


def _extracts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders before 1999, and later all but finished ones and those of 1996, with new prices in 1998."""
    rows = roles.orders(spark, sf_dir)
    year = F.year("o_orderdate")
    price = F.when(year == 1998, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = rows.filter((F.col("o_orderstatus") != "F") & (year != 1996)).withColumn("o_totalprice", price)
    return rows.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")), new


@query(
    f"""WITH {_EXTRACTS}
    SELECT n.*, CASE WHEN o.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS _change
    FROM new n LEFT JOIN old o ON o.o_orderkey = n.o_orderkey
    WHERE o.o_orderkey IS NULL OR o.o_totalprice <> n.o_totalprice
    UNION ALL SELECT *, 'delete' FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"""
)
def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_changes(*_extracts(spark, sf_dir), ["o_orderkey"])


@query(f"WITH {_EXTRACTS} SELECT *, year(o_orderdate)::INTEGER AS o_year FROM new")
def merge_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by year, brought from one extract to the next by their difference; one year loses all rows."""
    old, new = (x.withColumn("o_year", F.year("o_orderdate")) for x in _extracts(spark, sf_dir))
    path, keys = scratch_path(spark, "orders-by-year"), ["o_year", "o_orderkey"]
    upsert_table(spark, path, old, keys, partition_by="o_year")
    changes = materialize(snapshot_changes(read_table(spark, path, old.schema), new, keys), "order-changes")
    gone = F.col("_change") == "delete"
    upsert_table(
        spark,
        path,
        changes.filter(~gone).drop("_change"),
        keys,
        partition_by="o_year",
        schema=old.schema,
        deletes=changes.filter(gone).select(*keys),
    )
    return read_table(spark, path, old.schema)


# ---- metrics by retraction --------------------------------------------------------------------

_MEASURED = """measured AS (
  SELECT event_id, CAST(ts AS DATE) AS event_date, ts AS event_timestamp,
    CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_type = 'view' AND CAST(ts AS DATE) = DATE '2024-01-11' THEN 'click' ELSE event_type END AS event_type,
    CASE WHEN event_type <> 'error' THEN user_id || '-' || hour(ts) END AS session_id,
    CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN 2 ELSE 1 END
      * CAST(value AS DECIMAL(18,2)) AS amount
  FROM events WHERE NOT (event_type = 'signup' AND CAST(ts AS DATE) = DATE '2024-01-05') AND CAST(ts AS DATE) <> DATE '2024-01-07'
)"""


@query(
    f"""WITH {_MEASURED}
    SELECT event_date, user_id, event_type, count(*) AS event_count, count(DISTINCT session_id) AS session_count,
      min(event_timestamp) AS first_event_at, max(event_timestamp) AS last_event_at, CAST(sum(amount) AS DOUBLE) AS amount_usd
    FROM measured GROUP BY 1, 2, 3"""
)
def metrics_by_retraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of all days after three merges: more days, changed rows, deleted rows and a day that empties."""
    tracked, day = F.col("event_type") != "error", F.to_date("ts")
    session = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.hour("ts"))
    events = roles.events(spark, sf_dir).select(
        "event_id",
        day.alias("event_date"),
        F.col("ts").alias("event_timestamp"),
        F.when(tracked, F.col("user_id").cast("string")).alias("user_id"),
        "event_type",
        F.when(tracked, session).alias("session_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )
    facts, metrics, parts = (scratch_path(spark, n) for n in ("metric-facts", "metrics", "metric-parts"))
    date, keys = F.col("event_date"), ["event_date", "event_id"]
    moved = F.when((date == "2024-01-11") & (F.col("event_type") == "view"), "click").otherwise(F.col("event_type"))
    changed = events.filter(date.between("2024-01-10", "2024-01-12")).withColumns(
        {"event_type": moved, "amount": (F.col("amount") * 2).cast("decimal(18,2)")}
    )
    gone = events.filter(((date == "2024-01-05") & (F.col("event_type") == "signup")) | (date == "2024-01-07"))
    for updates, deletes in (
        (events.filter(date < "2024-01-20"), None),
        (events.filter(date >= "2024-01-18"), None),
        (changed, None),
        (events.limit(0), gone.select(*keys)),
    ):
        merge_and_count(spark, facts, metrics, parts, updates, keys, deletes)
    stored = read_table(spark, metrics, METRICS_SCHEMA)
    return stored.withColumn("amount_usd", F.col("amount_usd").cast("double"))


# ---- reconciliation down to the keys ----------------------------------------------------------


@query(
    """SELECT CAST(ts AS DATE) AS event_date, event_id, CAST(1 AS BIGINT) AS left_rows,
      CASE WHEN CAST(ts AS DATE) = DATE '2024-01-03' THEN 0 WHEN CAST(ts AS DATE) = DATE '2024-01-20' THEN 2 ELSE 1 END
        ::BIGINT AS right_rows,
      CASE CAST(ts AS DATE) WHEN DATE '2024-01-03' THEN 'missing' WHEN DATE '2024-01-20' THEN 'copied' ELSE 'changed' END
        AS difference
    FROM events WHERE (CAST(ts AS DATE), event_type) IN
      ((DATE '2024-01-03', 'signup'), (DATE '2024-01-10', 'purchase'), (DATE '2024-01-20', 'error'))
    UNION ALL SELECT DATE '2024-02-01', event_id, 0, 1, 'extra' FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-30' AND event_type = 'view'"""
)
def reconcile_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events against a copy with lost, changed, repeated and made-up rows: exactly their keys are found."""
    day, kind = F.col("event_date"), F.col("event_type")
    left = roles.events(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    lost = (day == "2024-01-03") & (kind == "signup")
    value = F.when((day == "2024-01-10") & (kind == "purchase"), F.col("value") + 1).otherwise(F.col("value"))
    right = left.filter(~lost).withColumn("value", value)
    right = right.unionByName(left.filter((day == "2024-01-20") & (kind == "error")))
    extra = left.filter((day == "2024-01-30") & (kind == "view"))
    right = right.unionByName(extra.withColumn("event_date", F.lit("2024-02-01").cast("date")))
    return reconcile_rows(left, right, "event_date", ["event_id"], left.columns)


# ---- uniqueness against history ---------------------------------------------------------------


@query(
    """WITH history AS (SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE ts < TIMESTAMP '2024-01-25'),
    fresh AS (
      SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-25'
      UNION ALL SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-29' AND event_type = 'click'
      UNION ALL SELECT event_id FROM events WHERE event_type = 'purchase'
        AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
    ), counted AS (SELECT event_id, count(*) AS n_records FROM fresh GROUP BY 1)
    SELECT event_id AS unique_field, n_records, coalesce(CAST(day AS VARCHAR), '') AS known_days
    FROM counted LEFT JOIN history USING (event_id) WHERE n_records > 1 OR day IS NOT NULL"""
)
def unique_against_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last days with some replays, checked against all days before by membership filters."""
    rows = roles.events(spark, sf_dir).select("event_id", "event_type", F.to_date("ts").alias("event_date"))
    day, kind = F.col("event_date"), F.col("event_type")
    path = scratch_path(spark, "known-events")
    history = rows.filter(day < "2024-01-25")
    history.hint("rebalance", day).write.partitionBy("event_date").parquet(path)
    history = read_table(spark, path, history.schema)
    fresh = rows.filter(day >= "2024-01-25")
    fresh = fresh.unionByName(rows.filter((day >= "2024-01-29") & (kind == "click")))
    fresh = fresh.unionByName(rows.filter((kind == "purchase") & day.between("2024-01-10", "2024-01-12")))
    filters = materialize(day_filters(history, "event_id", "event_date"), "day-filters")
    found = repeated_in_history(fresh, history, filters, "event_id", "event_date")
    return found.withColumn("known_days", F.concat_ws(",", F.col("known_days").cast("array<string>")))


# ---- snapshots in any order -------------------------------------------------------------------

_VERSIONS = """versions AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS place FROM orders
  ) WHERE place = 1
)"""
_SPANS = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"]


def _empty_snapshot(rows: DataFrame) -> DataFrame:
    at = F.col("o_orderdate")
    return rows.limit(0).withColumns({"valid_from": at, "valid_to": F.lit(None).cast("timestamp")})


@query(
    f"""WITH {_VERSIONS}
    SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from,
      lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM versions"""
)
def scd2_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that arrive by priority, so that most versions are older than ones that are there already."""
    rows = roles.orders(spark, sf_dir).select(*_SPANS, "o_orderpriority")
    snapshot = _empty_snapshot(rows.select(*_SPANS))
    level = F.substring("o_orderpriority", 1, 1)
    for some in (["1", "2"], ["3", "4"], ["5"]):
        arrivals = rows.filter(level.isin(some)).select(*_SPANS)
        snapshot = materialize(snapshot_amend(snapshot, arrivals, "o_custkey", "o_orderdate", "o_orderkey"), "spans")
    return snapshot.drop("o_orderdate")


@query(
    f"""WITH {_VERSIONS}, entries AS (
      SELECT *, o_orderdate AS entry FROM versions
      UNION ALL SELECT o_custkey, NULL, NULL, NULL, TIMESTAMP '1999-01-01' FROM versions
      WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '1998-01-01'
    )
    SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from, valid_to FROM (
      SELECT *, lead(entry) OVER (PARTITION BY o_custkey ORDER BY entry) AS valid_to FROM entries
    ) WHERE o_orderkey IS NOT NULL"""
)
def scd2_vanished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order since 1998 are closed in 1999, and open again with their next order."""
    rows = roles.orders(spark, sf_dir).select(*_SPANS)
    at = F.col("o_orderdate")
    before = rows.filter(at < F.lit("1999-01-01").cast("timestamp"))
    history = snapshot_history(before, "o_custkey", "o_orderdate", "o_orderkey")
    snapshot = materialize(history, "spans")
    seen = before.filter(at >= F.lit("1998-01-01").cast("timestamp"))
    gone = vanished_keys(snapshot, seen, "o_custkey", F.lit("1999-01-01").cast("timestamp"))
    order = ("o_custkey", "o_orderdate", "o_orderkey")
    snapshot = materialize(snapshot_amend(snapshot, rows.limit(0), *order, vanished=gone), "spans")
    later = rows.filter(at >= F.lit("1999-01-01").cast("timestamp"))
    return snapshot_amend(snapshot, later, *order).drop("o_orderdate")


# ---- tables switched as a whole ---------------------------------------------------------------


@query(f"WITH {_EXTRACTS} SELECT *, year(o_orderdate)::INTEGER AS o_year FROM new")
def switched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of `merge_deletes` in the catalog, its years switched to folders written beside the old ones."""
    old, new = (x.withColumn("o_year", F.year("o_orderdate")) for x in _extracts(spark, sf_dir))
    root, keys = scratch_path(spark, "switched"), ["o_year", "o_orderkey"]
    name = "switched_" + root.rsplit("-", 1)[1]
    create_table(spark, name, old.schema, root, "o_year")
    upsert_switched(spark, name, old, keys, "o_year", root)
    changes = materialize(snapshot_changes(spark.table(name), new, keys), "order-changes")
    gone = F.col("_change") == "delete"
    deletes = changes.filter(gone).select(*keys)
    upsert_switched(spark, name, changes.filter(~gone).drop("_change"), keys, "o_year", root, deletes, ["o_custkey"])
    remove_unused(spark, name, root)
    result = materialize(spark.table(name), "switched-rows")
    spark.sql(f"DROP TABLE {name}")
    return result


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")
def switched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose rows are computed from itself and then replaced at once."""
    rows = roles.orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    root = scratch_path(spark, "switched")
    name = "switched_" + root.rsplit("-", 1)[1]
    create_table(spark, name, rows.schema, root)
    switch_table(spark, name, rows, root)
    switch_table(spark, name, spark.table(name).withColumn("o_totalprice", F.col("o_totalprice") * 2), root)
    remove_unused(spark, name, root)
    result = materialize(spark.table(name), "switched-rows")
    spark.sql(f"DROP TABLE {name}")
    return result
