"""Versioned tables: upserts, reads of old versions, history, schema changes and care of one table.

A table is a change log (see `operators.history`). An upsert appends its rows as one commit and rewrites
nothing, so its cost is that of the updates; readers pick the newest row of each key.
"""

from __future__ import annotations

import datetime as dt
import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.constants import COMPACT_TARGET_MB, RETENTION_HOURS, ROWS_PER_FILE
from eventide.functions import all_of
from eventide.operators.history import (
    LOG_COLUMNS,
    OP,
    VERSION,
    append_commit,
    as_commit,
    read_as_of,
    read_log,
    table_history,
    vacuum,
)
from eventide.operators.keyed import first_per_key
from eventide.operators.layout import z_ordered
from eventide.operators.merge import AmbiguousSource, ambiguous_keys
from eventide.storage import (
    list_files,
    list_folders,
    materialize,
    remove_path,
    scratch_path,
    table_exists,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class VersionedTable:
    """A table at a path, with the keys that identify its rows. Without keys it only grows.

    Give the schema of a large table, or every read looks it up in all its files.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str] = ()
    schema: T.StructType | None = None

    def exists(self) -> bool:
        return table_exists(self.spark, self.path)

    def versions(self) -> list[int]:
        """Commit numbers in order, from folder names."""
        found = [n.partition("=") for n in list_folders(self.spark, self.path)]
        return sorted(int(v) for k, _, v in found if k == VERSION)

    def last_version(self) -> int:
        """The newest commit; 0 before the first."""
        return max(self.versions(), default=0)

    def log(self) -> DataFrame:
        return read_log(self.spark, self.path, self.schema)

    def upsert(self, rows: DataFrame, committed: dt.datetime, version: int | None = None) -> dict[str, Any]:
        """Append rows as a commit: keys in the table change their row, the others are new.

        A commit number given by the caller makes a retry replace its own commit.
        """
        copy = scratch_path(self.spark, "updates")
        rows = materialize(rows, "updates", copy)
        if self.keys:
            doubled = ambiguous_keys(rows, self.keys).limit(5).collect()
            if doubled:
                raise AmbiguousSource(f"several rows for one key: {[r.asDict() for r in doubled]}")
        created = not self.exists()
        version = self.last_version() + 1 if version is None else version
        total, updated = rows.count(), 0
        if not created and self.keys:
            updated = self._changed_keys(rows, version).count()
        append_commit(rows, self.path, version, committed)
        remove_path(self.spark, copy)
        return {
            "created": created,
            "version": version,
            "rows_inserted": total - updated,
            "rows_updated": updated,
            "rows_deleted": 0,
        }

    def _changed_keys(self, rows: DataFrame, version: int) -> DataFrame:
        """Keys of `rows` in the table before a commit. Only log rows of these keys are shuffled."""
        before = self.log().filter(F.col(VERSION) < version).select(*self.keys, VERSION, OP)
        same = before.join(rows.select(*self.keys), list(self.keys), "left_semi")
        return first_per_key(same, self.keys, [F.desc(VERSION)]).filter(F.col(OP) != "delete")

    def read(
        self,
        as_of: dt.datetime | None = None,
        version: int | None = None,
        filters: Sequence[tuple[str, str, Any]] | None = None,
    ) -> DataFrame:
        """The rows at a moment, at a version, or now. Filters apply to the rows that were current then."""
        found = self.versions()
        span = (found[0], found[-1]) if found else (None, None)
        return read_as_of(self.log(), self.keys, as_of, version, span).filter(all_of(filters))

    def history(self, limit: int = 10) -> DataFrame:
        return table_history(self.log(), limit)

    def add_column(self, name: str, data_type: T.DataType, committed: dt.datetime) -> bool:
        """Add a nullable column without rewriting rows; False when it is there already.

        A commit without rows carries the longer schema, and older rows read as NULL.
        """
        log_rows = self.log()
        if name in log_rows.columns:
            log.warning("column %s already exists in %s, nothing is added", name, self.path)
            return False
        none = self.spark.createDataFrame([], log_rows.drop(*LOG_COLUMNS).schema)
        version = self.last_version() + 1
        commit = as_commit(none.withColumn(name, F.lit(None).cast(data_type)), version, committed).drop(VERSION)
        commit.write.parquet(f"{self.path}/{VERSION}={version}")
        return True

    def optimize_and_vacuum(
        self,
        now: dt.datetime,
        z_columns: Sequence[str] = (),
        target_mb: int = COMPACT_TARGET_MB,
        retention_hours: int = RETENTION_HOURS,
        enforce: bool = True,
        rows_per_file: int = ROWS_PER_FILE,
    ) -> dict[str, int]:
        """Drop replaced rows older than the retention period, and write the rest in few, ordered files.

        A task sorts the rows of one file, which are bounded too: small files may hold very many rows.
        The new files are written beside the old ones first; a failed second write leaves them behind.
        """
        before = list_files(self.spark, self.path)
        old = self.log()
        kept = vacuum(old, self.keys, now, retention_hours, enforce)
        copy = scratch_path(self.spark, "maintenance")
        kept = materialize(kept, "maintenance", copy)
        rows_before, rows_after = old.count(), kept.count()
        files = max(1, round(sum(size for _, size in before) / (target_mb * 1024 * 1024)), math.ceil(rows_after / rows_per_file))
        if z_columns:
            laid_out = z_ordered(kept, z_columns, files=files, within=[VERSION], stored=True)
        else:
            laid_out = kept.hint("rebalance", F.col(VERSION))
        static = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        static.partitionBy(VERSION).parquet(self.path)
        remove_path(self.spark, copy)
        return {
            "files_before": len(before),
            "files_after": len(list_files(self.spark, self.path)),
            "rows_removed": rows_before - rows_after,
        }
