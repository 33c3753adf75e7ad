"""Paths in shared storage: scratch folders, existence, listing, and tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see.

    A cluster names it in `spark.checkpoint.dir`. Only where that is unset and all tasks run in this
    process (tests on one machine), a temporary folder is made and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("eventide.scratch.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="eventide-")
        spark.conf.set("eventide.scratch.dir", root)
    return root.rstrip("/")


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/eventide/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses; nothing exists there yet."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Drop all scratch tables of this application, once no DataFrame reads them any more."""
    remove_path(spark, _scratch_folder(spark))


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _data_files(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return
    root, walk = fs.makeQualified(target).toString(), fs.listFiles(target, True)
    while walk.hasNext():
        status = walk.next()
        name = status.getPath().toString()
        if not any(_hidden(part) for part in name.removeprefix(root).strip("/").split("/")):
            yield name, status.getLen()


def _hidden(part: str) -> bool:
    """Names that Spark does not read: markers, temporary files, stream metadata."""
    return part.startswith(".") or (part.startswith("_") and "=" not in part)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when there is a data file; a partitioned table written without rows has none."""
    return next(_data_files(spark, path), None) is not None


def list_folders(spark: SparkSession, path: str) -> list[str]:
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files below a folder; file metadata only."""
    return list(_data_files(spark, path))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write `df` once to shared storage and continue from the files.

    A plan that uses the same rows more than once reads them instead of computing them again, and a
    lost executor costs a file read rather than the whole history of the rows.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return read_back(spark, path, df.schema)


def read_back(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
