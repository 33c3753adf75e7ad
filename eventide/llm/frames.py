"""How the operators of this package run over DataFrames."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from eventide.llm.arrow import mix
from eventide.operators.keyed import small_side
from eventide.storage import materialize, remove_path, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def two_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, so that other columns can't clash with what an operator adds."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_batches(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], Iterator[dict] | None]
) -> DataFrame:
    """Run `work` on each Arrow batch; every dict of columns that it yields becomes rows."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for columns in work(batch):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow
                    )
        finally:
            give_back()

    return df.mapInArrow(run, fields)


_KEPT: dict = {}


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """What a task makes once and uses for all its batches."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """At the end of a task: forget what it kept, and return free memory, since workers wait for other tasks."""
    _KEPT.clear()
    return_free()


def return_free() -> None:
    """Give memory that is not in use back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim:
        trim(0)


def numbered(
    df: DataFrame,
    group: str,
    order: list[Column],
    write: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Add `index`, the place of each row in its group from 0, and `total`, the rows of the group.

    `group` is a column without NULL. Rows are sorted by ranges of (group, order), so a hot group lies in many
    tasks; a row's place is its place in the range plus the rows of the group in the ranges before. `order`
    leaves only rows equal that may change places.
    """
    at = F.monotonically_increasing_id()  # the range in the upper bits, the row in it in the lower 33
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("at", at)
    rows = write(ranged.withColumn("slice", F.shiftright("at", 33)), "numbered")
    slices = rows.groupBy(group, "slice").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    across = Window.partitionBy(group)
    earlier = across.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        F.col(group).alias("group_of"),
        F.col("slice").alias("slice_of"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(across).alias("total"),
    )
    edges = small_side(write(slices, "numbered-slices"))
    joined = rows.join(edges, (F.col(group) == F.col("group_of")) & (F.col("slice") == F.col("slice_of")))
    return joined.select(*df.columns, (F.col("at") + F.col("shift")).alias("index"), "total")


class Scratch:
    """Tables in shared storage that nothing needs any more once an operator has its result."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._paths.append(scratch_path(self._spark, name))
        return materialize(df, name, self._paths[-1])

    def clear(self) -> None:
        for path in self._paths:
            remove_path(self._spark, path)
        self._paths = []


#: Bits of a `Bitmap`: four MB, whatever the data.
BITMAP_BITS = 1 << 25


class Bitmap:
    """A bounded set of ids for every executor: `has` is true for each of them, and for few others.

    It only saves shuffles; an exact join follows wherever it is used. With very many ids it fills up and
    saves nothing, and results stay the same.
    """

    def __init__(self, ids: DataFrame):
        """`ids` has one column of type long. The driver gets a row for each 64 bits at most."""
        spark, name = ids.sparkSession, ids.columns[0]

        def work(batch: pa.RecordBatch):
            at = np.unique(_bit(batch.column(0).drop_null().to_numpy()))
            yield {"word": at >> 6, "bits": np.int64(1) << (at & 63)}

        bits = map_batches(ids.select(name), "word long, bits long", work)
        found = bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        table = np.zeros(BITMAP_BITS // 64, np.int64)
        table[found["word"].to_numpy()] = found["bits"].to_numpy()
        self._shared = spark.sparkContext.broadcast(table)

    def test(self, ids: np.ndarray) -> np.ndarray:
        at = _bit(ids)
        return self._shared.value[at >> 6] >> (at & 63) & 1 == 1

    def has(self, column: Column) -> Column:
        """False for NULL."""

        def check(ids: pa.Array) -> pa.Array:
            known = self.test(pc.fill_null(ids, 0).to_numpy())
            return pc.and_(pa.array(known), pc.is_valid(ids))

        return F.arrow_udf(check, "boolean")(column)


def _bit(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(BITMAP_BITS)).astype(np.int64)


def candidate_pairs(
    members: DataFrame,
    near: Callable[[dict, np.ndarray, np.ndarray], np.ndarray],
    tile: int,
    write: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Distinct pairs (a, b), a < b, of members of a group that `near` lets through.

    `members` has long columns key and member, and what `near` needs; it gets the columns of many groups as
    arrays and two arrays of row numbers, and says which of those pairs are near. A group with more than `tile`
    rows is cut into blocks by a hash of the member, and each pair of blocks is compared on its own; so no
    group in a task is larger than about two tiles, and only near pairs leave the task.
    """
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    blocks = write(blocks, "pair-blocks")
    block = F.pmod(F.xxhash64("member"), F.col("blocks").cast("long")).cast("int")
    each = members.join(blocks, "key").withColumn("block", block)
    each = each.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    group = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    rest = [c for c in members.columns if c not in ("key", "member")]
    each = each.select(
        group.alias("group"),
        (F.col("block") != F.col("other")).alias("cross"),
        (F.col("block") > F.col("other")).alias("side"),
        "member",
        *rest,
    )
    each = each.repartition("group").sortWithinPartitions("group")
    schema = members.sparkSession.createDataFrame([], "a long, b long").schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch] if left is None else [*left.to_batches(), batch])
            group = rows["group"].to_numpy()
            whole = int(np.searchsorted(group, group[-1]))  # the last group may go on
            left = rows.slice(whole)
            yield _pairs(rows.slice(0, whole), near, arrow)
        if left is not None:
            yield _pairs(left, near, arrow)

    return each.mapInArrow(run, schema).distinct()


def _pairs(rows: pa.Table, near, schema: pa.Schema) -> pa.RecordBatch:
    """All pairs within groups, by their distance in the order of rows."""
    columns = {n: rows[n].to_numpy() for n in rows.column_names}
    group, member, side, cross = (columns[n] for n in ("group", "member", "side", "cross"))
    end = np.searchsorted(group, group, "right")
    first = np.arange(len(group))
    out = []
    step = 0
    while len(first):
        step += 1
        first = first[first + step < end[first]]
        i, j = first, first + step
        use = (member[i] != member[j]) & (~cross[i] | (side[i] != side[j]))
        i, j = i[use], j[use]
        if len(i):
            use = near(columns, i, j)
            out.append((np.minimum(member[i], member[j])[use], np.maximum(member[i], member[j])[use]))
    empty = np.empty(0, np.int64)
    a = np.concatenate([empty, *(x for x, _ in out)])
    b = np.concatenate([empty, *(y for _, y in out)])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)


def without(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is not in the one column of `ids`; only rows that may be are shuffled.

    Rows without an id stay.
    """
    name = "id_to_drop"
    while name in docs.columns:
        name += "_"
    ids = ids.select(F.col(ids.columns[0]).alias(name)).dropna().distinct()
    maybe = Bitmap(ids).has(docs[id_col])
    some = docs.where(maybe).join(ids, F.col(id_col) == F.col(name), "left_anti")
    return docs.where(~maybe).unionByName(some)
