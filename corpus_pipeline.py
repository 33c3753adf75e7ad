"""A corpus pipeline: drop bad documents, repeated lines, near copies and benchmark leaks, then encode.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Its result is written
as Parquet and read again as the next one's docs. All but the last return the columns of `docs`, whatever they are
called besides doc_id and text; other columns may be NULL. Of an empty table every stage makes an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from eventide.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from eventide.llm.frames import Bitmap, table, without
from eventide.operators.keyed import first_per_key
from eventide.storage import materialize

#: No SQL: compression, edit distances and byte-pair merges are beyond it.
ORACLE_SQL = None

#: Rows of an Arrow batch. Whole texts go through it, and both of its sides hold a batch outside Spark's memory.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _small_batches(stage: Stage) -> Stage:
    """The stage, in a session whose Arrow batches have `BATCH_ROWS` at most; the setting stays, as rows are computed later."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get(_BATCH_SETTING))
        if not 0 < rows <= BATCH_ROWS:  # none or less is without bound
            spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@_small_batches
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.5 or more. Its labels are all of the table's.

    A NULL or empty text has the score of an even difference, which the share of good labels decides. Rows without an
    id are scored like others but never learned from. Rows that repeat are scored one by one, with equal results.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.train(docs, labels)
    return docs.where(quality.probability(spark, F.col("text"), model) >= 0.5)


@_small_batches
def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat another one, exactly or nearly; n_chars follows the text.

    NULL texts stay NULL, and a document that loses all its lines stays with an empty text. Rows without an id are
    left as they are. Rows of one id count as one document: those of equal text keep the same lines.
    """
    left = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


@_small_batches
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of documents with much the same n-grams.

    Of rows with one id and one text one stays, the first by a hash of all its columns. Documents without words and rows
    without an id are copies of nothing and stay.
    """
    classes = ngram_join.jaccard_classes(docs)
    copies = materialize(classes.where("component_id != doc_id").select("doc_id"), "copies")
    left = without(docs, "doc_id", copies)
    repeated = left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    maybe = Bitmap(repeated).has(left.doc_id)
    return left.where(~maybe).unionByName(first_per_key(left.where(maybe), ["doc_id", "text"], []))


@_small_batches
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item. NULL and empty texts hold none, and rows that repeat or lack
    an id are judged one by one.
    """
    return docs.where(~decontaminate.holds_item(F.col("text"), table(spark, sf_dir, "benchmark")))


@_small_batches
def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids, and the text that they decode to, a row for each row.

    A NULL text counts as empty and has no ids; a NULL id stays NULL.
    """
    import public_tokenizers as public

    encoded = bpe.encode_documents(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text")
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", repeated_lines),
    ("ngram_join", near_copies),
    ("decontamination", benchmark_leaks),
    ("byte_bpe", byte_pairs),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
