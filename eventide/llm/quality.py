"""A quality classifier by compression (operator 2).

Two zstandard dictionaries are built, from good and from bad labelled texts. Every block of a document is
compressed with each; (good - bad) / (good + bad) over the compressed sizes of all blocks is the document's
difference, below zero if the good dictionary fits better. A logistic curve, fitted on labelled documents that
no dictionary has seen, turns it into the probability of a good label.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession

from eventide.llm.arrow import Piece, pieces
from eventide.llm.frames import map_batches, two_columns

SCHEMA = "doc_id long, difference double, score double"


@dataclass(frozen=True)
class Model:
    """What scoring needs; both dictionaries are empty where one of the labels was missing."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float
    block: int = 1024
    level: int = 3


@lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes, level: int):
    return [
        zstandard.ZstdCompressor(
            level=level,
            dict_data=zstandard.ZstdCompressionDict(d),
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        for d in (good, bad)
    ]


def _differences(piece: Piece, model: Model) -> np.ndarray:
    if not model.good or not model.bad:
        return np.zeros(len(piece))
    good, bad = _compressors(model.good, model.bad, model.level)
    out = np.zeros(len(piece))
    for i in range(len(piece)):
        text = piece.data[piece.offsets[i] : piece.offsets[i + 1]].tobytes()
        a = b = 0
        for at in range(0, len(text), model.block):
            block = text[at : at + model.block]
            a += len(good.compress(block))
            b += len(bad.compress(block))
        out[i] = (a - b) / max(a + b, 1)
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text between 0 and 1; one row per row of `docs`.

    A NULL or empty text has difference 0 and the score that belongs to it. Rows that repeat are scored one by
    one, an empty table gives an empty result, and only the two named columns are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        own = model.value
        for piece in pieces(batch.column(1)):
            difference = _differences(piece, own)
            yield {
                "doc_id": batch.column(0).slice(piece.row, len(piece)),
                "difference": difference,
                "score": _on_curve(difference, own),
            }

    return map_batches(two_columns(docs, id_col, text_col), SCHEMA, work)


def probability(spark: SparkSession, text: Column, model: Model) -> Column:
    """The score of a text column, to filter rows with all their columns; see `score`."""
    shared = spark.sparkContext.broadcast(model)

    def work(texts: pa.Array) -> pa.Array:
        found = [_differences(piece, shared.value) for piece in pieces(texts)]
        return pa.array(_on_curve(np.concatenate([np.empty(0), *found]), shared.value))

    return F.arrow_udf(work, "double")(text.cast("string"))


def _on_curve(difference: np.ndarray, model: Model) -> np.ndarray:
    return 1 / (1 + np.exp(-(model.slope * difference + model.intercept)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_docs: int = 1500,
    blocks_per_doc: int = 8,
    dictionary_bytes: int = 1 << 16,
    block: int = 1024,
    level: int = 3,
) -> Model:
    """Fit on a bounded sample: `sample_docs` documents of each label, the first by a hash of their ids.

    `docs` has doc_id and text, `labels` has doc_id and label, 1 for good and 0 for bad. Rows without id or
    label are left out; of several labels of one document the highest counts. Half of the sample goes into
    the dictionaries, `blocks_per_doc` blocks of `block` bytes spread over each text; the other half fits the
    curve, each row weighted so that the labels have their shares among all labelled documents, however many
    were sampled. If a label is missing altogether, every score is the share of good labels, or 0.5 without any.
    """
    texts = two_columns(docs, "doc_id", "text")
    clean = labels.select("doc_id", F.col("label").cast("int").alias("label")).dropna()
    clean = clean.groupBy("doc_id").agg(F.max("label").alias("label"))
    clean = clean.join(texts.select("doc_id"), "doc_id", "left_semi")
    totals = {r.label: r["count"] for r in clean.groupBy("label").count().collect()}
    place = F.xxhash64("doc_id", F.lit("sample"))
    picked = None
    for label in (0, 1):
        own = clean.where(F.col("label") == label).orderBy(place, "doc_id").limit(sample_docs)
        picked = own if picked is None else picked.unionByName(own)
    ids = picked.withColumn("place", F.xxhash64("doc_id", F.lit("half")) % 2 != 0).collect()
    share = [sum(r.label == x for r in ids) for x in (0, 1)]
    if not all(share):
        good = 0.0 if share[0] else 1.0 if share[1] else 0.5
        return Model(b"", b"", 0.0, float(np.clip(np.log((good + 1e-9) / (1 - good + 1e-9)), -20, 20)))
    # At most 2 * sample_docs rows of three plain values: safe to send to all tasks.
    own_ids = docs.sparkSession.createDataFrame(
        [(r.doc_id, r.label, r.place) for r in ids], "doc_id long, label int, place boolean"
    )
    sample = texts.join(F.broadcast(own_ids), "doc_id").dropDuplicates(["doc_id"])
    blocks = _blocks(sample.where("place"), block, blocks_per_doc).collect()
    dictionaries = [
        _dictionary([bytes(r.block) for r in blocks if r.label == x], dictionary_bytes) for x in (1, 0)
    ]
    model = Model(*dictionaries, 0.0, 0.0, block, level)
    rest = sample.where("not place")
    known = {r.doc_id: r.label for r in ids}
    found = [(r.difference, known[r.doc_id]) for r in score(rest, model).collect()]
    slope, intercept = _curve(np.array(found, float).reshape(-1, 2), totals[1] / (totals[0] + totals[1]))
    return Model(*dictionaries, slope, intercept, block, level)


def _blocks(sample: DataFrame, block: int, most: int) -> DataFrame:
    """Up to `most` blocks of each text, evenly spread over it."""

    def work(batch: pa.RecordBatch):
        for piece in pieces(batch.column(1)):
            labels, out = batch.column(0).slice(piece.row, len(piece)).to_pylist(), []
            for label, a, b in zip(labels, piece.offsets[:-1], piece.offsets[1:], strict=True):
                text = piece.data[a:b].tobytes()
                parts = [text[i : i + block] for i in range(0, len(text), block)]
                step = max(1, -(-len(parts) // most))
                out += [(label, x) for x in parts[::step]]
            yield {"label": [x[0] for x in out], "block": [x[1] for x in out]}

    return map_batches(sample.select("label", "text"), "label int, block binary", work)


def _dictionary(blocks: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little to train on, the blocks themselves."""
    blocks = sorted(b for b in blocks if b)
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:size] or b"\n"


def _curve(found: np.ndarray, share: float, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of the logistic curve by Newton's method, with softened labels.

    `share` is that of good labels among all documents; the rows are weighted to have it.
    """
    x, y = found[:, 0], found[:, 1]
    if len(set(y)) < 2:
        return -30.0, 0.0
    smooth = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    design = np.stack([x, np.ones_like(x)], 1)
    rows = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    weights = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (rows * (p - smooth)) + 1e-3 * weights
        curve = (design * (rows * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])
