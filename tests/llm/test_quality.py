import math
import zlib
from statistics import NormalDist

import numpy as np
import pyspark.sql.functions as F
import pytest
import zstandard

from eventide.llm import catalogue, quality
from tests.conftest import SMALL
from tests.llm.conftest import DOCS

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return docs, labels


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark, labelled):
    docs, labels = labelled
    learned = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    model = quality.train(docs, learned)
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    test = [(scores[r.doc_id], r.label) for r in labels.collect() if held_out(r.doc_id)]
    assert len(test) > 90
    assert sum((s >= 0.5) == y for s, y in test) / len(test) > 0.95
    bad = [s for s, y in test if y == 0]
    assert sum(s < 0.5 for s in bad) / len(bad) > 0.8
    brier = sum((s - y) ** 2 for s, y in test) / len(test)
    assert brier < 0.05
    kept = docs.where(quality.probability(spark, F.col("text"), model) >= 0.5)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.5}
    assert quality.train(docs, learned) == model


def test_a_reached_cap_keeps_the_share_of_labels(labelled):
    docs, labels = labelled
    counts = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    cap = counts[0] * 3 // 4
    assert counts[1] > 4 * cap
    large, small = quality.train(docs, labels), quality.train(docs, labels, sample_docs=cap)
    own = labels.join(quality.score(docs, small), "doc_id").agg(F.avg("score")).first()[0]
    whole = labels.join(quality.score(docs, large), "doc_id").agg(F.avg("score")).first()[0]
    share = counts[1] / (counts[0] + counts[1])
    assert abs(own - share) < 0.05 and abs(own - whole) < 0.05
    spread = [NormalDist(m, 0.02).inv_cdf((i + 0.5) / n) for n, m in ((4000, -0.03), (600, 0.03)) for i in range(n)]
    rows = np.c_[spread, np.arange(4600) < 4000]
    (a, b), (c, d) = (quality._curve(x, 4000 / 4600) for x in (rows, np.vstack([rows[:4000:7], rows[4000:]])))
    at = np.linspace(-0.1, 0.1, 21)
    assert np.abs(1 / (1 + np.exp(-a * at - b)) - 1 / (1 + np.exp(-c * at - d))).max() < 0.05


def test_odd_rows(spark, labelled, frame, odd):
    docs, labels = labelled
    model = quality.train(docs, labels, sample_docs=100)
    own = [*odd, (50, "good text " * 100_000)]
    got = quality.score(frame(own), model).collect()
    assert [r.doc_id for r in got] == [i for i, _ in own]
    empty = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1 and 0 <= empty.pop() <= 1
    assert quality.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_missing_labels(spark, frame):
    docs = frame([(1, "some text"), (2, "other text")])
    none = spark.createDataFrame([], "doc_id long, label int")
    good = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (None, 0), (2, None)], "doc_id long, label int")
    assert {r.score for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    assert all(r.score > 0.99 for r in quality.score(docs, quality.train(docs, good)).collect())
    few = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.train(docs, few)).collect())


def test_scores_are_those_of_plain_compression(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    crc = {i: zlib.crc32(str(i).encode()) % 3 for i in rows}
    learned = labels.where(~labels.doc_id.isin([i for i in crc if crc[i] == 1]))
    learned = learned.select("doc_id", F.col("quality").alias("label"))
    model = quality.train(docs, learned)
    compress = [
        zstandard.ZstdCompressor(
            level=3, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False
        ).compress
        for d in (model.good, model.bad)
    ]
    out = {r.doc_id: r for r in catalogue.op2_quality_classifier(spark, SMALL).collect()}
    assert out.keys() == rows.keys()
    for i, text in rows.items():
        data = text.encode()
        good, bad = (sum(len(c(data[k : k + 1024])) for k in range(0, len(data), 1024)) for c in compress)
        score = 1 / (1 + math.exp(-(model.slope * (good - bad) / max(good + bad, 1) + model.intercept)))
        assert abs(out[i].score - score) < 1e-9
        assert out[i].held_out == (crc[i] == 1) and out[i].predicted == int(out[i].score >= 0.5)
