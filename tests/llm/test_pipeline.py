import inspect

import pyspark.sql.functions as F
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from eventide.llm import catalogue
from tests.compare import connect, differences
from tests.conftest import SMALL


def test_registered():
    names = set(entry.queries())
    assert {q.split("_")[0] for q in catalogue.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(catalogue.QUERIES) | {"pipeline"} <= names
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, name):
    df = catalogue.QUERIES[name](spark, SMALL)
    assert differences(df, connect(SMALL), catalogue.ORACLES[name]) == []


def test_stages_keep_the_columns_and_follow_their_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    clean = docs.orderBy(F.length("text").desc()).first().text
    extra = [
        (5000, f"{clean[:500]}\n{item}\n", "en", "s", 1),
        (5001, "Junk " * 300, "en", "s", 1),
        (None, None, None, None, None),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("score", F.lit(1))
    assert [list(inspect.signature(f).parameters) for _, f in corpus_pipeline.STAGES] == [["spark", "docs", "sf_dir"]] * 5
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, seen[-1], SMALL).write.parquet(path)
        seen.append(spark.read.parquet(path))
    kept = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert all(d.columns == docs.columns for d in seen[:-1])
    assert 5001 in kept[0] and 5001 not in kept[1] and kept[1] == kept[2]
    assert len(kept[1]) > 0.8 * len(kept[0])
    assert 5000 in kept[3] and 5000 not in kept[4]
    last, before = seen[-1], seen[-2]
    texts = {r.doc_id: r.text or "" for r in before.collect()}
    assert {r.doc_id: r.text for r in last.collect()} == texts
    lengths = seen[2].where("text is not null and n_chars != length(text)")
    assert lengths.count() == 0


def test_stages_on_an_empty_table_and_on_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("score", F.lit(1))
    odd = [(1, "", None, None, None, 1), (2, None, "en", "s", 0, 2), (None, "some words here", None, None, None, 3),
           (4, " \n\t", "en", "s", 3, 4), (4, " \n\t", "en", "s", 3, 4), (5, "x" * 300_000, None, "s", 1, 5)]
    for rows in ([], odd):
        before = spark.createDataFrame(rows, docs.schema)
        for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{len(rows)}-{name}"
            stage(spark, before, SMALL).write.parquet(path)
            after = spark.read.parquet(path)
            assert n == 4 or after.columns == docs.columns
            assert after.count() <= before.count()
            before = after
        assert before.columns == ["doc_id", "n_tokens", "ids", "text"]
        left = {(r.doc_id, len(r.text)) for r in before.collect()}
        assert left <= {(1, 0), (2, 0), (None, 15), (4, 3), (5, 300_000)} and (not rows or (None, 15) in left)


def test_one_of_several_rows_of_an_id_and_text_stays_the_same(spark):
    docs = spark.createDataFrame([(1, "a b", s) for s in "xyz"] * 3, "doc_id long, text string, source string")
    kept = [
        corpus_pipeline.near_copies(spark, d, SMALL).collect() for d in (docs, docs.repartition(5), docs.orderBy("source"))
    ]
    assert len(kept[0]) == 1 and kept[0] == kept[1] == kept[2]
