import pyspark.sql.functions as F
import pytest

from eventide.llm import catalogue
from eventide.llm.merkle import fold, manifest, proof_digest
from tests.conftest import SMALL
from tests.llm import brute

COLUMNS = ["doc_id", "source", "text"]
SHAPE = "doc_id long, source string, text string, leaf int, tree int, block int, index int, total int, root int, at int"


def proven(spark, rows, fanout, levels):
    docs = spark.createDataFrame([(*r, *[3] * 7) for r in rows], SHAPE)
    out = manifest(docs, COLUMNS, fanout=fanout, levels=levels, also={"again": F.upper("text")})
    out = out.withColumns({"folded": fold(F.col("leaf"), F.col("proof")), "digest": proof_digest(F.col("proof"))})
    return out.collect()


def expected(rows, fanout):
    return [
        (i, leaf, subroot, root, path, brute.sha("".join(x + y for x, y in path)))
        for i, leaf, subroot, root, path in brute.merkle_manifest(rows, fanout)
    ]


def compare(out, rows, fanout):
    key = lambda r: (r[0] or 0, str(r))
    got = [(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof], r.digest) for r in out]
    assert sorted(got, key=key) == sorted(expected(rows, fanout), key=key)
    assert all(r.folded == r.root for r in out)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (2, 2), (3, 1), (16, 3)])
def test_any_number_of_blocks_gives_the_tree_of_brute_force(spark, rng, fanout, levels):
    rows = [(i, "hot", f"t{i}") for i in rng.sample(range(10_000), 53)]
    rows += [(i, f"s{i % 7}", None) for i in range(40)] + [(i, None, "x") for i in range(9)]
    rows += [(1, "alone", "é")] + [(20_000 + i, f"one{i}", "") for i in range(12)]
    compare(proven(spark, rows, fanout, levels), rows, fanout)


def test_every_size_of_one_group(spark):
    for n in (1, 2, 3, 4, 5, 7, 8, 9, 17, 27):
        rows = [(i, "s", str(i)) for i in range(n)]
        compare(proven(spark, rows, 2, 1), rows, 2)


def test_odd_rows(spark, odd):
    rows = [(i, s, t) for i, t in odd for s in ("", "b", None)]
    compare(proven(spark, rows, 4, 1), rows, 4)
    out = proven(spark, rows, 4, 1)
    assert all(r.again == "ONE" for r in out if r.doc_id == 4)


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], SHAPE), COLUMNS).count() == 0


def test_only_tampered_rows_fail(spark):
    out = catalogue.op13_merkle_manifest(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    import zlib

    for r in out:
        hit = zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.verified == (not hit or texts[r.doc_id] == brute.lower(texts[r.doc_id]))
    assert {r.verified for r in out} == {True, False}
