import numpy as np
import pyarrow as pa
import pytest

from eventide.llm.arrow import pieces
from eventide.llm.components import connected_components
from eventide.llm.line_dedup import Lines, _line_rows, dedup_lines, keys, near_lines, within
from eventide.storage import materialize
from tests.llm.brute import distance, line_dedup
from tests.llm.conftest import DOCS
from tests.llm.test_decontaminate import edited


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(rng, edits):
    left = ["".join(rng.choices("abé", k=rng.randint(0, 30))) for _ in range(1500)]
    right = [edited(rng, x, rng.randint(0, 4), "abé") if x else "ab" for x in left]
    assert within(left, right, edits).tolist() == [distance(a, b) <= edits for a, b in zip(left, right)]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_meet(rng, edits):
    base = ["".join(rng.choices("abcdé ", k=rng.randint(12, 40))) + "." for _ in range(60)]
    texts = [edited(rng, x, rng.randint(0, edits), "abcdé ").replace("\n", " ") for x in base for _ in range(4)]
    texts = [t for t in texts if t.strip()]
    own = Lines(next(pieces(pa.array(["\n".join(texts)]))), 10)
    key, there = keys(own, np.arange(len(texts)), edits, 10)
    held = [set(k[t].tolist()) for k, t in zip(key, there)]
    indexed = [set(k[: edits + 1][t[: edits + 1]].tolist()) for k, t in zip(key, there)]
    node = own.node.astype(np.uint64)
    for i in range(len(texts)):
        for j in range(i):
            if min(len(texts[i]), len(texts[j])) >= 10 and distance(texts[i], texts[j]) <= edits:
                assert node[i] == node[j] or held[i] & indexed[j] or held[j] & indexed[i]
                assert np.bitwise_count((node[i] ^ node[j]) >> np.uint64(31)) <= 4 * edits


@pytest.mark.parametrize(("edits", "min_chars", "tile"), [(2, 24, 4096), (3, 12, 3)])
def test_texts_are_those_of_brute_force(frame, rng, rows, edits, min_chars, tile):
    base = [x for _, t in rows[:60] for x in t.split("\n") if 12 <= len(x) < 200][:40]
    own = rows[:60]
    for i in range(100):
        some = [edited(rng, x, rng.randint(0, 4), "abé ") for x in rng.sample(base, 3)]
        own.append((1000 + i, "\n".join(some + ["", " \t"] * (i % 2))))
    own += [(2000, ""), (2001, "\n"), (2002, None), (2003, "short\nshort\nshorx"), (2004, "y" * 100_000)]
    docs = frame(own)
    out = dedup_lines(docs, edits, min_chars, tile=tile)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == line_dedup(own, edits, min_chars)
    assert got[2003] == "short\nshorx"


def test_a_dense_group_is_compared_with_few_of_its_lines(spark, rng):
    base = "the same beginning of many lines and then some more of it"
    texts = [edited(rng, base, rng.randint(0, 2), "abcd") for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    asked = []

    def write(df, name):
        df = materialize(df, name)
        if name in ("line-stars", "line-pairs"):
            asked.append(df.count())
        return df

    rows = materialize(_line_rows(docs, 2, 24), "line-rows")
    facts = rows.where("line is not null").select("line", "node").distinct()
    links = near_lines(docs, rows, facts, 2, 64, write)
    found = connected_components(links).groupBy("component").count().collect()
    distinct = len({t for t in texts if len(t) >= 24})
    assert len(found) == 1 and found[0]["count"] == distinct
    assert sum(asked) < 12 * distinct


def test_ids_of_any_size(frame):
    line = "a line that is long enough to be near"
    ids = [-(1 << 63), -5, 0, 7, (1 << 63) - 1]
    got = {r.doc_id: r.text for r in dedup_lines(frame([(i, f"x\n{line}\n{line}!\n{i}") for i in ids])).collect()}
    assert got == {i: (f"x\n{line}\n{i}" if i == ids[0] else str(i)) for i in ids}


def test_repeated_rows_and_rows_without_id(frame, odd):
    line = "a line that is long enough to be near"
    own = [*odd, (8, line), (8, line), (9, line + "!"), (None, line)]
    got = sorted((r.doc_id or 0, r.text or "") for r in dedup_lines(frame(own)).collect())
    expected = [(i or 0, t or "") for i, t in own if i != 9] + [(9, "")]
    assert got == sorted(expected)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
