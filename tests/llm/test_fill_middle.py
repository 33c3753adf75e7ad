import numpy as np
import pyspark.sql.functions as F
import pytest

from eventide.llm.arrow import Piece
from eventide.llm.fill_middle import BlockTree, fill_in_middle, restore
from tests.llm import brute
from tests.llm.conftest import DOCS


def texts(rng, n):
    parts = ["word", " ", "\t", "é", "漢字", "🙂", "\n\n", " ", "a-b", "\xa0"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 7, 256])
def test_tree_finds_every_cut(rng, block):
    own = [*texts(rng, 30), "", "x" * 999, " " * 600, ""]
    sizes = [len(t.encode()) for t in own]
    piece = Piece(0, np.frombuffer("".join(own).encode(), np.uint8), np.cumsum([0, *sizes]))
    tree = BlockTree(piece, block)
    units = [brute.UNIT.findall(t) for t in own]
    assert tree.n.tolist() == [len(u) for u in units]
    asked = [(i, k) for i, u in enumerate(units) for k in range(len(u) + 1)]
    at, points = tree.cut(np.array([i for i, _ in asked]), np.array([k for _, k in asked]))
    before = np.cumsum([0, *(len(t) for t in own)])
    for (i, k), byte, point in zip(asked, at.tolist(), points.tolist(), strict=True):
        left = "".join(units[i][:k])
        assert point == before[i] + len(left)
        assert k == 0 or byte == piece.offsets[i] + len(left.encode())


@pytest.mark.parametrize("block", [3, 256])
def test_rows_are_those_of_brute_force_and_round_trip(frame, rng, rows, block):
    own = [*rows, *((5000 + i, t) for i, t in enumerate(texts(rng, 400)))]
    own += [(9000 + i, f"some <{m}> mark") for i in range(9) for m in "PSM"]
    own += [(9100, "long " * 200_000), (9101, "x" * 300_000), (9102, "<" * 40), (9103, "<P " * 40)]
    made = fill_in_middle(frame(own), block=block)
    made = made.withColumn("back", restore(F.col("output"), F.col("form"))).collect()
    key = lambda x: (x[0], str(x))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=key)
    assert got == sorted(((i, *brute.fill_in_middle(i, t)) for i, t in own), key=key)
    assert sorted((r.doc_id, r.back) for r in made) == sorted(own)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_odd_rows_and_empty_table(spark, frame, odd):
    out = fill_in_middle(frame(odd)).collect()
    key = lambda r: (r[0] or 0, str(r))
    got = sorted((tuple(r) for r in out), key=key)
    assert got == sorted(((i, *brute.fill_in_middle(i, t)) for i, t in odd), key=key)
    assert fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0


def test_rates(frame):
    out = fill_in_middle(frame([(i, "a b c d") for i in range(300)]), rate=100, spm=0, marks=("[p]", "[s]", "[m]"))
    out = out.withColumn("back", restore(F.col("output"), F.col("form"), ("[p]", "[s]", "[m]"))).collect()
    assert {r.form for r in out} == {"psm"} and {r.back for r in out} == {"a b c d"}
