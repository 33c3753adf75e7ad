import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from eventide.llm import ngram_join
from eventide.llm.arrow import pieces
from eventide.llm.components import connected_components
from eventide.llm.ngram_join import jaccard_classes, shingle_sets, signatures, sketches
from tests.llm.brute import Sets, jaccard_classes as brute, shingles
from tests.llm.conftest import DOCS


def variants(rng, n):
    """Texts in chains and groups of near copies, around the threshold."""
    words = [f"w{i}" for i in range(400)]
    out = []
    while len(out) < n:
        text = rng.choices(words, k=rng.choice([2, 5, 12, 40, 130]))
        for _ in range(rng.choice([1, 1, 2, 12])):
            out.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(words)
    return out[:n]


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_similar_sets_share_a_signature(rng, percent):
    texts = variants(rng, 300)
    piece = next(pieces(pa.array(texts), 1 << 30))
    values, first = shingle_sets(piece, 3)
    sets = [shingles(t, 3) for t in texts]
    assert list(np.diff(first)) == [len(s) for s in sets]
    signed, owner = signatures(values, first, percent)
    marks, own = sketches(values, first), [set(signed[owner == i].tolist()) for i in range(len(texts))]
    linked = 0
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            apart = len(sets[i] ^ sets[j])
            bits = np.bitwise_count(np.frombuffer(marks[i], np.uint8) ^ np.frombuffer(marks[j], np.uint8)).sum()
            assert bits <= apart
            if apart and 100 * common >= percent * len(sets[i] | sets[j]):
                linked += 1
                assert own[i] & own[j]
    assert linked > 20


@pytest.mark.parametrize(("n", "percent", "tile"), [(3, 90, 4096), (3, 60, 2)])
def test_classes_are_those_of_brute_force(frame, rng, rows, n, percent, tile):
    own = rows + [(1000 + i, t) for i, t in enumerate(variants(rng, 400))]
    own += [(5000, "A B"), (5001, "a b"), (5002, "a\tb c"), (6000, ""), (6001, None), (6002, " \n"), (7000, "a b " * 30_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(frame(own), n, percent, tile=tile).collect()}
    assert got == brute(own, n, percent)
    assert got[5001][1] == 5000 and got[6001] == (0, 6001)


def test_longer_sketches_fold_to_shorter_ones(rng):
    sets = [np.unique(np.array(rng.choices(range(1 << 60), k=n), np.uint64)) for n in (900, 3000, 9000)]
    sets.append(np.concatenate([sets[1], sets[2][:500]]))
    first = np.cumsum([0, *map(len, sets)])
    short, long = (sketches(np.concatenate(sets), first, bits) for bits in (2048, np.array([4096, 8192, 32768, 16384])))
    assert [len(x) for x in long] == [512, 1024, 4096, 2048]
    assert list(ngram_join.bits_apart(long, short)) == [0] * 4
    apart = ngram_join.bits_apart([long[1], long[3], long[2]], [long[3], long[1], long[1]])
    assert apart[0] == apart[1] and 300 < apart[0] <= 500 < 3000 < apart[2]


def test_long_texts_that_differ_are_not_fetched(frame, rng, monkeypatch):
    common = [f"c{i}" for i in range(4000)]
    own = [(i, " ".join(common + [f"w{i}-{j}" for j in range(4000)])) for i in range(8)]
    own += [(20 + i, own[i][1] + " more" * i) for i in (1, 2)]
    fetched, linked = [], ngram_join._linked

    def counted(pairs, *rest):
        fetched.extend((r.a, r.b) for r in pairs.collect())
        return linked(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    got = {r.doc_id: r.component_id for r in jaccard_classes(frame(own), 5, 80).collect()}
    assert got == {**{i: i for i in range(8)}, 21: 1, 22: 2}
    assert sorted(fetched) == [(1, 21), (2, 22)]


def test_pairs_of_signatures_that_the_same_documents_share_are_made_once(frame, rng, monkeypatch):
    rows = []
    for i in range(60):  # pairs under the threshold, so that no link leaves them out
        text = [f"{i}-{rng.random()}" for _ in range(100)]
        rows.append((2 * i, " ".join(text)))
        text[30] = text[70] = "other"
        rows.append((2 * i + 1, " ".join(text)))
    real, seen = ngram_join.candidate_pairs, []

    def note(members, *more):
        seen.extend((r.key, r.member) for r in members.select("key", "member").collect())
        return real(members, *more)

    monkeypatch.setattr(ngram_join, "candidate_pairs", note)
    found = jaccard_classes(frame(rows), 3, 90).collect()
    assert all(r.component_id == r.doc_id for r in found)
    groups = {key: frozenset(m for k, m in seen if k == key) for key, _ in seen}
    assert len(groups) > 10
    assert len(set(groups.values())) == len(groups)


def test_rows_without_id_and_repeated_rows(frame, odd):
    got = jaccard_classes(frame([*odd, (9, "one"), (9, "one")]), 3, 90).collect()
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got)
    assert found == [(0, 0, 0), (0, 4, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (9, 1, 4), (9, 1, 4)]


def test_an_id_with_two_texts_links_their_classes(spark, frame):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "quite another text of some words")
    own = [(1, a), (2, b), (5, a), (5, b), (5, b), (7, c), (8, c), (8, ""), (9, b), (9, a + " more"), (None, a)]
    got = jaccard_classes(frame(own), 3, 90).collect()
    assert len(got) == len(own)
    assert {(r.doc_id, r.component_id) for r in got if r.n_shingles and r.doc_id} == {
        (1, 1), (2, 1), (5, 1), (7, 7), (8, 7), (9, 1)
    }
    kept = corpus_pipeline.near_copies(spark, frame([*own, (1, a), (7, c), (7, b + " end"), (None, a)]), "")
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        [(0, a), (0, a), (1, a), (7, c), (7, b + " end")]
    )


def test_empty_table(spark):
    assert jaccard_classes(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark, rng):
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(70)]
    edges += [(900 + i, 900) for i in range(300)] + [(5, 5), (None, 3), (7, 100)]
    found = Sets({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None:
            found.join(a, b)
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(nodes)
    assert {r.node: r.component for r in got} == {x: found.find(x) for x in nodes}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
