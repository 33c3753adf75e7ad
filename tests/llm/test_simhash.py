import hashlib
import random

import pytest

from eventide.llm import catalogue
from eventide.llm.simhash import document_fingerprints, near_links, table_masks
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.conftest import DOCS


def check(out, rows, radius):
    prints = {i: brute.fingerprint(t) for i, t in rows}
    edited = brute.edited_texts(rows)
    order = sorted(prints, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    with_words = {i: prints[i] if brute.WORD.search(t or "") else None for i, t in rows}
    classes = brute.near_classes(with_words, radius)
    texts = dict(rows)
    assert len(out) == len(rows)
    for r in out:
        own, changed = prints[r.doc_id], brute.fingerprint(edited[r.doc_id])
        assert r.n_chars == len(texts[r.doc_id] or "")
        assert (r.fingerprint, r.edited_fingerprint) == (f"{own:016x}", f"{changed:016x}")
        assert r.class_id == classes[r.doc_id]
        for value, other in ((r.near_edited, changed), (r.near_next, prints[following[r.doc_id]])):
            apart = (own ^ other).bit_count()
            assert 0 <= value <= 1 and (value == 1) == (apart == 0) and (value < 1e-9) == (apart >= 32)


def test_query_gives_what_brute_force_gives(spark, rows):
    out = catalogue.op11_simhash(spark, SMALL).collect()
    check(out, rows, 3)
    edited = brute.edited_texts(rows)
    assert {r.doc_id: r.edited_sha256 for r in out} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in edited.items()
    }
    assert sum(r.near_edited > r.near_next for r in out) > 0.95 * len(out)


@pytest.mark.parametrize(("radius", "blocks"), [(3, 6), (0, 1), (5, 8)])
def test_classes_of_planted_near_copies(frame, rng, radius, blocks):
    base = [f"w{rng.randrange(9000)}" for _ in range(400)]
    own = []
    for i in range(60):
        words = base if i < 30 else [f"v{rng.randrange(9000)}" for _ in range(200)]
        words = list(words)
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        own.append((i * 3, " ".join(words)))
    own += [(500, own[0][1]), (501, ""), (502, None), (503, "  "), (504, "Word"), (505, "word"), (506, "é" * 70_000)]
    check(document_fingerprints(frame(own), radius, blocks).collect(), own, radius)


def test_tables_find_every_pair_within_the_radius(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(8):
            near = base
            for bit in rng.sample(range(64), rng.randrange(5)):
                near ^= 1 << bit
            prints.add(near - (1 << 64) if near >> 63 else near)
    links = near_links(spark.createDataFrame([(p,) for p in prints], "p long")).collect()
    unsigned = [p % (1 << 64) for p in prints]
    found = brute.Sets(unsigned)
    for a, b in links:
        assert ((a ^ b) % (1 << 64)).bit_count() <= 3
        found.join(a % (1 << 64), b % (1 << 64))
    expected = brute.near_classes(dict(zip(unsigned, unsigned, strict=True)), 3)
    assert {p: found.find(p) for p in unsigned} == expected


def test_masks():
    assert len(table_masks(3, 6)) == 20 and table_masks(0, 1) == [-1]
    with pytest.raises(ValueError):
        table_masks(3, 3)


def test_odd_rows(frame, odd):
    out = document_fingerprints(frame(odd)).collect()
    assert len(out) == len(odd)
    by_id = {r.doc_id: r for r in out if r.doc_id}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == "0" * 16
    assert by_id[1].class_id == 1 and by_id[2].class_id == 2
    assert [r.n_chars for r in out if r.doc_id == 4] == [3, 3]
    # Rows without id come last: the edited text of 1 takes nothing, as its half is empty.
    assert by_id[4].edited == "on\t"[:2] + " "
    assert all(r.class_id is None for r in out if r.doc_id is None)


def test_empty_table(spark):
    assert document_fingerprints(spark.createDataFrame([], DOCS)).count() == 0
