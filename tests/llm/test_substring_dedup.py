import numpy as np
import pyarrow as pa
import pytest

from eventide.llm.arrow import pieces
from eventide.llm.substring_dedup import PhraseAutomaton, _locate, anchored, dedup_substrings
from tests.llm.brute import substring_dedup
from tests.llm.conftest import DOCS


@pytest.mark.parametrize("spread", [1, 9_000])
def test_automaton_locates_every_occurrence(rng, spread):
    codes = np.array([rng.randrange(6) * spread for _ in range(600)], np.uint16)
    first = np.array([0, 0, 100, 350, 600])
    phrases = np.stack([codes[s : s + 3] for s in (5, 120, 400)])
    known = {tuple(p) for p in phrases.tolist()}
    expected = [
        any(a <= i and i + 3 <= b for a, b in zip(first, first[1:])) and tuple(codes[i : i + 3].tolist()) in known
        for i in range(600)
    ]
    assert PhraseAutomaton(phrases).locate(codes, first).tolist() == expected
    assert not PhraseAutomaton(phrases[:0]).locate(codes, first).any()


def test_only_what_the_automaton_locates_is_removed(monkeypatch):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = pa.table({"place": [1, 2], "mark": [1, 2], "text": [passage, f"a b {passage}"]})
    own = anchored(next(pieces(docs["text"])), 20)
    recurring = np.unique(own.phrases(np.unique(own.anchors), 6), axis=0)
    packed = pa.table({"phrase": pa.array([p.tobytes() for p in recurring], pa.binary())})
    assert [len(x) for x in _locate(docs, packed, 20)["starts"].to_pylist()] == [21, 23]
    assert len(_locate(docs, packed.slice(0, 0), 20)) == 0
    monkeypatch.setattr(PhraseAutomaton, "locate", lambda self, codes, first: np.zeros(len(codes), bool))
    assert len(_locate(docs, packed, 20)) == 0


@pytest.mark.parametrize(("window", "shard_bytes"), [(20, 4 << 20), (20, 1 << 15), (4, 1 << 16)])
def test_results_are_those_of_brute_force(frame, rng, rows, window, shard_bytes):
    passages = [" ".join(f"p{rng.randrange(5000)}" for _ in range(n)) for n in (19, 20, 21, 60, 3)]
    own = list(rows)
    for i in range(60):
        parts = [" ".join(f"x{rng.randrange(50_000)}" for _ in range(rng.randint(0, 8))) for _ in range(3)]
        own.append((1000 + i, "\n".join(p for pair in zip(parts, rng.sample(passages, 3)) for p in pair)))
    own += [(3000, "a b " * 20_000), (3001, ""), (3002, None), (3003, "same " * 19), (3004, "same " * 20)]
    out = dedup_substrings(frame(own), window, digest=True, shard_bytes=shard_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out} == substring_dedup(own, window)


def test_kept_text_repeated_rows_and_rows_without_id(frame, odd):
    text = " ".join(map(str, range(30)))
    out = dedup_substrings(frame([*odd, (5, text), (5, text), (6, f"new {text}"), (None, text)])).collect()
    got = sorted((r.doc_id or 0, r.n_removed, r.kept) for r in out)
    assert [x for x in got if x[0] >= 5] == [(5, 0, text), (5, 0, text), (6, 30, "new")]
    assert (0, 30, "") in got and (4, 0, "one") in got and (1, 0, "") in got
    assert len(out) == len(odd) + 4


def test_rows_without_id_are_documents_of_their_own(frame):
    passage = " ".join(f"w{i}" for i in range(25))
    own = [(None, f"{n} {passage} {n}") for n in range(6)] + [(None, f"0 {passage} 0")] * 3
    out = dedup_substrings(frame(own)).collect()
    removed = sorted(r.n_removed for r in out)
    # One text keeps the passage, in all its rows; the other texts lose it.
    keeping = 4 if len({r.n_removed for r in out if r.kept.startswith("0 w0")}) else 1
    assert removed == [0] * keeping + [25] * (9 - keeping)


def test_one_row_many_times(frame):
    passage = " ".join(f"w{i}" for i in range(25))
    out = dedup_substrings(frame([(3, passage)] * 50 + [(5, f"{passage} end")] * 50)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(3, 0)] * 50 + [(5, 25)] * 50


def test_empty_table(spark):
    assert dedup_substrings(spark.createDataFrame([], DOCS)).count() == 0
