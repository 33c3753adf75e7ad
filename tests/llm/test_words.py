import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm.arrow import FIRST, SECOND, lines, pieces, words
from tests.llm.brute import WORD

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x85😀", max_size=12)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_lines_and_hashes_are_those_of_each_text(texts, size):
    seen = []
    for piece in pieces(pa.array(texts, pa.string()), size):
        found, (starts, ends, owner, number) = words(piece), lines(piece)
        hashes = FIRST.ranges(piece.data, found.starts, found.ends)
        for i in range(len(piece)):
            a, b = found.first[i], found.first[i + 1]
            own = [piece.data[x:y].tobytes().decode() for x, y in zip(found.starts[a:b], found.ends[a:b])]
            mine = owner == i
            cut = [piece.data[x:y].tobytes().decode() for x, y in zip(starts[mine], ends[mine])]
            assert list(number[mine]) == list(range(len(cut)))
            seen.append((own, cut, list(hashes[a:b])))
    assert [x[0] for x in seen] == [WORD.findall(t or "") for t in texts]
    assert [x[1] for x in seen] == [(t or "").split("\n") for t in texts]
    by_word = {}
    for own, _, hashes in seen:
        for word, value in zip(own, hashes):
            assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_hashes_of_runs_do_not_depend_on_the_place():
    values = np.arange(600_000, dtype=np.uint64) % 1000
    for hasher in (FIRST, SECOND):
        runs = hasher.runs(values, 20)
        assert len(runs) == 600_000 - 19
        assert (runs[:1000] == runs[500_000:501_000]).all()
        assert len(set(runs[:1000].tolist())) == 1000
