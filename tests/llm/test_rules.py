from eventide.llm.rules import Limits, quality_rules
from tests.llm.brute import quality_base
from tests.llm.conftest import DOCS

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_are_those_of_each_text(frame, rows, odd, rng):
    parts = ["a", "b b", "c\n", "é#", "\n\n", "a b c d e\n", " "]
    own = rows + odd + [(9000 + i, " ".join(rng.choices(parts, k=rng.randint(0, 30)))) for i in range(200)]
    own.append((9999, "word " * 60_000))
    got = quality_rules(frame(own)).collect()
    assert [r.doc_id for r in got] == [i for i, _ in own]
    for r, (_, text) in zip(got, own, strict=True):
        assert tuple(r[c] for c in COLUMNS) == quality_base(text)
        assert not (r.base_failed and r.kept)


def test_verdict_by_characters_in_repeats(frame):
    plain = " ".join(f"w{i}" for i in range(100))
    long = " ".join("x" * 80 + str(i) for i in range(6))
    twice = f"{plain} {long} {plain.replace('w', 'v')} {long}"  # few words, most characters
    lines = plain + "\n" + "\n".join(["same line"] * 200)
    got = {r.doc_id: r for r in quality_rules(frame([(1, plain), (2, twice), (3, lines)])).collect()}
    assert got[1].kept and got[1].repeat_shares == [0.0] * 6
    assert not got[2].base_failed and not got[2].kept and got[2].repeat_shares[0] > 0.6
    assert not got[3].kept and got[3].dup_line_share > 0.5
    loose = Limits(ngrams={5: 1.0}, dup_lines=1.0, max_repeat_percent=100)
    assert all(r.kept for r in quality_rules(frame([(2, twice), (3, lines)]), limits=loose).collect())


def test_empty_table(spark):
    assert quality_rules(spark.createDataFrame([], DOCS)).count() == 0
