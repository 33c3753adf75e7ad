import pyspark.sql.functions as F
import pytest

from eventide.llm.decontaminate import Finder, contaminated, error_budget, fold, holds_item, myers, unfold
from tests.llm.brute import distance


def edited(rng, text, edits, letters="abc "):
    x = list(text)
    for _ in range(edits):
        k = rng.randrange(len(x) or 1)
        how = rng.randrange(3)
        x[k : k + (how != 0)] = [rng.choice(letters)] if how < 2 else []
    return "".join(x)


def test_bit_parallel_distance(rng):
    for _ in range(200):
        a = "".join(rng.choices("abé", k=rng.randint(1, 20)))
        b = "".join(rng.choices("abé", k=rng.randint(0, 20)))
        assert myers(a, b, False)[-1] == distance(a, b)
        best = min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert min(myers(a, b, True)) == best


def test_finds_what_brute_force_finds(rng):
    found = 0
    for _ in range(150):
        items = [(i, "".join(rng.choices("abc ", k=rng.randint(20, 50)))) for i in range(3)]
        pad = "".join(rng.choices("abc ", k=rng.randint(0, 30)))
        text = pad + edited(rng, rng.choice(items)[1], rng.randint(0, 6)) + pad[::-1]
        got = {m[0]: m for m in Finder(items, 8).matches(text)}
        for i, item in items:
            best = min(myers(item, text, True))
            assert (i in got) == (best <= error_budget(len(item), 8))
            if i in got:
                found += 1
                _, a, b, d = got[i]
                assert d == best == distance(item, text[a:b])
    assert found > 50


@pytest.mark.parametrize("shard_bytes", [16 << 20, 100])
def test_documents(spark, frame, odd, rng, shard_bytes):
    items = [(n, "".join(rng.choices("abcdefgh ", k=80 + n))) for n in range(6)]
    own = [*items, (6, items[0][1]), (7, ""), (8, None), (None, "x" * 30)]
    bench = spark.createDataFrame(own, "item_id long, text string").withColumn("doc_id", F.lit(1))
    docs = [
        (10, "pre " + items[0][1] + " post"),
        (11, "é" * 40 + edited(rng, items[1][1], 4, "xyz") + "ü"),
        (12, edited(rng, items[2][1], 30, "xyz")),
        (13, items[3][1][:60]),
        (14, "word " * 100_000 + items[4][1]),
        (15, items[5][1]),
        (15, items[5][1]),
        (None, items[5][1]),
        (16, "x" * 30),
    ] + odd
    got = contaminated(frame(docs), bench, shard_bytes=shard_bytes).collect()
    pairs = sorted(((r.doc_id or 0), (r.item_id if r.item_id is not None else -1)) for r in got)
    assert pairs == [(0, 5), (10, 0), (10, 6), (11, 1), (14, 4), (15, 5), (15, 5), (16, -1)]
    for r in got:
        if r.doc_id == 10:
            assert (r.start, r.end, r.distance) == (4, 4 + len(items[0][1]), 0)
    text = frame(docs)
    kept = text.where(~holds_item(F.col("text"), bench, shard_bytes=shard_bytes))
    assert kept.columns == text.columns
    assert kept.count() == len(docs) - 7


def test_unfold_gives_the_places_in_the_text(rng):
    for _ in range(300):
        text = "".join(rng.choices(["a", "B", "ß", "İ", "ﬃ", "é", " ", "\n", "\t ", "\u00a0"], k=rng.randint(1, 30)))
        short = fold(text)
        assert short == fold(short) == fold(text.upper()) or "İ" in text
        for (a, b), (start, end) in zip(all_spans := [(i, j) for i in range(len(short) + 1) for j in range(i, len(short) + 1)],
                                        unfold(text, all_spans), strict=True):
            assert 0 <= start <= end <= len(text) and (a == b) == (start == end)
            assert short[a:b].strip() in fold(text[start:end])
        assert not short or unfold(text, [(0, len(short))]) == [(len(text) - len(text.lstrip()), len(text.rstrip()))]


def test_upper_cased_and_rewrapped_passages(spark, frame, rng):
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(25)]
    item = " ".join([*words, "die Straße", *words[::-1]])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    edits = edited(rng, item, error_budget(len(item), 5) // 2, "xyz")
    passages = {
        10: item.upper(),
        11: item.replace(" ", "\n"),
        12: item.replace(" ", " \r\n\t  "),
        13: item.title().replace(" ", "\n   "),
        14: edits.upper().replace(" ", "  "),
    }
    docs = [(i, f"Ein  Anfang\n\n{x}\n ENDE ") for i, x in passages.items()]
    docs += [(20, "\n".join(words).upper()), (21, " \n "), (22, None)]
    got = {r.doc_id: r for r in contaminated(frame(docs), bench).collect()}
    assert got.keys() == passages.keys() and {r.item_id for r in got.values()} == {1}
    for i, text in docs[:4]:
        assert (text[got[i].start : got[i].end], got[i].distance) == (passages[i], 0)
    assert got[14].distance <= error_budget(len(fold(item)), 5)
    assert fold(dict(docs)[14][got[14].start : got[14].end]) in fold(dict(docs)[14])
    kept = frame(docs).where(~holds_item(F.col("text"), bench))
    assert {r.doc_id for r in kept.collect()} == {20, 21, 22}


def test_empty_tables(spark, frame):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = frame([(1, "some text")])
    assert contaminated(docs, items).count() == 0
    assert docs.where(~holds_item(F.col("text"), items)).count() == 1
    assert contaminated(docs.limit(0), docs.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
