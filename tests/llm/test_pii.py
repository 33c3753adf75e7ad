import hashlib
import re
import time
from collections import Counter, defaultdict

import pyspark.sql.functions as F
import regex

from eventide.llm.pii import ANY_TERM, HINTS, KINDS, PATTERNS, base_spans, find_personal
from tests.llm.brute import personal
from tests.llm.conftest import DOCS

PARTS = ["a", "b.", "@", "@x.y", ".com", "1", "2", "25", "255", "256", ".", "..", "-", " ", "+", "+1", "(", "é", "😀",
         "\n", "_", "%", "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "10.0.0.1", "00", "٣"]

KIND_ORDER = {k: i for i, k in enumerate([*KINDS, "term", "quasi"])}


def test_base_spans_are_those_of_the_patterns(spark, rng):
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += ["", "1" * 50_000, "a" * 50_000 + "@b.c", "1 " * 30_000, "a." * 30_000, "+" * 1000, "1.1.1.300.4.5.6.7"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.f for r in frame.select("i", base_spans(F.col("t")).alias("f")).collect()}
    found = 0
    for i, text in enumerate(texts):
        own = [(s.start, KINDS[s.kind], s.end) for s in got[i]]
        found += len(own)
        assert own == personal(text), text[:200]
        assert all(s.match == text[s.start : s.end] for s in got[i])
    assert found > 2000


def bare(line):
    for kind in KINDS:
        line = regex.sub(PATTERNS[kind], " ", line) if regex.search(HINTS[kind], line) else line
    return line


def expected_terms(rows, share_from, support, around, word):
    """doc id -> term -> share of the term's lines that are lines of an entity, less by how few of them differ."""
    in_lines, both, marks, holders = Counter(), Counter(), defaultdict(set), defaultdict(set)
    for i, text in rows:
        lines = (text or "").split("\n")
        entities = [{x[s:e].lower() for s, _, e in personal(x)} for x in lines]
        for n, line in enumerate(lines):
            in_lines.update(set(re.findall(word, line.lower())))
            for e in entities[n]:
                holders[e].add(i)
            for e in set().union(*entities[max(0, n - around) : n + around + 1]):
                for t in set(re.findall(word, bare(line).lower())):
                    both[e, t] += 1
                    marks[e, t].add(bare(line))
    out = defaultdict(dict)
    for (e, t), c in both.items():
        n = len(marks[e, t])
        share = n / (n + 1) * (c / in_lines[t])
        if n >= support and share >= share_from:
            for i in holders[e]:
                out[i][t] = max(share, out[i].get(t, 0))
    return out


def check(got, own, terms, remove_at, letter):
    for i, text in own:
        base = personal(text)
        spans = list(base)
        for t, share in terms.get(i, {}).items():
            for m in re.finditer(rf"(?i)(?<!{letter}){t}(?!{letter})", text):
                if not any(m.start() < e and s < m.end() for s, _, e in base):
                    spans.append((m.start(), "quasi" if share >= remove_at else "term", m.end()))
        assert got[i].spans == ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], KIND_ORDER[x[1]])))
        digest = ",".join(f"{k}:{s}:{e}" for s, k, e in base)
        assert got[i].base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(x == k for _, x, _ in base) for k in KINDS]


def test_terms_that_tell_of_an_entity_are_found_in_its_documents(frame, rng):
    own = []
    for i in range(40):
        words = " ".join(f"w{'abcdefghij'[rng.randrange(10)] * 3}" for _ in range(12))
        own.append((i, f"{words} the end\nnothing of note here {words}\n" + "plain line\n" * rng.randint(0, 3)))
    for i in range(4):
        own.append((100 + i, f"line {'abcd'[i] * 4} the Quasar of zed@Mail.example.org, said Quasarish\nquasar again\nthe"))
    for i in range(8):
        own.append((200 + i, f"{'the nebula' if i < 7 else 'nebula'} {'abcdefgh'[i] * 4}" + (" 10.0.0.7" if i < 6 else "")))
    own += [(300, "copy alone +1 (386) 555-3733"), (301, "copy alone +1 (386) 555-3733"), (302, "copy alone +1 (386) 555-3733")]
    docs = frame(own)
    got = {r.doc_id: r for r in find_personal(docs, min_support=3).collect()}
    terms = expected_terms(own, 0.5, 3, 0, r"[^\W\d_]{3,}")
    assert terms[100].keys() == {"said", "quasarish"} and not terms.get(300)  # quasar is on other lines as well
    assert terms[200].keys() == {"nebula"} and terms[100]["said"] >= 0.75 > terms[200]["nebula"]
    check(got, own, terms, 0.75, r"[^\W\d_]")
    assert got[100].sanitised == "line aaaa the Quasar of [EMAIL],  \nquasar again\nthe"
    assert "[TERM]" in got[200].sanitised and got[0].sanitised == own[0][1]


def test_terms_beside_one_address_are_found(frame, rng):
    names = ["abc" * 2, "def" * 3, "Li", "of", "to", "x9", "the"]
    own = [(i, "\n".join(" ".join(rng.choices(names, k=5)) for _ in range(200))) for i in range(20)]
    own.append((100, "the to\nJo Vu of Pax\nticket 90417 to zed@mail.example.org of the\nof Klio\nthe last one, of Jo"))
    own += [(200 + i, f"of to\nthe copy{i} of\nroom 7 at 10.0.0.7 of copy{i}\n\nof") for i in range(9)]
    own += [(300 + i, "to\nhall 9 at 10.0.0.9 of the\nto") for i in range(9)]
    got = {r.doc_id: r for r in find_personal(frame(own), around=1, term=ANY_TERM).collect()}
    terms = expected_terms(own, 0.5, 1, 1, r"[^\W_]+")
    assert terms[100].keys() >= {"vu", "pax", "ticket", "90417", "klio"} and not terms[100].keys() & {"of", "the", "to"}
    assert terms[200]["room"] == terms[200]["7"] == 0.9 and not terms[200].keys() & {"of", "the"}
    assert terms[300]["hall"] == 0.5  # copies of a line are one
    check(got, own, terms, 0.75, r"[^\W_]")
    assert "[TERM] [TERM] to [EMAIL]" in got[100].sanitised


def test_a_verdict_does_not_depend_on_the_size_of_the_corpus(spark):
    text = "Quarterly zucchini for ann@mail.example.org\nthe harvest of the day\n" * 1
    more = [f"note {i} zucchini ann@mail.example.org the {'abcd'[i] * 3}" for i in range(4)]
    verdicts = []
    for size in (1_000, 100_000):
        filler = spark.range(size).selectExpr("1000 + id as doc_id", "concat('the plain line of filler ', id) as text")
        docs = spark.createDataFrame([(1, text), *((2 + i, t) for i, t in enumerate(more))], DOCS).unionByName(filler)
        found = find_personal(docs, around=1, term=ANY_TERM).where("doc_id < 1000")
        verdicts.append({r.doc_id: r.spans for r in found.collect()})
    assert verdicts[0] == verdicts[1]
    own = [x.split(":") for x in verdicts[0][1].split(",")]
    kinds = {text[int(a) : int(b)].lower(): kind for kind, a, b in own}
    assert kinds["zucchini"] == "quasi" and kinds["quarterly"] == "term" and "the" not in kinds


def test_very_many_matches_are_placed_in_seconds(spark):
    text = "a@b.cc 10.0.0.1\n" * 50_000
    frame = spark.createDataFrame([(1, text)], DOCS).select("doc_id", base_spans(F.col("text")).alias("found"))
    begin = time.time()
    found = frame.select(F.size("found").alias("n"), F.element_at("found", -1).alias("last")).first()
    assert found.n == 100_000 and found.last.end == len(text) - 1 and time.time() - begin < 60
    assert find_personal(spark.createDataFrame([(1, text)], DOCS)).select("n_ip").first().n_ip == 50_000


def test_odd_rows_and_whole_texts(frame, rows, odd):
    own = [*rows, *((100_000 + i if i else i, t) for i, t in odd), (None, "x@y.zz"), (900, "me@h.org " * 500)]
    got = find_personal(frame(own)).collect()
    assert len(got) == len(own)
    found = Counter((r.doc_id, r.base_sha256) for r in got)
    expected = Counter()
    for i, text in own:
        digest = ",".join(f"{k}:{s}:{e}" for s, k, e in personal(text))
        expected[i, hashlib.sha256(digest.encode()).hexdigest()] += 1
    assert found == expected


def test_empty_table_and_native_plan(spark, frame):
    assert find_personal(spark.createDataFrame([], DOCS)).count() == 0
    plan = find_personal(frame([(1, "a@b.cc")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
