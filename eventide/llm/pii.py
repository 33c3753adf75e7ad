"""Personal data, with information-theoretic sanitisation (operator 9).

Protected entities are the e-mail addresses, IP addresses, card and phone numbers in the texts. How much a term
tells about an entity is estimated from the whole corpus: of the lines that hold the term, the share that hold
the entity, made less by how few different lines tell of it. Minus its logarithm is how many bits about the
entity are left to who knows the term: none if the term stands nowhere else, on many different lines. Lines next to an
entity's own can count as its lines. The share does not depend on how many lines without the term there are. In
documents that hold the entity, terms from one threshold on are generalised, and from a higher one on removed. Only
DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from eventide.llm.frames import two_columns
from eventide.storage import materialize

#: Kinds in their order, with patterns. Matches can't begin inside what an earlier match could have taken, so
#: the patterns look behind instead of trying every place, and quantifiers don't give back.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without these has no match, which is cheaper to find out.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
TERM = r"\p{L}{3,}"
#: Short words, names and numbers as well.
ANY_TERM = r"[\p{L}\p{N}]+"
#: Matches that are placed together at least.
GROUP = 64
SPAN = "struct<start:int,kind:int,end:int,match:string>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once, wherever and how often it is used."""
    return F.transform(F.array(value), use)[0]


def spans(text: Column, pattern: Column, kind: Column) -> Column:
    """All matches of a pattern with their places in characters, from the lengths of what is between them.

    An array grows by copying it, so matches are taken in groups of about the root of their number: the lengths of
    whole groups give the place where each begins, and within it places are added up.
    """
    between, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    none = F.array().cast(f"array<{SPAN}>")

    def length(x: Column) -> Column:
        return F.length(x["between"]) + F.length(x["match"])

    def add(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["between"])
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    def of_group(group: Column, at: Column) -> Column:
        return F.aggregate(group, F.struct(at.alias("at"), none.alias("out")), add)["out"]

    def starts(groups: Column) -> Column:
        def next_start(done: Column, group: Column) -> Column:
            end = F.aggregate(group, F.element_at(done, -1), lambda n, x: n + length(x))
            return F.concat(done, F.array(end))

        return F.slice(F.aggregate(groups, F.array(F.lit(0)), next_start), F.lit(1), F.size(groups))

    def placed(found: Column) -> Column:
        n = F.size(found)
        step = F.greatest(F.lit(GROUP), F.ceil(F.sqrt(n)).cast("int"))
        groups = F.transform(F.sequence(F.lit(1), n, step), lambda i: F.slice(found, i, step))
        each = let(groups, lambda g: F.zip_with(g, starts(g), of_group))
        return F.when(n > 0, F.flatten(each)).otherwise(none)

    zipped = F.arrays_zip(between.alias("between"), matches.alias("match"))
    # What is after the last match has none.
    return let(zipped, lambda z: let(F.filter(z, lambda x: x["match"].isNotNull()), placed))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        # A part with many digits is larger than any allowed one: compare without leading zeros.
        small = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "").rlike(
            "^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
        )
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return passes_luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _validity(kind: str):
    return lambda s: _valid(kind, s["match"])


def _of_kind(n: int):
    return lambda s: s["kind"] == n


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds by start, then kind."""
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for n, kind in enumerate(KINDS):
        own = spans(text, F.lit(PATTERNS[kind]), F.lit(n))
        valid = F.filter(own, _validity(kind))
        found.append(F.when(text.rlike(HINTS[kind]), valid).otherwise(none))
    return F.array_sort(F.concat(*found))


def _written(found: Column, names: list[str]) -> Column:
    kinds = F.array(*map(F.lit, names))
    one = lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(found, one))


def _terms(line: Column, term: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(term), F.lit(0)))


def _without_matches(line: Column) -> Column:
    """A line without what looks like an entity, valid or not."""
    for kind in KINDS:
        line = F.when(line.rlike(HINTS[kind]), F.regexp_replace(line, PATTERNS[kind], " ")).otherwise(line)
    return line


def entity_lines(base: DataFrame, around: int) -> DataFrame:
    """(bare, near): each line that an entity is on, or is at most `around` lines away from, and all these entities."""
    entities = lambda line: F.array_distinct(F.transform(base_spans(line), lambda s: F.lower(s["match"])))
    lines = F.split("text", "\n")

    def near(own: Column, i: Column) -> Column:
        first = F.greatest(i - around, F.lit(0))
        return F.array_distinct(F.flatten(F.slice(own, first + 1, i + around - first + 1)))

    def each(own: Column) -> Column:
        both = F.zip_with(lines, F.transform(own, lambda _, i: near(own, i)), lambda x, n: F.struct(x.alias("line"), n.alias("near")))
        return F.filter(both, lambda x: F.size(x["near"]) > 0)

    held = base.select(F.explode(let(F.transform(lines, entities), each)).alias("x"))
    return held.select(_without_matches(F.col("x.line")).alias("bare"), F.col("x.near").alias("near"))


def disclosing_terms(
    base: DataFrame, texts: DataFrame, generalise_at: float, min_support: int, around: int, doubt: float, term: str
) -> DataFrame:
    """(entity, term, share) from `generalise_at` on.

    `base` has texts with entities. Of the c(t) lines of all texts with the term, c(t, e) are lines of the entity, on n
    different ones: the share is c(t, e) / c(t) * n / (n + doubt). Copies of a line are one line in n, and a pair on fewer
    than `min_support` different lines is none.
    """
    lines = materialize(entity_lines(base, around), "pii-lines")
    terms = lines.select(
        F.xxhash64("bare").alias("mark"), F.explode("near").alias("entity"), _terms(F.col("bare"), term).alias("terms")
    )
    both = terms.select("entity", "mark", F.explode("terms").alias("term"))
    both = both.groupBy("entity", "term", "mark").agg(F.count("*").alias("times"))
    both = both.groupBy("entity", "term").agg(F.sum("times").alias("c_te"), F.count("*").alias("support"))
    both = materialize(both.where(F.col("support") >= min_support), "pii-pairs")
    every = texts.select(F.explode(F.split("text", "\n")).alias("line"))
    counted = every.select(F.explode(_terms(F.col("line"), term)).alias("term")).groupBy("term").agg(F.count("*").alias("c_t"))
    counted = materialize(counted.join(both.select("term").distinct(), "term", "left_semi"), "pii-terms")
    sure = F.col("support") / (F.col("support") + F.lit(float(doubt)))
    shares = both.join(counted, "term").select("entity", "term", (sure * (F.col("c_te") / F.col("c_t"))).alias("share"))
    return shares.where(F.col("share") >= generalise_at)


def find_personal(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    generalise_at: float = 0.5,
    remove_at: float = 0.75,
    min_support: int = 1,
    around: int = 0,
    doubt: float = 1.0,
    term: str = TERM,
) -> DataFrame:
    """Counts of base matches, spans and the sanitised text; one row per row of `docs`.

    `spans` adds to the base spans those of kind term, which are generalised to [TERM] (from `generalise_at` on; a half
    leaves one bit), and of kind quasi, which are removed (from `remove_at` on); entities become [EMAIL], [IP], [CARD] and [PHONE]. Spans count characters, the end is
    exclusive, and a term inside a base span is part of that. `term` is the pattern of a term; for `min_support`
    and `doubt` see `disclosing_terms`, for `around` `entity_lines`. A NULL or empty text has no spans. Rows of
    one id count as one document; a row without an id gets base spans only. An empty table gives an empty
    result, and only the two named columns are read.
    """
    texts = two_columns(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    found = texts.select("doc_id", "text", base_spans(F.col("text")).alias("found"))
    base = materialize(found.withColumn("personal", F.size("found") > 0), "pii-base")
    own = base.where("personal")
    shares = materialize(disclosing_terms(own, texts, generalise_at, min_support, around, doubt, term), "pii-shares")
    named = F.array_distinct(F.transform("found", lambda s: F.lower(s["match"])))
    held = own.where("doc_id is not null").select("doc_id", F.explode(named).alias("entity")).distinct()
    worst = held.join(shares, "entity").groupBy("doc_id", "term").agg(F.max("share").alias("share"))
    by_doc = worst.groupBy("doc_id").agg(
        *(
            F.concat_ws("|", F.sort_array(F.collect_list(F.when(when, F.col("term"))))).alias(name)
            for name, when in (("term", F.col("share") < remove_at), ("quasi", F.col("share") >= remove_at))
        )
    )
    with_terms = own.join(by_doc, "doc_id", "left")
    none = F.array().cast(f"array<{SPAN}>")
    added = []
    letter = r"\p{L}" if term == TERM else r"[\p{L}\p{N}]"
    for n, name in ((4, "term"), (5, "quasi")):
        pattern = F.concat(F.lit(rf"(?iu)(?<!{letter})(?:"), F.col(name), F.lit(rf")(?!{letter})"))
        some = spans(F.col("text"), pattern, F.lit(n))
        added.append(F.when(F.coalesce(F.col(name), F.lit("")) != "", some).otherwise(none))
    outside = lambda t: ~F.exists("found", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"]))
    every = F.array_sort(F.concat("found", F.filter(F.concat(*added), outside)))
    with_terms = with_terms.select("doc_id", "text", "found", every.alias("every"))
    rest = base.where("not personal").select("doc_id", "text", "found", F.col("found").alias("every"))
    counts = [
        F.size(F.filter("found", _of_kind(n))).cast("long").alias(f"n_{kind}")
        for n, kind in enumerate(KINDS)
    ]
    names = [*KINDS, "term", "quasi"]
    return rest.unionByName(with_terms).select(
        "doc_id",
        *counts,
        F.sha2(_written(F.col("found"), names), 256).alias("base_sha256"),
        _written(F.col("every"), names).alias("spans"),
        _sanitised(F.col("text"), F.col("every")).alias("sanitised"),
    )


def _sanitised(text: Column, found: Column) -> Column:
    """The text with every span replaced; where spans overlap, the first counts."""
    signs = F.array(*map(F.lit, ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]", ""]))

    def add(done: Column, s: Column) -> Column:
        kept = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        return F.when(s["start"] < done["at"], done).otherwise(
            F.struct(s["end"].alias("at"), F.concat(done["out"], kept, signs[s["kind"]]).alias("out"))
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(found, begin, add)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
