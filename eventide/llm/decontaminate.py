"""Benchmark decontamination by pigeonhole edit matching (operator 6).

An item with an error budget of k edits is split into k + 1 pieces. A passage within k edits of the item has at
least one piece unchanged, so an Aho-Corasick automaton of all pieces finds every place where an item may be.
Myers' bit-parallel algorithm then gives the least edit distance between the item and any passage there.
All this is done twice, on the characters as they are and without case and with every run of white space as one
space; neither finds all that the other does, as a word taken out leaves one space more.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from eventide.llm.arrow import pieces
from eventide.llm.frames import give_back, kept, map_batches, two_columns

#: Text of the items of a shard; their automata take some hundred times as much in a worker.
SHARD_BYTES = 1 << 20
SCHEMA = "doc_id long, item_id long, start long, end long, distance int"


def error_budget(length: int, percent: int) -> int:
    return length * percent // 100


def fold(text: str) -> str:
    """The text without case, its runs of white space as one space each, and none at its ends."""
    return " ".join(text.casefold().split())


def unfold(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where spans of `fold(text)` are in the text itself."""
    begins, ends = [], []  # of each folded character
    for word in re.finditer(r"\S+", text):
        if begins:
            begins.append(ends[-1])
            ends.append(word.start())
        places = range(word.start(), word.end())
        if len(word[0].casefold()) > len(word[0]):  # such as a sharp s, which is two characters then
            places = [i for i in places for _ in text[i].casefold()]
        begins.extend(places)
        ends.extend(i + 1 for i in places)
    begins.append(len(text))
    return [(begins[a], ends[b - 1] if b > a else begins[a]) for a, b in spans]


@dataclass
class Finder:
    """The pieces of some items as an automaton."""

    items: list[tuple[int, str]]
    percent: int

    def __post_init__(self):
        entries = defaultdict(list)
        for n, (_, text) in enumerate(self.items):
            parts = error_budget(len(text), self.percent) + 1
            cuts = [len(text) * i // parts for i in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                entries[text[a:b]].append((n, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in entries.items():
            self.automaton.add_word(piece, (len(piece), where))
        if entries:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, distance) of the best passage for each item within its budget."""
        if not self.items:
            return []
        starts = defaultdict(set)
        for last, (size, where) in self.automaton.iter(text):
            for n, offset in where:
                starts[n].add(last + 1 - size - offset)
        out = []
        for n, places in starts.items():
            item_id, item = self.items[n]
            best = None
            budget = error_budget(len(item), self.percent)
            exact = next((s for s in sorted(places) if s >= 0 and text.startswith(item, s)), None)
            if exact is not None:
                best = (0, exact, exact + len(item))
            else:
                for a, b in _windows(sorted(places), len(item), budget, len(text)):
                    found = best_passage(item, text, a, b, budget)
                    if found and (best is None or found < best):
                        best = found
            if best:
                out.append((item_id, best[1], best[2], best[0]))
        return out


class FoldingFinder:
    """The passages of some items as they are and as they are folded, the nearer one for each item."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.items = items
        self.plain = Finder([(n, text) for n, (_, text) in enumerate(items)], percent)
        folded = ((n, fold(text)) for n, (_, text) in enumerate(items))
        self.folded = Finder([(n, text) for n, text in folded if text], percent)

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        best = {n: (distance, a, b) for n, a, b, distance in self.plain.matches(text)}
        found = self.folded.matches(fold(text))
        found = [x for x in found if x[0] not in best or x[3] < best[x[0]][0]]
        places = unfold(text, [(a, b) for _, a, b, _ in found]) if found else []
        best |= {n: (distance, a, b) for (n, _, _, distance), (a, b) in zip(found, places, strict=True)}
        return [(self.items[n][0], a, b, distance) for n, (distance, a, b) in sorted(best.items())]


def _windows(starts: list[int], length: int, budget: int, end: int) -> list[list[int]]:
    """Ranges of the text that hold every passage with one of these starts, put together where they overlap."""
    out: list[list[int]] = []
    for s in starts:
        a, b = max(0, s - budget), min(end, s + length + budget)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _rows(pattern: str) -> dict[str, int]:
    rows: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        rows[c] |= 1 << i
    return rows


def myers(pattern: str, text: str, free_start: bool) -> list[int]:
    """For each prefix of `text`, the distance of the pattern to it, or with `free_start` to a suffix of it."""
    m = len(pattern)
    rows, last, full = _rows(pattern), 1 << (m - 1), (1 << m) - 1
    up, down, score = full, 0, m
    out = [m]
    for c in text:
        equal = rows.get(c, 0)
        x = equal | down
        diagonal = (((equal & up) + up) ^ up) | x
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus = plus << 1 & full | (0 if free_start else 1)
        minus = minus << 1 & full
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        out.append(score)
    return out


def best_passage(item: str, text: str, a: int, b: int, budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the passage of text[a:b] nearest to the item; the first, longest of equals."""
    scores = myers(item, text[a:b], True)
    distance = min(scores)
    if distance > budget:
        return None
    end = a + scores.index(distance)
    low = max(a, end - len(item) - budget)
    back = myers(item[::-1], text[low:end][::-1], False)
    start = end - max(i for i, s in enumerate(back) if s == distance)
    return distance, start, end


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    percent: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The documents that hold a passage of an item, with the best passage for each such item.

    `items` has item_id and text. The budget of an item is `percent` of its characters, rounded down, so one of
    fewer than 100 / percent characters matches exactly. Matching is on characters as they are, and again on those
    that `fold` leaves of item and text, with the budget that goes with them; of the two the least distance counts,
    the former if they are equal. An item that is NULL or empty matches nothing, nor does a NULL text; rows that
    repeat are searched one by one and items of equal text are reported one by one. Spans count characters of the
    text as it is, the end is exclusive.

    Items go to the workers by broadcast, in shards of about `shard_bytes`; each shard is one pass over the
    documents. An item longer than that is a shard of its own.
    """
    texts = two_columns(docs, id_col, text_col)
    found = None
    for shard in _shards(items, shard_bytes):
        one = _search(texts, shard, percent)
        found = one if found is None else found.unionByName(one)
    return found


def holds_item(
    text: Column, items: DataFrame, percent: int = 5, shard_bytes: int = SHARD_BYTES
) -> Column:
    """Whether a text holds a passage of any item; false for NULL. See `contaminated`."""
    spark, found = items.sparkSession, F.lit(False)
    for shard in _shards(items, shard_bytes):
        shared = spark.sparkContext.broadcast((shard, percent))

        found = found | _any_match(shared)(text.cast("string"))
    return found


def _any_match(shared):
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            finder = _finder(shared)
            for texts in batches:
                yield pa.array([bool(t) and bool(finder.matches(t)) for t in texts.to_pylist()], pa.bool_())
        finally:
            give_back()

    return F.arrow_udf(work, "boolean")


def _shards(items: DataFrame, shard_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items that can match, one shard after the other; at least one."""
    own = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna(subset=["text"])
    own = own.where(F.length("text") > 0)
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = total // shard_bytes + 1
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))
    for shard in range(shards):
        rows = own.where(place == shard).collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _search(texts: DataFrame, items: list[tuple[int, str]], percent: int) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast((items, percent))

    def work(batch: pa.RecordBatch):
        finder = _finder(shared)
        for piece in pieces(batch.column(1)):
            ids = batch.column(0).slice(piece.row, len(piece)).to_pylist()
            rows = [
                (ids[i], *match) for i in range(len(piece)) for match in finder.matches(piece.text(i))
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield dict(zip(("doc_id", "item_id", "start", "end", "distance"), columns, strict=True))

    return map_batches(texts, SCHEMA, work)


def _finder(shared) -> FoldingFinder:
    """The automata of a broadcast, built once per task."""
    items, percent = shared.value
    return kept(("finder", id(items)), lambda: FoldingFinder(items, percent))
