"""Plain definitions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


class Sets:
    """Union-find whose representatives are the smallest members."""

    def __init__(self, members):
        self.parent = {m: m for m in members}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def shingles(text: str | None, n: int) -> set:
    words = WORD.findall(lower(text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def jaccard_classes(rows: list[tuple[int, str | None]], n: int, percent: int) -> dict:
    """doc_id -> (set size, smallest connected id)."""
    own = {i: shingles(t, n) for i, t in rows}
    holders = defaultdict(list)
    for i, s in own.items():
        for x in s:
            holders[x].append(i)
    found = Sets(own)
    for i, s in own.items():
        for j, common in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * common >= percent * (len(s) + len(own[j]) - common):
                found.join(i, j)
    return {i: (len(s), found.find(i)) for i, s in own.items()}


def substring_dedup(rows: list[tuple[int, str | None]], window: int) -> dict:
    """doc_id -> (words, removed words, digest of the others)."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            own = tuple(words[s : s + window])
            if own in seen:
                gone[s : s + window] = [True] * window
            seen.add(own)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def line_dedup(rows: list[tuple[int, str | None]], edits: int, min_chars: int) -> dict:
    """doc_id -> text without repeated lines."""
    place = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        for n, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                place.setdefault(line, (i, n))
    found = Sets(place)
    long = sorted((x for x in place if len(x) >= min_chars), key=len)
    letters = {x: Counter(x) for x in long}
    for k, x in enumerate(long):
        for y in long[k + 1 :]:
            if len(y) - len(x) > edits:
                break
            if sum(((letters[x] - letters[y]) + (letters[y] - letters[x])).values()) <= 2 * edits:
                if distance(x, y) <= edits:
                    found.join(x, y)
    first: dict = {}
    for x, p in place.items():
        first[found.find(x)] = min(first.get(found.find(x), p), p)
    keep = set(first.values())
    return {
        i: None
        if t is None
        else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) in keep or not WORD.search(x))
        for i, t in rows
    }


def quality_base(text: str | None) -> tuple:
    """(words, their characters, symbols, repeated lines, words in repeated 5-word windows, failed)."""
    text = text or ""
    words = WORD.findall(text)
    times = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = [False] * len(words)
    for i in range(len(words) - 4):
        if times[tuple(words[i : i + 5])] > 1:
            covered[i : i + 5] = [True] * 5
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * sum(covered) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, sum(covered), failed


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of valid matches, by start and then kind."""
    out = []
    for order, (kind, pattern) in enumerate(PERSONAL.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }
            if valid[kind]():
                out.append((m.start(), order, kind, m.end()))
    return [(s, k, e) for s, _, k, e in sorted(out)]


def fingerprint(text: str | None) -> int:
    """Signs of the bit votes of neighbouring words' hashes; 0 without words."""
    words = [w.encode() for w in WORD.findall((text or "").lower())]
    votes = [0] * 64
    for i, w in enumerate(words):
        h = xxhash.xxh64_intdigest(w, seed=42)
        if i + 1 < len(words):
            h = xxhash.xxh64_intdigest(words[i + 1], seed=h)
        for j in range(64):
            votes[j] += 1 if h >> j & 1 else -1
    return sum(1 << j for j in range(64) if votes[j] > 0)


def edited_texts(rows: list[tuple[int, str | None]]) -> dict:
    """doc_id -> the text with its last half replaced from the next document, by descending id."""
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = {}
    for k, (i, text) in enumerate(order):
        half = len(text) // 2
        out[i] = text[: len(text) - half] + order[(k + 1) % len(order)][1][:half]
    return out


def near_classes(prints: dict[int, int | None], radius: int) -> dict:
    """doc_id -> smallest id reachable over fingerprints at most `radius` bits apart."""
    found = Sets(prints)
    some = sorted(i for i in prints if prints[i] is not None)
    for k, i in enumerate(some):
        for j in some[k + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                found.join(i, j)
    return {i: found.find(i) for i in prints}


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_in_middle(doc_id: int | None, text: str | None) -> tuple:
    """(units, form, characters of prefix and middle, output)."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    form = "spm" if d % 100 < 80 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return len(units), form, len(p), len(m), output


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def merkle_paths(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root over some nodes, and the siblings before and after each on every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k - k % fanout
            paths[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + fanout])))
        nodes = [sha("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return nodes[0], paths


def merkle_manifest(rows: list[tuple], fanout: int) -> list[tuple]:
    """(doc_id, leaf, subroot, root, siblings) for rows of (doc_id, source, text)."""
    by_source = defaultdict(list)
    for row in rows:
        values = [None if v is None else str(v) for v in row]
        leaf = sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(by_source[s])
        trees.append((own, *merkle_paths([leaf for *_, leaf in own], fanout)))
    root, tops = merkle_paths([subroot for _, subroot, _ in trees], fanout) if trees else ("", [])
    return [
        (i if known else None, leaf, subroot, root, path + top)
        for (own, subroot, paths), top in zip(trees, tops, strict=True)
        for (known, i, leaf), path in zip(own, paths, strict=True)
    ]
