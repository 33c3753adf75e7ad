"""SQL over the test tables for the operators that it can express at that size."""

from __future__ import annotations

#: A word, as the operators take it, and the words of each document in order.
WORD = r"[^\x20\x09-\x0D]+"
_WORDS = f"""words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS w, text FROM documents
)"""


def _runs(n: int, words: str = "words") -> str:
    """Every run of n words: document, place of its first word from 1, and the run as a list."""
    return f"""SELECT doc_id, i, list_slice(w, i, i + {n - 1}) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM {words} WHERE len(w) >= {n})"""


URLS = """WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), named AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), rules(rule_host, rule_path, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, max_by(rule_host || rule_path, len(rule_host || rule_path)) AS rule,
    max_by(action, len(rule_host || rule_path)) AS action
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
-- No page of the tables declares a canonical link or a refresh, so no URL has an alias.
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM named LEFT JOIN fits USING (page_id)"""

CLASSES = f"""WITH RECURSIVE {_WORDS.replace("text, '", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '")},
sets AS (
  SELECT DISTINCT doc_id, g FROM ({_runs(3)})
  UNION ALL SELECT doc_id, w FROM words WHERE len(w) BETWEEN 1 AND 2
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, b FROM reached JOIN links ON other = a
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN sizes USING (doc_id) GROUP BY 1"""

REPEATS = f"""WITH {_WORDS},
runs AS ({_runs(20)}),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS place FROM runs)
  WHERE place > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
marks AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM words LEFT JOIN marks USING (doc_id)"""

MIDDLE = r"""WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents
), drawn AS (
  SELECT doc_id, text, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a,
    CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:least(a, b)], '') AS p,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""


def _level(name: str, below: str) -> str:
    """One level of all trees: runs of 16 nodes, in trees of several, with what stands beside each node."""
    return f"""{name}_runs AS (
  SELECT tree, i // 16 AS i, list(node ORDER BY i) AS run FROM {below}
  WHERE tree IN (SELECT tree FROM {below} WHERE i = 1) GROUP BY ALL
), {name} AS (SELECT tree, i, run, sha256(array_to_string(run, '')) AS node FROM {name}_runs)"""


def _ascent(leaves: str, name: str, levels: int) -> str:
    """Levels from `leaves` (tree, i, node) on, and for each leaf the siblings before and after it on each."""
    steps = [_level(f"{name}{k}", leaves if k == 1 else f"{name}{k - 1}") for k in range(1, levels + 1)]
    joins, pairs = [], []
    for k in range(1, levels + 1):
        at = f"(l.i // {16 ** (k - 1)}) % 16"
        joins.append(f"LEFT JOIN {name}{k} x{k} ON x{k}.tree = l.tree AND x{k}.i = l.i // {16**k}")
        pairs.append(
            f"CASE WHEN x{k}.run IS NOT NULL THEN {{'l': array_to_string(x{k}.run[1:{at}], ''), "
            f"'r': array_to_string(x{k}.run[{at} + 2:], '')}} END"
        )
    top = "coalesce(" + ", ".join(f"(SELECT any_value(node) FROM {name}{k} y WHERE y.tree = l.tree AND y.i = 0 AND "
        f"NOT EXISTS (SELECT 1 FROM {name}{k} z WHERE z.tree = l.tree AND z.i = 1))" for k in range(1, levels + 1)) + ", l.node)"
    paths = f"""{name}_paths AS (
  SELECT l.*, list_filter([{", ".join(pairs)}], lambda x: x IS NOT NULL) AS path, {top} AS top FROM {leaves} l
  {" ".join(joins)}
)"""
    return ",\n".join([*steps, paths])


_FIELDS = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in [*_FIELDS, text]) + ")"


def _folded(node: str, path: str) -> str:
    """The hash of a node between its siblings, step by step."""
    steps = f"list_transform({path}, lambda x: [x.l, x.r])"
    return f"list_reduce({steps}, lambda s, x: [sha256(x[1] || s[1] || x[2])], [{node}])[1]"


MANIFEST = f"""WITH rows AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, {_leaf("text")} AS node, {_leaf(
    "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed,
    -- CRC-32 bit by bit
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda s, c: list_reduce(range(8), lambda t, b: xor(t >> 1, (t & 1) * 3988292384), xor(s, c)), 4294967295),
      4294967295) % 5 = 0 AS hit FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS i FROM rows
),
{_ascent("leaves", "low", 5)},
tops AS (
  SELECT '' AS tree, tree AS name, any_value(top) AS node, row_number() OVER (ORDER BY tree) - 1 AS i
  FROM low_paths GROUP BY low_paths.tree
),
{_ascent("tops", "high", 3)},
whole AS (
  SELECT doc_id, p.node AS leaf, p.top AS subroot, h.top AS root, list_concat(p.path, h.path) AS path,
    CASE WHEN hit THEN changed ELSE p.node END AS used FROM low_paths p JOIN high_paths h ON h.name = p.tree
), folded AS (SELECT *, {_folded("used", "path")} AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified FROM folded"""

#: By operator query. The others compress, merge byte pairs, count tokens, vote on
#: bits of hashes or search by edit distance.
ORACLES: dict[str, str] = {
    "op1_url_filter": URLS,
    "op5_ngram_join": CLASSES,
    "op8_substring_dedup": REPEATS,
    "op12_fill_in_middle": MIDDLE,
    "op13_merkle_manifest": MANIFEST,
}
