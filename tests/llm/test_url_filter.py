import re

import pyspark.sql.functions as F
import pytest

from eventide.llm.catalogue import URL_RULES
from eventide.llm.url_filter import judge_pages, link_targets, resolved

PAGES = "page_id long, url string, html string, key int, rule string, component string"


def judge(spark, rows, **more):
    pages = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], PAGES)
    return {r.page_id: r for r in judge_pages(pages, URL_RULES, **more).collect()}


def canonical(href):
    return f'<html><head><LINK href="{href}" rel="canonical"></head></html>'


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/enx": ("example.net", "/enx", "net/", "block"),
        "http://notexample.net": ("notexample.net", "", None, "allow"),
        "http://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/", "block"),
        "http://myexample.com/de/": ("myexample.com", "/de/", None, "allow"),
        "http://w.org/fr/a?b": ("w.org", "/fr/a", "org/fr/", "allow"),
        "http://w.org?/fr/": ("w.org", "", None, "allow"),
        "a://b.net/://c": ("b.net", "/://c", "net/", "block"),
        "ÀB://É.NET/": ("É.net", "/", "net/", "block"),
        "no scheme.net/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://" + "a" * 50_000 + ".net/" + "b" * 50_000: None,
    }
    got = judge(spark, [(i, u, None) for i, u in enumerate(cases)])
    for i, (url, expected) in enumerate(cases.items()):
        if expected:
            r = got[i]
            assert (r.host, r.path, r.rule, r.verdict) == expected, url
    assert got[len(cases) - 1].verdict == "block"


def test_aliases_inherit_blocks_unless_one_is_allowed(spark):
    rows = [
        (1, "http://a.com/1", canonical("http://a.com/2")),
        (2, "http://a.com/2", canonical("/3")),
        (3, "http://A.com/3#part", '<meta content="0; URL=http://bad.net/x" http-equiv=refresh>'),
        (4, "http://b.com/1", canonical("http://b.net/1")),
        (5, "http://c.org/fr/1", canonical("//b.com/1")),
        (6, "http://d.com/", canonical("d.com")),
        (7, "http://bad.net/y", canonical("http://c.org/fr/1")),
        (8, "http://a.com/1", None),
        (8, "http://a.com/1", None),
        (9, None, canonical("http://bad.net/x")),
        (10, "http://e.com/", canonical("http://b.com/1").replace("canonical", "alternate")),
        (11, "http://f.com/", None),
    ]
    more = spark.createDataFrame([("http://f.com/", "http://bad.net/z"), (None, "http://bad.net/z")], "source string, target string")
    got = judge(spark, rows, redirects=more)
    verdicts = {i: r.verdict for i, r in got.items()}
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block",
                        8: "block", 9: "allow", 10: "allow", 11: "block"}
    assert got[1].rule is None and got[7].rule == "net/"


@pytest.mark.parametrize(
    ("base", "target", "expected"),
    [
        ("http://h.com/a/b?c", "x", "http://h.com/a/x"),
        ("http://h.com", "x", "http://h.com/x"),
        ("https://H.com/a", "/x", "https://h.com/x"),
        ("https://h.com/a", "//o.org/x", "https://o.org/x"),
        ("https://h.com/a", "ftp://o.org", "ftp://o.org"),
    ],
)
def test_targets_are_made_absolute(spark, base, target, expected):
    row = spark.createDataFrame([(base, target)], "b string, t string")
    assert row.select(resolved(F.col("b"), F.col("t")).alias("x")).first().x == expected


def test_links_of_a_page(spark):
    html = (
        "<link rel='stylesheet' href='s.css'><link\nrel=canonical href=/one?a=1&amp;b=2 >"
        '<meta http-equiv="Refresh" content="5;url=\'/two\'"><meta name="refresh" content="url=/no">'
        '<link rel="canonical"><meta http-equiv="refresh" content="30">' + "<link " * 50_000
    )
    row = spark.createDataFrame([(html,), (None,), ("",)], "h string").select(link_targets(F.col("h")).alias("x"))
    assert [r.x for r in row.collect()] == [["/one?a=1&b=2", "/two"], None, []]


def test_empty_table_and_whole_pages(spark):
    assert judge(spark, []) == {}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = judge_pages(pages, URL_RULES).collect()
    urls = {r.page_id: r.url for r in pages.collect()}
    assert len(got) == len(urls)
    for r in got:
        m = re.match(r"[^:]*://([^/?#]*)([^?#]*)", urls[r.page_id])
        assert (r.host, r.path) == (m[1].lower(), m[2])


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", canonical("/x"))], "page_id long, url string, html string")
    plan = judge_pages(pages, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
