"""URL filters by redirect equivalence (operator 1).

A rule names a host and the beginning of a path. Where no rule fits a URL, its aliases decide: URLs that
redirects and canonical links tie together are one component, and a rule that fits any of them counts for all that have
none of their own. Only DataFrame functions are used.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from eventide.llm.components import connected_components
from eventide.storage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _behind(url: Column) -> Column:
    """What follows the first ://, NULL without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? or #, with A-Z as a-z; empty without ://."""
    host = F.regexp_extract(_behind(url), r"^([^/?#]*+)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(_behind(url), r"^[^/?#]*+([^?#]*+)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and action, NULL without one; allow wins a tie.

    A rule (action, "host/path") fits the host and its subdomains, if the path starts with the rule's, which
    begins with the slash. The rules are a setting, not data: they become one expression.
    """
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
        name, slash, rest = rule.partition("/")
        fits = (host == name) | host.endswith(f".{name}")
        own = F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))
        found = F.when(fits & path.startswith(slash + rest), own).otherwise(found)
    return found


def node_of(url: Column) -> Column:
    """A URL as a node: without fragment, host in lower case; NULL without ://."""
    scheme = F.translate(F.substring(url, F.lit(1), F.instr(url, "://") - 1), UPPER, LOWER)
    rest = F.regexp_extract(_behind(url), r"^[^/?#]*+([^#]*+)", 1)
    return F.when(_behind(url).isNotNull(), F.concat(scheme, F.lit("://"), host_of(url), rest))


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute; empty if absent."""
    quoted = rf"(?i)[\s\"']{name}\s*=\s*"
    options = [rf'{quoted}"([^"]*+)"', rf"{quoted}'([^']*+)'", rf"{quoted}([^\s\"'>]++)"]
    found = [F.nullif(F.regexp_extract(tag, x, 1), F.lit("")) for x in options]
    return F.replace(F.coalesce(*found, F.lit("")), F.lit("&amp;"), F.lit("&"))


def link_targets(html: Column) -> Column:
    """The URLs that a page declares itself an alias of: canonical links, and refreshes to another URL."""
    links = F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*+>"), F.lit(0))
    canonical = F.filter(links, lambda t: F.lower(_attribute(t, "rel")) == "canonical")
    metas = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*+>"), F.lit(0))
    refresh = F.filter(metas, lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    moved = F.transform(
        refresh, lambda t: F.regexp_extract(_attribute(t, "content"), r"(?i)url\s*=\s*['\"]?([^'\"\s]++)", 1)
    )
    return F.filter(
        F.concat(F.transform(canonical, lambda t: F.trim(_attribute(t, "href"))), moved), lambda x: x != ""
    )


def resolved(base: Column, target: Column) -> Column:
    """A target as written in the page of this URL, made absolute."""
    scheme = F.substring_index(base, "://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*+$", "")
    return (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def judge_pages(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, host, path, rule, verdict and the component's smallest URL; one row per row of `pages`.

    A URL's own rule decides. Without one, its component does: an explicit allow of any alias wins over blocks,
    a block of any alias blocks, and else the URL is allowed. Edges come from the pages' canonical links and
    refreshes, and from `redirects` (source, target). A URL that is NULL or has no :// has no aliases, host or
    path, and is allowed. NULL html declares nothing. Rows that repeat are judged alike, an empty table
    gives an empty result, and other columns are not read.
    """
    own = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    url = F.col("url")
    edges = own.where(F.col("html").isNotNull() & url.contains("://")).select(
        node_of(url).alias("a"), url, F.explode(link_targets(F.col("html"))).alias("target")
    )
    edges = edges.select("a", node_of(resolved(url, F.col("target"))).alias("b"))
    if redirects is not None:
        more = redirects.select(node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b"))
        edges = edges.unionByName(more)
    found = materialize(connected_components(edges), "url-components")
    node = F.col("node")
    action = rule_of(host_of(node), path_of(node), rules)["action"]
    verdicts = found.withColumn("action", action).groupBy("component").agg(
        F.coalesce(F.bool_or(F.col("action") == "allow"), F.lit(False)).alias("any_allow"),
        F.coalesce(F.bool_or(F.col("action") == "block"), F.lit(False)).alias("any_block"),
    )
    verdicts = materialize(verdicts, "url-verdicts")
    aliases = found.join(verdicts, "component").where("any_allow or any_block").select(
        F.col("node").alias("key"), F.when(F.col("any_allow"), "allow").otherwise("block").alias("passed_on")
    )
    aliases = materialize(aliases, "url-aliases")
    # Rows without a node match nothing; their ids keep them apart in the shuffle.
    judged = own.select(
        "page_id",
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.coalesce(node_of(url), F.col("page_id").cast("string")).alias("key"),
    )
    judged = judged.withColumn("own", rule_of(F.col("host"), F.col("path"), rules)).join(aliases, "key", "left")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.action", "passed_on", F.lit("allow")).alias("verdict"),
    )
