"""URL rules that follow redirects and canonical links, with DataFrame functions only.

A rule has a host and a path prefix; it fits the host and its subdomains, and the longest rule that
fits decides. URLs that no rule fits are decided by their aliases: pages linked by redirects or
canonical links are one resource, found as connected components over those edges. If an allow rule
fits a URL of the component, its undecided URLs are allowed (explicit allow takes precedence); else
if a block rule fits one, they are blocked; else they are allowed.

The edges of a page are its canonical link and its refresh target, resolved against its URL; further
redirects can be given as a table. A URL is its own alias whatever its fragment and host case.
Rules are a short list, matched as expressions; a host with any share of all pages only meets
aggregates that combine before the shuffle, and the joins of pages on their URL, which may be split.

Edge cases: a NULL URL or one without "://" has empty host and path, no rule and no alias: allowed.
NULL or empty html has no links. Repeated pages are judged alike; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable
from barloom.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK_TAG = r"(?i)<link\b[^>]*\brel\s*=\s*[\x22']?canonical\b[^>]*>"
REFRESH_TAG = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\x22']?refresh\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*(?:\x22([^\x22]*)\x22|'([^']*)'|([^\s>]+))"
REFRESH_URL = r"(?i)\burl\s*=\s*['\x22]?([^'\x22>\s]+)"


def host_of(url: Column) -> Column:
    """Host after the first "://", A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """Path up to the query or fragment; empty without "://"."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest of ``rules`` (verdict, host, path) that fits; NULL if none.

    Rules of equal length count in the order block before allow, then by name.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, said).otherwise(verdict)
    return name, verdict


def identity(url: Column) -> Column:
    """The URL without fragment, host lower-cased, a bare host with a slash; NULL without "://"."""
    scheme = F.lower(F.regexp_extract(url, r"^((?s:.*?)://)", 1))
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(scheme, host, F.when(path == "", "/").otherwise(path), query))


def resolved(url: Column, target: Column) -> Column:
    """``target`` of a link on the page ``url``: absolute, or relative to scheme, host or folder."""
    target = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"^((?s:.*?):)//", 1)
    root = F.regexp_extract(url, r"^((?s:.*?)://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"^((?s:.*?)://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(folder.endswith("/") & (folder != F.concat(scheme, F.lit("//"))), folder).otherwise(F.concat(root, F.lit("/")))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(root, target))
        .when((target != "") & ~target.startswith("#") & ~target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(folder, target))
    )


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)``: canonical links and refresh targets of every page, as identities."""
    url, html = F.col(url_col), F.col(html_col)

    def first_group(tag: Column, pattern: str, groups: int) -> Column:
        found = [F.regexp_extract(tag, pattern, k) for k in range(1, groups + 1)]
        return F.coalesce(*(F.when(g != "", g) for g in found))

    tags = F.filter(
        F.array(
            first_group(F.regexp_extract(html, LINK_TAG, 0), HREF, 3),
            first_group(F.regexp_extract(html, REFRESH_TAG, 0), REFRESH_URL, 1),
        ),
        lambda t: t.isNotNull(),
    )
    # Most pages have neither tag; a plain search tells.
    marked = pages.filter(html.rlike("(?i)canonical|refresh") & F.contains(url, F.lit("://")))
    targets = marked.select(url.alias("url"), F.explode(tags).alias("target"))
    return targets.select(identity(F.col("url")).alias("src"), identity(resolved(F.col("url"), F.col("target"))).alias("dst")).filter("dst is not null")


def judged(
    pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None, url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, alias_verdict)`` for every page.

    ``redirects`` (src, dst) are further edges between URLs. alias_verdict is what the aliases say,
    NULL where they say nothing.
    """
    edges = links(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(identity(F.col("src")).alias("src"), identity(F.col("dst")).alias("dst")))
    edges = durable(edges.distinct())
    url = F.col(url_col)
    host, path = host_of(url), path_of(url)
    name, said = longest_rule(host, path, rules)
    rows = pages.select(
        "page_id", host.alias("host"), path.alias("path"), name.alias("rule"), said.alias("said"), identity(url).alias("_url")
    )
    members = connected_components(edges)
    name, said = longest_rule(host_of(F.col("node")), path_of(F.col("node")), rules)
    # Every URL of a component counts, crawled or not; flags combine before the shuffle.
    verdicts = (
        members.withColumn("said", said)
        .groupBy("component")
        .agg(
            F.coalesce(F.bool_or(F.col("said") == "allow"), F.lit(False)).alias("allowed"),
            F.coalesce(F.bool_or(F.col("said") == "block"), F.lit(False)).alias("blocked"),
        )
        .withColumn("alias_verdict", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block"))
    )
    aliases = members.join(verdicts, "component").select(F.col("node").alias("_url"), "alias_verdict")
    return rows.join(aliases, "_url", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("said", "alias_verdict", F.lit("allow")).alias("verdict"), "alias_verdict"
    )
