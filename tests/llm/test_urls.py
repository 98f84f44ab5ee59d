import re

from barloom.llm import urls
from barloom.llm.queries import URL_RULES, op1_redirect_equivalence
from tests.llm.conftest import SF

SCHEMA = "page_id long, url string, html string, host string, component string"


def brute(url):
    """Host, path, rule and verdict of one URL."""
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", "", None, None
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in found[1])
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and found[2].startswith(p)]
    return host, found[2], *(max(fits)[1:] if fits else (None, None))


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "x", "y") for k, u, h in rows], SCHEMA)


def test_query_equals_brute_force_where_a_rule_fits(spark):
    table = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    rows = op1_redirect_equivalence(spark, SF).collect()
    assert len(rows) == len(table)
    for r in rows:
        host, path, rule, said = brute(table[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (said or r.alias_verdict or "allow")


def test_rules_and_odd_urls(spark):
    odd = ["http://A.NET/x", "x://net", "x://net/", "a://b.example.net/en/1", "a://example.net/en", "b://Ä.ORG/fr/?q", "://org/fr/", "org/fr/", "", None]
    odd += ["http://notnet/", "http://x.org/fr/a#b", "http://h?q=http://z.net/", "a\nb://x.example.com/de/"]
    got = {r.page_id: r for r in urls.judged(pages(spark, [(k, u, None) for k, u in enumerate(odd)]), URL_RULES).collect()}
    for k, url in enumerate(odd):
        host, path, rule, said = brute(url)
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, rule, said or "allow"), url


def canonical(to):
    return f'<html><head><link href="{to}" rel="canonical"></head>'


def test_decisions_reach_aliases_and_allow_comes_first(spark):
    rows = [
        (1, "http://a.com/x", canonical("http://b.net/y")),  # blocked through its target
        (2, "http://c.com/q#f", "<META http-equiv='refresh' content=\"0; url=/z\">"),
        (3, "http://C.com/z", canonical("w")),
        (4, "http://c.com/w", canonical("http://q.example.com/de/")),  # a chain of three
        (5, "http://d.com/1", canonical("http://e.net/")),
        (6, "http://d.com/2", canonical("//d.com/1")),
        (7, "http://d.com/3", canonical("http://f.org/fr/")),
        (8, "http://g.com", canonical("http://g.com/?a=1&amp;b=2")),
        (9, "http://h.com/", canonical("mailto:x@y.net")),
        (10, "http://e.net/", None),
        (6, "http://d.com/2", ""),
    ]
    df = pages(spark, rows)
    verdicts = {r.page_id: r.verdict for r in urls.judged(df, URL_RULES).collect()}
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow", 9: "allow", 10: "block"}
    more = spark.createDataFrame([("http://d.com/3", "http://d.com/2"), (None, "http://d.com/2")], "src string, dst string")
    verdicts = {r.page_id: r.verdict for r in urls.judged(df, URL_RULES, more).collect()}
    assert verdicts[5] == verdicts[6] == verdicts[7] == "allow" and verdicts[10] == "block"  # its own rule stays


def test_empty_table_and_plan_without_python(spark):
    assert urls.judged(pages(spark, [(1, "a://b", "c")]).limit(0), URL_RULES).collect() == []
    text = op1_redirect_equivalence(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
