"""The URL filter against a plain search through all rules, by the trie and by the join."""

import itertools

import pytest
from llm_cases import lower

from waybill.llm import url_filter

HOSTS = ["net", "example.net", "a.example.net", "example.com", "org", "co", ""]
PATHS = ["", "/", "/en/", "/en", "/de/", "/en/x", "/e", "en/"]
ROWS = [None, "", "plain", "://", "http://", "HTTP://EXAMPLE.Net/en/", "http://example.net",
        "http://example.net?x=/en/", "http://example.net/EN/", "http://xexample.net/en/",
        "http://.net/", "http://net./", "http://a.example.net:80/", "http://me@example.net/en/x",
        "http://a..net//en/", "x://y://z", "http://example.com/de/#://", "ftp://fr.org/fr/a/b",
        "http://Ünï.org/fr/", "http://net/en\nx/", "http://" + "a." * 300 + "net/" + "en/" * 5000]


def plain(url, rules, default):
    """(host, path, rule, verdict)."""
    rest = (url or "").partition("://")[2]
    host = rest
    for c in "/?#":
        host = host.partition(c)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.partition(c)[0]
    host = lower(host)
    fits = [(len(h.split(".")) if h else 0, len(p), v, h + p) for h, p, v in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, verdict, rule = max(fits, default=(0, 0, default, None))
    return host, path, rule, verdict


def table(spark, urls):
    return spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(urls)],
                                 "page_id long, url string, host string, rule string, row string")


def judged(spark, urls, rules, default="allow", **options):
    out = url_filter.judge(table(spark, urls), rules, default, **options)
    assert out.columns == ["row", "host", "path", "rule", "verdict"]
    got = {r.row.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    return [got[i] for i in range(len(urls))]


@pytest.mark.parametrize("most", [url_filter.MOST_RULES, 0], ids=["trie", "join"])
@pytest.mark.parametrize("default", ["allow", "block"])
def test_judge_is_a_plain_search(spark, most, default):
    rules = [(h, p, v) for i, (h, p) in enumerate(itertools.product(HOSTS, PATHS))
             for v in ("allow", "block", "both")[i % 3:i % 3 + 1]]
    rules = [(h, p, x) for h, p, v in rules for x in (("allow", "block") if v == "both" else (v,))]
    urls = [*ROWS, *(f"http://{h}{p}{t}" for h in [*HOSTS, "b.co", "x.y.org"] for p in PATHS
                     for t in ("", "?q", "z", "/"))]
    urls += urls[:7]
    for chosen in (rules, rules[::5], url_filter.RULES, []):
        assert judged(spark, urls, chosen, default, most_rules=most) == [
            plain(u, chosen, default) for u in urls]


def test_rules_may_be_a_table(spark):
    rules = spark.createDataFrame([("NET", None, "block"), (None, "/", "block")],
                                  url_filter.RULE_SCHEMA)
    assert [x[2:] for x in judged(spark, ["http://a.net", "http://a.org/"], rules)] == [
        ("net", "block"), (None, "allow")]
    with pytest.raises(ValueError, match="neither"):
        url_filter.judge(table(spark, []), [("net", "/", "deny")])
    with pytest.raises(ValueError, match="neither"):
        url_filter.judge(table(spark, []), [("net", "/", None)])


def test_allowed_keeps_rows_and_empty_tables(spark):
    pages = table(spark, ["http://a.net/", "http://a.org/", "http://a.org/", None])
    out = url_filter.allowed(pages)
    assert out.columns == pages.columns
    assert sorted(r.page_id for r in out.collect()) == [1, 2, 3]
    assert url_filter.allowed(pages.limit(0)).collect() == []


def test_html_does_not_go_to_python(spark):
    pages = table(spark, ["http://a.net/"]).selectExpr("page_id", "url", "repeat('x', 100) html")
    plan = url_filter.judge(pages)._jdf.queryExecution().executedPlan().toString()
    (call,) = [x for x in plan.splitlines() if "ArrowEvalPython" in x]
    assert "html" not in call.partition("match(")[2].partition(")")[0]
