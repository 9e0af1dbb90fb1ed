import re

import pytest

from brookhouse.llm.urls import DAMPING, RULES, host_scores, judged, op10_urls
from tests.conftest import SF


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = [(len(t), t, v) for v, t in RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])]
    return max(fits)[1:] if fits else (None, None)


def test_rules_against_plain_python(spark):
    urls = ["http://example.com/en/1", "https://www.example.com/en/x?y", "http://EXAMPLE.com/de/", "http://a.b.example.com/en/", "http://notexample.com/en/", "ftp://x.net/es/a#b",
            "http://x.net/es", "http://net/fr/", "http://com", "http://com/", "http://x.org/en/", "no scheme", "", None, "http://", "http:///path", "http://h?x://y/z", "http://x.com?a/b",
            "://h.com/p", "http://user@Host.com:80/p", "http://x.net/fr/é\n/z"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "cast(null as string) as html", "1 as rule", "2 as trust")
    got = {r.page_id: r for r in judged(df).collect()}
    for i, url in enumerate(urls):
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (verdict or got[i].verdict) and got[i].verdict in ("allow", "block")
    assert got[11].verdict == "allow" and judged(df.limit(0)).count() == 0


def test_propagation_against_plain_python(spark):
    pages = [("good", "allow", ["mid"]), ("good", "allow", []), ("good", None, ["mid", "far"]), ("bad", "block", []), ("shady", None, ["bad", "bad", "mid"]), ("mid", None, ["far"]), ("far", None, []), ("a.far", None, []), ("", "block", ["x"]), ("x.y.z", None, [])]
    df = spark.createDataFrame([(h, s, " ".join(f'<a HREF = "http://{x}/p?q">' for x in out)) for h, s, out in pages], "host string, said string, html string")
    edges = {(h, x) for h, _, out in pages for x in out if h and x != h}
    edges |= {e for h, *_ in pages if h.count(".") > 1 for p in [h.split(".", 1)[1]] for e in ((h, p), (p, h))}
    hosts = {x for e in edges for x in e} | {h for h, *_ in pages if h}
    trust = good = {h: float(h == "good") for h in hosts}
    distrust = bad = {h: float(h == "bad") for h in hosts}
    outs, ins = ({h: sum(e[k] == h for e in edges) for h in hosts} for k in (0, 1))
    for _ in range(300):
        loose, lost = sum(trust[h] for h in hosts if not outs[h]), sum(distrust[h] for h in hosts if not ins[h])
        trust = {h: (1 - DAMPING + DAMPING * loose) * good[h] + DAMPING * sum(trust[a] / outs[a] for a, b in edges if b == h) for h in hosts}
        distrust = {h: (1 - DAMPING + DAMPING * lost) * bad[h] + DAMPING * sum(distrust[b] / ins[b] for a, b in edges if a == h) for h in hosts}
    assert sum(trust.values()) == pytest.approx(1) and sum(distrust.values()) == pytest.approx(1)
    got = {r.host: r for r in host_scores(df).collect()}
    assert set(got) == hosts
    for h in hosts:
        assert (got[h].trust, got[h].distrust) == (pytest.approx(trust[h], abs=2e-4), pytest.approx(distrust[h], abs=2e-4))
    urls = spark.createDataFrame([(k, f"http://{h}/", "".join(f"<a href=http://{x}/>" for x in out)) for k, (h, _, out) in enumerate(pages) if h], "page_id long, url string, html string")
    rules = (("allow", "good/"), ("block", "bad/"))
    verdict = {r.host: r.verdict for r in judged(urls, rules).collect()}
    assert verdict["shady"] == "block" and verdict["mid"] == verdict["far"] == verdict["x.y.z"] == "allow"


def test_query_covers_all_pages(spark):
    rows = op10_urls(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    for r in rows:
        assert r.rule == rule_of(r.host, r.path)[0]


def test_distrust_reaches_the_end_of_a_long_chain(spark, monkeypatch):
    hosts = [f"h{k}" for k in range(21)] + ["bad"]
    pages = [(k, f"http://{h}/", f"<a href='//{after}/x'>") for k, (h, after) in enumerate(zip(hosts, [*hosts[1:], "bad"]))]
    rows = {r.host: r for r in judged(spark.createDataFrame(pages, "page_id long, url string, html string"), (("block", "bad/"),)).collect()}
    assert all(rows[h].verdict == "block" for h in hosts)
    far = [rows[h].distrust for h in hosts[:-1]]
    assert far == sorted(far) and far[0] > 0
    monkeypatch.setattr("brookhouse.llm.urls.ROUNDS", 3)
    with pytest.raises(RuntimeError):
        judged(spark.createDataFrame(pages, "page_id long, url string, html string"), (("block", "bad/"),))


def test_long_html_and_repeated_rows(spark):
    long = "<p>x</p>" * 50_000 + "<a href=http://bad/>"
    rows = [(1, "http://one/", long), (1, "http://one/", long), (2, "http://bad/", None)]
    got = judged(spark.createDataFrame(rows, "page_id long, url string, html string"), (("block", "bad/"),)).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == [(1, "block"), (1, "block"), (2, "block")]
