import re

import pytest

from flowlake.llm import url_filter

SCHEMA = "page_id long, url string, html string, host string, rule string, links int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash", 1) for i, u, h in rows], SCHEMA)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return host.translate(LOWER), path


def rule_of(host, path):
    best = None
    for verdict, of_host, begin in url_filter.RULES:
        if (host == of_host or host.endswith("." + of_host)) and path.startswith(begin):
            if best is None or len(of_host + begin) > len(best[0]):
                best = (of_host + begin, verdict)
    return best


URLS = [
    "http://a.example.net/en/1", "https://b.example.net/de/1", "http://net/x", "http://xnet/x", "http://A.B.NET/", "http://a.net",
    "http://a.net?x=/en/", "http://x.example.com/de/5?u=http://q.net/", "http://example.com/de", "http://x.example.com/en/5",
    "http://k.org/fr/9#a", "http://org/fr/", "http://k.org/FR/9", "no scheme", None, "", "://c.net/en/", "http://example.net/en/",
    "http://notexample.net/en/", "ftp://u@h.org:80/fr/", "http://É.ORG/fr/é", "http:///en/", "http://a.net#/en/", "a://b://c.net/",
]


def test_rules(spark):
    got = {r.page_id: r for r in url_filter.judge(table(spark, [(i, u, None) for i, u in enumerate(URLS)])).collect()}
    for i, url in enumerate(URLS):
        host, path = parts(url)
        assert (got[i].host, got[i].path) == (host, path), url
        best = rule_of(host, path)
        assert got[i].rule == (best[0] if best else None), url
        if best:
            assert got[i].verdict == best[1], url


def link(*hosts):
    return "".join(f'<a href="http://{h}/x">x</a> <a href="/local">y</a>' for h in hosts)


PAGES = [
    (1, "http://good.org/fr/1", link("friend.de", "friend.de")),
    (2, "http://friend.de/1", link("second.de")),
    (3, "http://second.de/1", ""),
    (4, "http://bad.net/1", link("friend.de")),
    (5, "http://shill.de/1", link("bad.net", "other.de")),
    (6, "http://pusher.de/1", "<A HREF='//shill.de/2'>z</A>"),
    (7, "http://other.de/1", None),
    (8, "http://lone.de/1", link("lone.de")),
]


def power_iteration(pages):
    """Trust and distrust by plain iteration in floating point."""
    edges, seeds = {}, {"trust": {}, "distrust": {}}
    for _, url, html in pages:
        host, path = parts(url)
        best = rule_of(host, path)
        if best:
            kind = "trust" if best[1] == "allow" else "distrust"
            seeds[kind][host] = seeds[kind].get(host, 0) + 1
        for target in re.findall(r"(?i)href\s*=\s*[\"']?(?:[a-z]+:)?//([^/?#\"'\s>]+)", html or ""):
            if target != host:
                edges[host, target] = edges.get((host, target), 0) + 1
    ranks = {}
    for kind, start in seeds.items():
        total = sum(start.values())
        start = {h: n / total for h, n in start.items()}
        graph = [(a, b, n) if kind == "trust" else (b, a, n) for (a, b), n in edges.items()]
        out = {}
        for a, _, n in graph:
            out[a] = out.get(a, 0) + n
        rank = dict(start)
        for _ in range(200):
            new = {}
            for a, b, n in graph:
                new[b] = new.get(b, 0) + 0.85 * rank.get(a, 0) * n / out[a]
            rest = 1 - sum(new.values())
            for h, s in start.items():
                new[h] = new.get(h, 0) + s * rest
            rank = new
        ranks[kind] = rank
    return ranks


def test_ranks_and_verdicts(spark):
    pages = table(spark, PAGES)
    host, path = url_filter.url_parts(pages["url"])
    judged = pages.select(host.alias("host"), path.alias("path"))
    rule, verdict = url_filter.rule_of(judged["host"], judged["path"], url_filter.RULES)
    ranks = url_filter.propagate(url_filter.host_links(pages), url_filter.seeds(judged.select("*", verdict.alias("by_rule"))))
    want = power_iteration(PAGES)
    got = {"trust": {}, "distrust": {}}
    for r in ranks.collect():
        got[r.kind][r.host] = r["rank"] / url_filter.WHOLE
    for kind in want:
        for h, value in want[kind].items():
            assert got[kind].get(h, 0) == pytest.approx(value, abs=1e-3)
    verdicts = {r.page_id: r.verdict for r in url_filter.judge(pages).collect()}
    assert verdicts == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow"}


def test_odd_tables(spark):
    assert url_filter.judge(table(spark, [])).collect() == []
    got = url_filter.judge(table(spark, [(None, None, None), (1, "http://a.net/", None), (1, "http://a.net/", None)])).collect()
    assert sorted((str(r.page_id), r.verdict) for r in got) == [("1", "block"), ("1", "block"), ("None", "allow")]
    long = url_filter.judge(table(spark, [(1, "http://a.de/" + "x" * 100_000, link("b.net") * 5000)])).first()
    assert long.verdict == "allow" and len(long.path) == 100_001
