"""Rules and spread trust against a plain version."""

import re
import time
from collections import defaultdict

import pytest

from cohortspark.llm import host_trust as H

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
LINKS = '<a href="https://{}/x">y</a> <A HREF=//{}?q>z</A> <a href="/own">o</a> <a href=\'http://{}\'>'
PAGES = [
    (1, "http://www.Example.com/en/a?b#c", LINKS.format("good.org", "B.net", "good.org")), (2, "https://x.example.com/en/", None), (3, "http://example.com/en", ""),
    (4, "http://example.com", LINKS.format("good.org", "mid.org", "mid.org")), (5, "b.net/es/", "x"), (6, "http://b.net/es/1", LINKS.format("c.net", "d.net", "e.net")),
    (7, "http://b.net/en/1", "x"), (8, "http://notcom/", "x"), (9, "http://com/", "x"), (10, "http://bad.org/q", LINKS.format("b.net", "b.net", "worse.net")),
    (11, "http://good.org/", LINKS.format("far.org", "far.org", "www.example.com")), (12, "http://mid.org?x/y", LINKS.format("bad.org", "good.org", "b.net")),
    (13, "http://far.org#://z/en/", "x"), (14, None, LINKS.format("good.org", "good.org", "good.org")), (15, "", None), (16, "http://", "x"),
    (17, "http://ÉA.COM/x\ny", "x"), (18, "http://worse.net/fr/", "x"), (18, "http://worse.net/fr/", "x"), (None, "http://lone.org/a", None)]


def split(url):
    m = re.match(r"([^/?#]*)([^?#]*)", (url or "").split("://", 1)[1]) if "://" in (url or "") else None
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def brute(pages, rules, rounds=300, damping=.85):
    out, own, edges = [], defaultdict(list), defaultdict(int)
    for page, url, html in pages:
        host, path = split(url)
        fit = [(len(r), r, v) for v, r in rules
               if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
        _, rule, verdict = max(fit, default=(0, None, None))
        out.append((page, host, path, rule, verdict))
        if host:
            own[host].append(verdict)
            for d in {x.lower() for x in re.findall(H.LINK, html or "")} - {host}:
                edges[host, d] += 1
    hosts = set(own) | {h for e in edges for h in e}
    seed = {v: {h: sum(x == v for x in own[h]) / len(own[h]) if own[h] else 0 for h in hosts} for v in ("allow", "block")}
    seed = {v: {h: x / (sum(s.values()) or 1) for h, x in s.items()} for v, s in seed.items()}
    value = {v: dict(s) for v, s in seed.items()}
    for _ in range(rounds):
        for v, way in (("allow", 1), ("block", -1)):
            arcs = [(e[::way], n) for e, n in edges.items()]
            full = defaultdict(int)
            for (a, _), n in arcs:
                full[a] += n
            new = {h: (1 - damping) * seed[v][h] + damping * (0 if full[h] else value[v][h]) for h in hosts}
            for (a, b), n in arcs:
                new[b] += damping * value[v][a] * n / full[a]
            value[v] = new
    done = []
    for page, host, path, rule, verdict in out:
        t, d = value["allow"].get(host, 0), value["block"].get(host, 0)
        done.append((page, host, path, rule, verdict or ("block" if t + d and d / (t + d) > .5 else "allow"), round(t, 4), round(d, 4)))
    return sorted(done, key=repr)


def run(spark, pages):
    df = spark.createDataFrame([(*p, "q", 1) for p in pages], "page_id long, url string, html string, host string, trust int")
    got = H.judge(df, RULES).collect()
    return sorted(((r.page, r.host, r.path, r.rule, r.verdict, round(r.trust or 0, 4), round(r.distrust or 0, 4)) for r in got), key=repr)


def test_same_as_plain_version(spark):
    got = run(spark, PAGES)
    assert got == brute(PAGES, RULES)
    by = {r[0]: r for r in got}
    assert by[1][3:5] == ("www.example.com/en/", "allow") and by[2][3:5] == ("example.com/en/", "block") and by[4][3] is None
    assert by[10][4] == "block" and by[11][4] == "allow"  # the one links to blocked hosts, trusted ones link to the other


def test_no_links_and_empty_table(spark):
    pages = [(p, u, None) for p, u, _ in PAGES]
    assert run(spark, pages) == brute(pages, RULES)
    assert run(spark, []) == []


def test_native_plan(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    plan = H.judge(df, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("url", ["http://a/b", "ftp://A.b?c", "://x/y", "a://b://c/d"])
def test_host_and_path(spark, url):
    h, p = H.host_and_path(__import__("pyspark.sql.functions", fromlist=["lit"]).lit(url))
    assert tuple(spark.range(1).select(h, p).first()) == split(url)


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    link = '<a href="http://{}/">x</a>'
    pages = [(i, f"http://h{i}.org/", link.format(f"h{i + 1}.org")) for i in range(39)] + [(39, "http://h39.org/", link.format("b.net"))]
    pages.append((40, "http://b.net/fr/", None))
    got = H.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES, tolerance=.01).collect()
    assert [r.verdict for r in sorted(got, key=lambda r: r.page)] == ["block"] * 41


def test_unsettled_walk_is_an_error(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0)], "host string, t0 double, d0 double")
    links = spark.createDataFrame([(x, y, 1) for x, y in zip("abcdefgh", "bcdefghi")], "src string, dst string, n long")
    with pytest.raises(RuntimeError):
        H.spread(seeds, links, rounds=3)


def test_host_of_many_labels(spark):
    pages = [(1, "http://" + "x." * 16_000 + "example.com/en/", None), (2, "http://" + "a." * 500_000, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    H.judge(df.limit(1), RULES).collect()
    start = time.time()
    rules = H.rule_table(spark, RULES)
    hosts = H.locate(df, "page_id", "url").select("host")
    got = H.rules_of_hosts(hosts, rules, 3).collect()
    assert time.time() - start < 5
    assert [[f.rule for f in r.fits] for r in got] == [["example.com/en/", "com/"]]
