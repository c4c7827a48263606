"""URL filter against a plain version: relative, protocol-relative, query-only, encoded and refresh links, chains, cycles, precedence."""

import html
import random
import re
from urllib.parse import urldefrag, urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from seqloom.llm import queries, urls

SCHEMA = "page_id bigint, url string, html string"


def node(u):
    m = re.match(r"(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?", u or "", re.S)
    return f"{m[1].lower()}://{m[2].lower()}{m[3] or '/'}{m[4] or ''}" if m and m[2] else None


def parts(u):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", u or "", re.S)
    return (m[1].lower(), m[2]) if m else ("", "")


def ruled(u, rules):
    host, path = parts(u)
    fits = [(len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute(pages, links, rules):
    """Verdicts by following every edge from every node; ``links`` holds each page's resolved targets."""
    near = {}
    for i, u, _ in pages:
        for t in links.get(i, []):
            if node(u) and node(t):
                near.setdefault(node(u), set()).add(node(t))
                near.setdefault(node(t), set()).add(node(u))
    out = {}
    for i, u, _ in pages:
        seen, todo = {node(u)}, [node(u)]
        while todo:
            for x in near.get(todo.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        action = ruled(u, rules)[1]
        bad = len(seen) > 1 and any(ruled(x, rules)[1] == "block" for x in seen)
        out[i] = (*parts(u), ruled(u, rules)[0], action or ("block" if bad else "allow"))
    return out


@pytest.mark.parametrize("target,want", [
    ("page", "http://H.example/a/b/page"), ("../x", "http://H.example/a/x"), ("../../../x/.", "http://H.example/x/"), ("./", "http://H.example/a/b/"), ("?p=2", "http://H.example/a/b/c?p=2"),
    ("#top", "http://H.example/a/b/c?q=1"), ("//o.example/z", "http://o.example/z"), ("/r/../s?t", "http://H.example/s?t"), ("HTTPS://Q.example", "HTTPS://Q.example"), ("mailto:a@b.example", None), ("g;x=1/../y", "http://H.example/a/b/y")])
def test_targets_resolve(spark, target, want):
    row = spark.createDataFrame([(target, "http://H.example/a/b/c?q=1#f")], "t string, u string")
    assert row.select(urls.resolve(F.col("t"), F.col("u")).alias("x")).first().x == want
    if want and target[:1] != "H":
        assert urldefrag(urljoin("http://H.example/a/b/c?q=1", target)).url == want


def test_links_of_html(spark):
    text = """<link href='/a?x=1&amp;y=2' rel="canonical"><meta http-equiv=refresh content="5; URL='next'"><link rel=stylesheet href=/no><LINK REL=CANONICAL HREF=//h.example/z><meta name=url content="url=/no">"""
    row = spark.createDataFrame([(text, "http://h.example/d/p"), (None, "http://h.example/")], SCHEMA[15:].replace("url string, html string", "html string, url string"))
    assert [r.x for r in row.select(urls.html_links(F.col("html"), F.col("url")).alias("x")).collect()] == [["http://h.example/a?x=1&y=2", "http://h.example/d/next", "http://h.example/z"], []]


def test_brute_force(spark):
    rng = random.Random(6)
    hosts = ["a.com", "www.a.com", "b.example.com", "example.com", "c.net", "example.net", "d.org", "x.io", "y.io", "z.io"]
    paths = ["", "/", "/en/1", "/en/7", "/en/7/x", "/de/8", "/de/9", "/es/3", "/p", "/p/", "/q?a=1", "/q?a=2", "/fr/1#f"]
    pages, links = [], {}
    for i in range(400):
        u = rng.choice(["http", "HTTPS", "https"]) + "://" + rng.choice(hosts).title() + rng.choice(paths)
        h = "plain"
        if rng.random() < 0.35:
            t = rng.choice(["../p", "?a=1", "/en/1", "/es/3", "//x.io/p", "https://y.io/q?a=1&b=2", "http://z.io/fr/1", "w"])
            code = html.escape(t)
            h = rng.choice([f'<link rel="canonical" href="{code}">', f"<meta content='0;url={code}' http-equiv='Refresh'>"])
            links[i] = [urljoin(u if urlsplit(u).path else u.replace(urlsplit(u).netloc, urlsplit(u).netloc + "/"), t)]
        pages.append((i, u, h))
    pages += [(900, None, '<link rel="canonical" href="/x">'), (901, "no host", None), (902, "", ""), (903, "://", ""), pages[3], pages[7], (None, pages[5][1], pages[5][2])]
    links[None] = links.get(5, [])
    frame = spark.createDataFrame([(*p, "k", "b", 1) for p in pages], SCHEMA + ", node string, bad string, component int")
    want = brute(pages, links, queries.URL_RULES)
    assert sum(v[2] is None and v[3] == "block" for v in want.values()) > 20
    for literal in (256, 0):
        urls.MOST_LITERAL, before = literal, urls.MOST_LITERAL
        try:
            got = urls.judge(frame, queries.URL_RULES).collect()
        finally:
            urls.MOST_LITERAL = before
        assert len(got) == len(pages)
        for r in got:
            assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id], r


def test_chain_and_cycle(spark):
    link = '<link rel=canonical href="http://s{}.io/">'.format
    pages = [(i, f"http://s{i}.io/", link(i + 1)) for i in range(40)] + [(40, "http://s40.io/", link(0)), (50, "http://s50.io/", link(51)), (51, "http://s51.io/", link(50))]
    frame = spark.createDataFrame(pages, SCHEMA)
    got = {r.page_id: r.verdict for r in urls.judge(frame, [("block", "s17.io", "/"), ("allow", "s3.io", "/")]).collect()}
    assert got == {i: "allow" if i in (3, 50, 51) else "block" for i in got}


def test_given_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.io/x", None), (2, "http://b.io/", None)], SCHEMA)
    edges = spark.createDataFrame([("http://A.io/x#f", "http://c.io/"), ("http://c.io", "http://bad.com/")], "src string, dst string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, [("block", "bad.com", "/")], edges).collect()} == {1: "block", 2: "allow"}
