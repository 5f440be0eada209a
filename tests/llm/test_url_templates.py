"""URL rules by brute force; the template tree on a site whose templates are known."""

import random
import re

from tessera.llm import url_templates as ut
from tessera.llm.catalog import URL_RULES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.partition("://")[2], re.S)
    return m[1].translate(UPPER), m[2]


def ruled(host, path):
    best = None
    for verdict, rule in URL_RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best or (None, None)


ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/EN/x?y#z", "http://com/", "http://com", "http://xcom/", "http://a.b.com/en/",
       "http://example.com/en", "http://example.com/en/", "http://x.www.example.com/en/1", "http://net/es/", "http://a.net/fr/9", "http://a.net/es",
       "a://b://c/d", "http://É.NET/es/é", "http://h?x/://y", "http://h#/es/", "http://user@h.net:80/es/", "x://\n.net/es/\n", "http://h/" + "s/" * 3000]


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int")


def test_rules_and_odd_urls(spark):
    rows = [*enumerate(ODD), (3, "http://"), (None, "http://a.com/1")]
    pages, labels = frames(spark, rows, [(4, 1), (4, None), (99, 1), (None, 1)])
    out = ut.url_verdicts(pages.selectExpr("*", "url AS path", "url AS segment", "page_id AS n"), labels, URL_RULES).collect()
    assert len(out) == len(rows)
    urls = dict(rows)
    for r in out:
        host, path = parse(urls[r["page_id"]])
        verdict, rule = ruled(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert ut.url_verdicts(empty, labels, URL_RULES).count() == 0


def test_templates(spark):
    rng = random.Random(4)
    rows, labels = [], []

    def add(path, bad):
        labels.append((len(rows), int(bad)))
        rows.append((len(rows), f"http://shop.example.org{path}"))

    for i in range(300):
        add(f"/item/{i}.html", rng.random() < 0.05)
        add(f"/tag/{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvw'[i // 100]}x/list", rng.random() < 0.05)
        add(f"/out/{i}", rng.random() < 0.95)
        add(f"/about/{('us', 'jobs')[i % 2]}", rng.random() < 0.05)
        add("/deep/1/2/3/4/5/6/7/8/" + str(i), False)
    pages, frame = frames(spark, rows, labels)
    out = {r["page_id"]: r for r in ut.url_verdicts(pages, frame, []).collect()}
    found = {(r["path"].split("/")[1], r["template"]) for r in out.values()}
    assert {t for p, t in found if p == "out"} == {"/out/*"}  # differs from its siblings
    assert {t.rsplit("/", 1)[1] for p, t in found if p == "item"} == {"*.html"}
    assert all(t.split("/")[2] == "*" for p, t in found if p == "tag")  # words that don't recur
    assert all(t.endswith("/~") for p, t in found if p == "about")  # similar branches
    assert all(t.endswith("/**") and t.count("/") == 7 for p, t in found if p == "deep")
    assert {r["path"].split("/")[1] for r in out.values() if r["verdict"] == "block"} == {"out"}
    n, bad = 300, sum(b for i, b in labels if rows[i][1].startswith("http://shop.example.org/out"))
    host = 1 - sum(b for _, b in labels) / len(labels)
    assert {r["purity"] for r in out.values() if r["template"] == "/out/*"} == {round((n - bad + 10 * host) / (n + 10), 6)}


def test_a_bad_branch_among_many_good_ones(spark):
    for times in (1, 5):  # as many pages of the same site change nothing
        rows, labels = [], []
        for i in range(100):
            name = "dir" + "".join("abcdefghij"[int(c)] for c in f"{i:02d}")
            for k in range(10 * times):
                rows.append((len(rows), f"http://h.org/{name}/p{k}"))
                labels.append((len(labels), 0))
        for k in range(500 * times):
            rows.append((len(rows), f"http://h.org/spam/p{k}"))
            labels.append((len(labels), 1))
        rows += [(len(rows) + i, f"http://u.org/{i}/x") for i in range(40)]  # variable, without labels
        out = ut.url_verdicts(*frames(spark, rows, labels), []).collect()
        assert {r["verdict"] for r in out if "/spam/" in r["path"]} == {"block"}
        assert {r["verdict"] for r in out if "/spam/" not in r["path"]} == {"allow"}
        assert {r["template"].split("/")[1] for r in out} == {"spam", "*"}


def test_branches_below_the_depth(spark):
    rows, labels = [], []
    for i in range(60):
        for path, bad in (("spam/" + "y/" * 50 + str(i), 1), (f"docs/{i}", 0), ("docs", 0)):
            labels.append((len(rows), bad))
            rows.append((len(rows), f"http://h.org/a/b/c/d/e/f/{'x/' * 40}{path}"))
    rows.append((len(rows), "http://h.org/a/b/c/d/e/f/" + "x/" * 40 + "docs/new"))
    out = ut.url_verdicts(*frames(spark, rows, labels), []).collect()
    assert len(out) == len(rows)
    assert all((r["verdict"] == "block") == ("/spam/" in r["path"]) for r in out)
    start = "/a/b/c/d/e/f" + "/x" * 40
    assert {r["template"] for r in out} == {start + "/spam/**", start + "/docs/**", start + "/docs"}
