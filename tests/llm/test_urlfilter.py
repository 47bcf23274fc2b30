import random
import re

from basketry.llm import urlfilter
from tests.llm.cases import collected

SCHEMA = "page_id bigint, url string, html string, host string, path string, key string"


def page(i, url, html="<p>x</p>"):
    return (i, url, html, "h", "p", "k")


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    query = re.match("[^#]*", rest[len(host) + len(path):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, path, query


def rule_of(host, path):
    fits = [r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host))
            and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.target), default=None)


def brute(table, links):
    """``links``: (url, target) pairs of absolute URLs."""
    def node(url):
        host, path, query = parts(url)
        return (host, path or "/", query) if host else None

    near, urls = {}, {}
    for a, b in links:
        if node(a) and node(b) and node(a) != node(b):
            near.setdefault(node(a), set()).add(node(b))
            near.setdefault(node(b), set()).add(node(a))
            for u in (a, b):
                urls.setdefault(node(u), set()).add(u)
    out = []
    for row in table:
        host, path, _ = parts(row[1])
        rule = rule_of(host, path)
        verdict = rule.action if rule else "allow"
        if rule is None and node(row[1]) in near:
            seen, todo = set(), [node(row[1])]
            while todo:
                if (n := todo.pop()) not in seen:
                    seen.add(n)
                    todo += near[n]
            found = {r.action for n in seen for u in urls[n] if (r := rule_of(*parts(u)[:2]))}
            verdict = "block" if found == {"block"} else "allow"
        out.append((row[0], host, path, rule.target if rule else None, verdict))
    return sorted(out, key=repr)


CANONICAL = '<html><LINK href="{}" REL="x Canonical"><body>'
REFRESH = "<meta http-equiv=refresh content=\"0; URL='{}'\">"


def test_links_of_a_page(spark):
    table = [page(1, "http://a.example.org/en/x?q=1#f", CANONICAL.format("../b?c=1&amp;d=2")),
             page(2, "http://a.example.org", REFRESH.format("//E.example.ORG/y")),
             page(3, "https://b.org/d/e", CANONICAL.format("/root")),
             page(4, "https://b.org/d/e", "<!-- " + CANONICAL.format("/no") + " -->"
                  + "<script>'" + CANONICAL.format("/no") + "'</script>"),
             page(5, "https://b.org/d/e", '<link rel="alternate canonicalx" href="/no">'),
             page(6, "https://b.org/d/e", '<link rel=canonical href=mailto:x><meta content="1">'),
             page(7, None, CANONICAL.format("http://z.net/")), page(8, "https://b.org/d/e", None),
             page(9, "https://b.org/d?x", CANONICAL.format("?y=2"))]
    got = collected(urlfilter.page_links(spark.createDataFrame(table, SCHEMA)))
    assert [g for g in got if g[0] and g[1]] == sorted([
        ("http://a.example.org/en/x?q=1#f", "http://a.example.org/en/../b?c=1&d=2"),
        ("http://a.example.org", "http://E.example.ORG/y"),
        ("https://b.org/d/e", "https://b.org/root"), ("https://b.org/d?x", "https://b.org/d?y=2")],
        key=repr)


def test_verdicts(spark):
    r = random.Random(11)
    hosts = ["a.example.net", "example.net", "xexample.net", "Example.COM", "w.example.com",
             "org", "b.org", "netx", "c.ORG", "example.com"]
    urls = [f"{r.choice(['http', 'HTTPS'])}://{r.choice(hosts)}{p}" for p in
            ["/en/", "/de/1", "/fr/", "/en/2?x=1", "/es", "", "?q", "#f", "/de", "/EN/"] * 8]
    table, links = [], []
    for i, u in enumerate(urls):
        t = r.choice(urls)
        kind = i % 5
        if kind == 0:
            table.append(page(i, u, CANONICAL.format(t)))
            links.append((u, t))
        elif kind == 1:
            table.append(page(i, u, REFRESH.format(t)))
            links.append((u, t))
        else:
            table.append(page(i, u))
    table += [page(900, None), page(901, ""), page(902, "no scheme/x"), page(903, "http://"),
              page(904, "://net/x"), page(904, "://net/x"), page(None, "http://b.org/es", None)]
    extra = [("http://b.org/es", "http://q.net/x"), ("http://far.org/1", "http://b.org/es")]
    df = spark.createDataFrame(table, SCHEMA)
    assert collected(urlfilter.judge(df)) == brute(table, links)
    redirects = spark.createDataFrame(extra, "url string, target string")
    got = collected(urlfilter.judge(df, redirects=redirects))
    assert got == brute(table, links + extra)
    assert (None, "b.org", "/es", None, "block") in got


def test_empty(spark):
    assert collected(urlfilter.judge(spark.createDataFrame([], SCHEMA))) == []
