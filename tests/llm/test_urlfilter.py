import random
import re
from collections import defaultdict

import pytest

from chronolake.llm import urlfilter

PAGES = "page_id long, url string, html string"


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def brute(pages, rules=urlfilter.GIVEN, rounds=20):
    out, links = [], defaultdict(lambda: defaultdict(int))
    for page, url, html in pages:
        host, path = split(url)
        fit = [(h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        out.append([page, host, path, *(max(fit, key=lambda r: len(r[0])) if fit else (None, None))])
        for to in {re.sub("[A-Z]", lambda x: x[0].lower(), t) for t in re.findall(r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html or "")}:
            if host and to != host:
                links[host][to] += 1
    back = defaultdict(lambda: defaultdict(int))
    for a, own in links.items():
        for b, n in own.items():
            back[b][a] += n
    ranks = {}
    for kind, action, graph in (("trust", "allow", links), ("distrust", "block", back)):
        seed = {}
        for host in {r[1] for r in out if r[1]}:
            own = [r[4] for r in out if r[1] == host]
            if own.count(action):
                seed[host] = int(own.count(action) * float(1 << 30) / len(own))
        rank = dict(seed)
        for _ in range(rounds):
            new = defaultdict(int, seed)
            for a, own in graph.items():
                for b, n in own.items():
                    new[b] += int(rank.get(a, 0) * (0.85 * n / sum(own.values())))
            rank = new
        ranks[kind] = rank
    blocked = lambda h: ranks["distrust"].get(h, 0) - ranks["trust"].get(h, 0) >= 1 << 29
    return sorted([(p, h, path, rule, a or ("block" if h and blocked(h) else "allow")) for p, h, path, rule, a in out], key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_links(spark):
    """Hosts that link to blocked ones are blocked, those that trusted ones link to aren't."""
    page = lambda *to: "<p>" + "".join(f"<A class=x HREF = '{t}'>t</A>" for t in to)
    pages = [
        (1, "http://bad.net/x", page()),
        (2, "http://farm.com/a", page("http://bad.net/1", "//BAD.net/2", "/own")),
        (3, "http://feeder.com/a", page("https://farm.com")),
        (4, "http://good.org/fr/a", page("http://fine.com/")),
        (5, "http://fine.com/", page("http://alone.com/")),
        (6, "http://alone.com", page("mailto:x@bad.net", "#top", "relative//x")),
    ]
    got = found(urlfilter.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(urlfilter.GIVEN, urlfilter.RULES)))
    assert {r[0]: r[4] for r in got} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"} and got == brute(pages)


@pytest.mark.parametrize("seed", [0, 1])
def test_random(spark, monkeypatch, seed):
    """A random graph with a host that has a third of all pages and links; hot hosts go the other way."""
    rng = random.Random(seed)
    hosts = [f"{a}{i}.{b}" for i in range(8) for a in ("", "www.") for b in ("net", "example.com", "org", "example.net")]
    pages = []
    for i in range(300):
        host = "hub.example.com" if i % 3 == 0 else rng.choice(hosts)
        to = [f'<a href="http://{rng.choice(["hub.example.com", *hosts])}/q">' for _ in range(rng.randint(0, 4))]
        pages.append((i, f"http://{host}{rng.choice(['/de/', '/fr/', '/en/', '/', ''])}p{i}?x=1", "".join(to)))
    if seed:
        monkeypatch.setattr(urlfilter, "frequent", lambda rows, by, least=3, f=urlfilter.frequent: f(rows, by, 3))
        monkeypatch.setattr(urlfilter, "SHARE", 40)
    got = found(urlfilter.judge(spark.createDataFrame(pages, PAGES).repartition(4), spark.createDataFrame(urlfilter.GIVEN, urlfilter.RULES), rounds=6))
    assert got == brute(pages, rounds=6) and {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_edges(spark):
    """Nulls, urls without a host, upper case, ports, repeated rows, long texts, clashing names, empty tables."""
    pages = [(1, None, None), (2, "no scheme", "x"), (3, "HTTP://A.Example.NET/en/Ü?q#f", None), (4, "x://NET/", ""), (None, "http://a.net:80/", "<a href=//b.org>"), (None, "http://a.net:80/", "<a href=//b.org>"), (5, "http://net", None), (6, "http://u@b.net/://c", "href=" + " " * 2000), (7, "http://É.net/#x", "<a href='//x'>" * 20_000), (8, "http://notnet/", "")]
    pages.append((9, "http://" + "a." * 3000 + "net/en/", None))
    rules = spark.createDataFrame([*urlfilter.GIVEN, (None, "/", "block"), ("b.net", None, None)], urlfilter.RULES)
    df = spark.createDataFrame(pages, PAGES)
    assert found(urlfilter.judge(df.selectExpr("*", "1 n", "'x' host", "'y' verdict", "2 rule"), rules)) == brute(pages)
    assert urlfilter.judge(df.limit(0), rules).collect() == []
    assert {r.rule for r in urlfilter.judge(df, rules.limit(0)).collect()} == {None}
