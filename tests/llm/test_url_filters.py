"""Rules and link propagation against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stocklens.llm import url_filters
from stocklens.llm.queries import queries
from tests.llm.conftest import PATH


def plain_parts(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]


def plain_rule(host: str, path: str) -> url_filters.Rule | None:
    fits = [
        r for r in url_filters.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain_ranks(links: dict, start: dict, damping: float = 0.85) -> dict:
    """Until no host's mass changes by more than a millionth of a millionth of it."""
    total = Counter()
    for (s, _), n in links.items():
        total[s] += n
    held = seeds = {h: (1 - damping) * v / sum(start.values()) for h, v in start.items()}
    while True:
        fresh = defaultdict(float, seeds)
        for (s, d), n in links.items():
            fresh[d] += damping * held.get(s, 0.0) * n / total[s]
        done = all(abs(v - held.get(h, 0.0)) <= 1e-12 * v for h, v in fresh.items())
        held = fresh
        if done:
            return held


def plain(pages: list) -> list:
    parts = [plain_parts(url) for _, url, _ in pages]
    rules = [plain_rule(*p) for p in parts]
    links, by_host = Counter(), defaultdict(list)
    for (host, _), rule, (_, _, html) in zip(parts, rules, pages, strict=True):
        if host:
            by_host[host].append(rule.verdict if rule else None)
        for target in __import__("re").findall(r"href=[\"']?(?:https?:)?//([^/?#\"'\s<>]+)", html or ""):
            if host and target.lower() != host:
                links[host, target.lower()] += 1
    for host in by_host:
        labels = host.split(".")
        ups = [u for k in range(1, len(labels)) if (u := ".".join(labels[k:])) in by_host and u]
        if ups:
            links[host, ups[0]] += 1
            links[ups[0], host] += 1
    start = {
        v: {h: float(x.count(v)) for h, x in by_host.items() if v in x} for v in ("allow", "block")
    }
    trust = plain_ranks(links, start["allow"])
    distrust = plain_ranks({(d, s): n for (s, d), n in links.items()}, start["block"])
    out = []
    for (page, _, _), (host, path), rule in zip(pages, parts, rules, strict=True):
        t, d = trust.get(host, 0.0), distrust.get(host, 0.0)
        verdict = rule.verdict if rule else "block" if d - 0.5 * (t + d) > url_filters.EVEN * (t + d) else "allow"
        out.append((page, host, path, rule.text if rule else None, verdict))
    return out


def _compare(df, pages: list) -> list:
    found = [tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(found, key=str) == sorted(plain(pages), key=str)
    return found


@pytest.fixture
def pages(spark):
    def build(rows: list):
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return df.withColumns({c: F.lit(c) for c in ("host", "path", "rule", "trust", "n", "kind")})

    return build


def test_query_matches_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{PATH}/pages.parquet").select("page_id", "url", "html").collect()]
    _compare(queries()["op6_url_filters"](spark, PATH), rows)


def test_distrust_goes_against_links_and_trust_along(pages):
    rows = [
        (1, "http://bad.net/x", ""), (2, "http://Links-To-Bad.com/a", '<a href="http://bad.net/x">'),
        (3, "http://good.org/fr/1", '<a href="https://Friend.com/">'), (4, "http://friend.com/", "<a href=/own>"),
        (5, "http://mixed.com/", '<a href="//bad.net/y">'), (6, "http://good.org/fr/2", "<a href='http://mixed.com'>"),
        (7, None, None), (8, "no scheme", "<a href=http://bad.net>"), (9, "http://blog.links-to-bad.com/z", None),
        (10, "ftp://EXAMPLE.NET/en/?q#f", None), (11, "http://x.example.com/de/", ""), (12, "http://x.example.com/d", ""),
        (13, "http://net/", ""), (14, "http://net", ""), (15, "http://notnet/", ""), (15, "http://notnet/", ""),
        (None, "http://a://b/c", ""), (16, "://?#", ""), (17, "http://ÄB.org/fr/", "x" * 50_000),
    ]
    found = {r[0]: r[4] for r in _compare(url_filters.judged_pages(pages(rows)), rows)}
    assert found[2] == found[9] == "block"
    assert found[4] == "allow"
    assert url_filters.judged_pages(pages(rows).limit(0)).count() == 0


def test_a_hot_host_and_many_links(pages):
    rows = [(i, f"http://h{i % 7}.com/{i}", f'<a href="http://hub.org/{i}"><a href="http://h{(i * 3) % 11}.com">') for i in range(600)]
    rows += [(1000 + i, "http://hub.org/fr/x", f'<a href="http://h{i % 5}.com">') for i in range(300)]
    rows += [(2000 + i, f"http://spam{i}.net/", '<a href="http://hub.org">') for i in range(40)]
    rows += [(3000, "http://h3.com/z", '<a href="http://spam1.net">' * 50)]
    _compare(url_filters.judged_pages(pages(rows)), rows)


def test_the_main_path_is_native(spark, pages):
    plan = url_filters.judged_pages(pages([(1, "http://a.com/", "")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_far_host_is_reached(pages):
    rows = [(0, "http://bad.net/", "")]
    rows += [(i, f"http://h{i}.com/", f'<a href="http://{"bad.net" if i == 1 else f"h{i - 1}.com"}/">') for i in range(1, 13)]
    found = {r.page_id: r.verdict for r in url_filters.judged_pages(pages(rows)).collect()}
    assert set(found.values()) == {"block"}


def test_few_ruled_pages_and_far_ancestors_decide(pages):
    """One blocked page of many is enough where nothing is allowed, and reaches hosts two names below."""
    rows = [(i, f"http://spam.example.com/p{i}", "") for i in range(9)] + [(9, "http://spam.example.com/de/x", "")]
    rows += [(20, "http://a.b.spam.example.com/", ""), (21, "http://good.org/fr/", ""), (22, "http://x.y.good.org/", ""), (23, "http://far.com/", "")]
    found = {r[0]: r[4] for r in _compare(url_filters.judged_pages(pages(rows)), rows)}
    assert {found[i] for i in range(10)} == {"block"} and found[20] == "block"
    assert found[22] == found[23] == "allow"


def test_small_shares_decide_as_large_ones(pages):
    rows, target = [(0, "http://bad.net/", "")], "bad.net"
    for hop in range(7):
        rows += [(100 * hop + k + 1, f"http://h{hop}x{k}.com/", f'<a href="http://{target}/">') for k in range(100)]
        target = f"h{hop}x0.com"
    found = {r.page_id: r.verdict for r in url_filters.judged_pages(pages(rows)).collect()}
    assert set(found.values()) == {"block"}
