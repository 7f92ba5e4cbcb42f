from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, urlrules

PAGES = "page_id long, url string"
RULES = "host string, path string, verdict string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:stop]


def brute(pages, rules, default="allow"):
    out = []
    for page, url in pages:
        host, path = split(url)
        best = None
        for h, p, v in rules:
            if v is None:
                continue
            h, p = (h or "").lower(), p or ""
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p):
                best = max(best or (), (len(h) + len(p) + (h != ""), len(h), v, h + p))
        out.append((page, host, path, best[3] if best else None, best[2] if best else default))
    return sorted(out, key=str)


def judged(spark, pages, rules, extra=False):
    df, own = spark.createDataFrame(pages, PAGES), spark.createDataFrame(rules, RULES)
    if extra:
        df = df.withColumns({c: F.lit("clash") for c in ("host", "path", "key", "range", "salt", "rule", "verdict", "kind")})
    return sorted(map(tuple, urlrules.judge(df, own).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_rules(spark, monkeypatch, seed):
    monkeypatch.setattr(urlrules, "URLS_PER_RANGE", 40)
    monkeypatch.setattr(urlrules, "BOUND_CHARS", 6)
    rng = random.Random(seed)
    labels, steps = ["a", "b", "net", "n-e", "é", ""], ["/", "/a", "/a/", "/a/b", "", "x"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = [(host() or None, rng.choice([*steps, None]), rng.choice(["allow", "block", None])) for _ in range(60)]
    pages = [(i, f"http://{host()}{rng.choice(steps)}{rng.choice(['', '?q=/', '#a/b'])}") for i in range(900)]
    # One host with a third of the rows.
    pages += [(5000 + i, "https://A.net/a/b") for i in range(450)]
    assert judged(spark, pages, rules, extra=True) == brute(pages, rules)


def test_edges(spark):
    rules = [("net", "/", "block"), ("Example.NET", "/en/", "allow"), ("example.net", "/en/", "block"), ("", "/all", "block"), (None, None, None)]
    pages = [
        (1, None), (2, ""), (3, "no scheme"), (None, "http://example.net/en/x"), (5, "x://net"), (6, "x://net?/"),
        (7, "http://b.EXAMPLE.net/en/://?"), (8, "http://b.example.net/EN/"), (9, "http://" + "l." * 50_000 + "net/" + "p" * 100_000),
        (9, "http://xnet/all"), (9, "http://xnet/all"), (10, "://"), (11, "://org./fr/"), (12, "a://b://net/"), (13, "http://\nnet/\n?"),
    ]
    assert judged(spark, pages, rules) == brute(pages, rules)
    assert judged(spark, pages, []) == brute(pages, [])
    assert judged(spark, [], rules) == []


def test_ranges_of_a_rule_hold_its_urls(monkeypatch):
    monkeypatch.setattr(urlrules, "BOUND_CHARS", 5)
    rng = random.Random(7)
    key = lambda: "".join(rng.choice(["a", "b-", "n", ""]) + "." for _ in range(rng.randint(1, 5)))
    bounds = sorted({(key()[:5], rng.randint(-9, 9)) for _ in range(40)})
    for _ in range(2000):
        rule = key()
        first, last = urlrules.ranges_of(bounds, rule)
        assert first <= urlrules.range_of(bounds, rule + rng.choice(["", key()]), rng.choice([-(2**63), 0, 2**63 - 1])) <= last


def test_query_against_brute_force(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()]
    got = catalog.op13_url_rules(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute(pages, catalog.URL_RULES)
    assert {r["verdict"] for r in got} == {"allow", "block"}
