from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import balltree, catalog

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    parsed = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in parsed]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in parsed for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, c), size in zip(parsed, sizes, strict=True):
            score = 0
            for t, times in Counter(words(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * size * n) // total
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(best, 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, k=20):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("n", "terms", "cell", "tree", "score", "salt", "vals", "query")})
    own = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("terms", "rank", "doc_id")})
    found = balltree.rank(df, own, k).select("item_id", "rank", "doc_id", "score")
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, n=900):
    rng = random.Random(seed)
    vocabulary = ["the", "and", "Of", "é", "naïve", "x1", "日本"] + [f"w{i}" for i in range(150)]
    pick = lambda: vocabulary[min(int(rng.expovariate(0.04)), len(vocabulary) - 1)]
    text = lambda: rng.choice([" ", ", ", "\n", "_"]).join(pick() for _ in range(rng.randint(0, 40)))
    docs = [(i, text()) for i in range(n)]
    # A third are copies, some of one id; a few are null, empty or without words.
    docs += [(n + i, docs[5][1]) for i in range(n // 3)] + [(7, docs[9][1])] * 30
    docs += [(None, docs[5][1]), (-3, None), (-4, ""), (-5, "?! _"), (-6, "long " * 30_000 + "w3")]
    items = [(i, text()) for i in range(25)] + [(3, docs[5][1]), (3, docs[5][1]), (None, "w1 w1 W2"), (50, None), (51, ""), (52, "unseen"), (53, "the")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(balltree, "ROWS_PER_TREE", 64)
    monkeypatch.setattr(balltree, "ROWS_PER_LEAF", 4)
    monkeypatch.setattr(balltree, "SAMPLE", 50)
    if seed == 2:
        monkeypatch.setattr(balltree, "ENTRIES", 100)
    docs, items = corpus(seed)
    assert ranked(spark, docs, items) == brute(docs, items)


def test_edges(spark):
    docs, items = [(1, "a b"), (2, "a"), (3, None)], [(1, "a b"), (2, None)]
    assert ranked(spark, docs, items) == brute(docs, items)
    for few in (docs[2:], []):
        assert ranked(spark, few, items) == []
    assert ranked(spark, docs, []) == []
    # A word that all documents hold weighs nothing in a large corpus.
    many = [(i, "a " * (i % 3 + 1)) for i in range(3000)]
    assert ranked(spark, many, [(1, "a")]) == brute(many, [(1, "a")])


def random_rows(seed, n, terms, groups):
    rng = np.random.default_rng(seed)
    parts = []
    for i in range(n):
        low = (i % groups) * (terms // groups)
        idx = np.unique(rng.integers(low, low + terms // groups, rng.integers(1, 30))).astype(np.int32)
        parts.append((i, idx, rng.integers(1, 10**9, len(idx))))
    return balltree._joined(parts)


def test_bounds_hold_and_prune():
    rows = random_rows(3, 2000, 400, 8)
    root = balltree.Node(rows)
    rng = np.random.default_rng(4)

    def check(node, terms, counts, dense):
        dense[terms] = counts
        scores = rows_of(node).products(dense)
        dense[terms] = 0
        assert scores.max() <= node.bound(terms, counts.astype(float))
        for child in node.children:
            check(child, terms, counts, dense)

    def rows_of(node):
        if node.rows is not None:
            return node.rows
        low, high = (rows_of(c) for c in node.children)
        return balltree.Rows(np.r_[low.ids, high.ids], np.r_[low.sizes, high.sizes], np.r_[low.idx, high.idx], np.r_[low.val, high.val])

    dense = np.zeros(400, np.int64)
    scored = 0
    for _ in range(20):
        low = int(rng.integers(0, 8)) * 50
        terms = np.unique(rng.integers(low, low + 50, 12)).astype(np.int32)
        counts = rng.integers(1, 4, len(terms))
        check(root, terms, counts, dense)
        best = balltree.Best(terms, counts, 5)
        best.search(root, dense)
        dense[terms] = counts
        want = np.sort(rows.products(dense))[::-1][:5]
        dense[terms] = 0
        assert list(best.scores) == list(want[want > 0])
        scored += best.scored
    # Most rows are out of reach.
    assert scored < 20 * 2000 / 4


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = catalog.op12_ball_tree(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
