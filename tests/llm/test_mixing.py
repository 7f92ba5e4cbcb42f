from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tidemark.llm import mixing


def filled(sizes, weights, share, cap):
    """Share what is left by weight until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: cap * sizes[s] for s in full}
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return target


def corpus(seed, n=400):
    rng = random.Random(seed)
    names = ["b", "a", "é", "zz", "", None, "Z"]
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(names + ["a"] * 8)) for i in range(n)]
    return rows + [(9000, None, "a"), (9001, "", None), (9002, "x y", "lone"), (None, "p q", "a"), (5, "r s t", "a")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix(make_docs, seed):
    rows = corpus(seed)
    mixed = mixing.mix(make_docs(rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target = filled(sizes, mixing.WEIGHTS, 1.5, 2)
    assert len(mixed) == len(rows)
    taken, longest = defaultdict(int), max(len((t or "").split()) for _, t, _ in rows)
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for source in sizes:
        assert abs(taken[source] - target[source]) <= longest / 2 + 1e-6
    again = mixing.mix(make_docs(rows[::-1])).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, again))


def test_repeated_rows(make_docs):
    mixed = mixing.mix(make_docs([(1, "a b c", "s")] * 20)).collect()
    # One source: a target of 1.5 of its size.
    assert sum(r["taken"] for r in mixed) == 90


def test_no_words(make_docs):
    docs = make_docs([(1, "", "a"), (2, None, "b"), (3, None, None)])
    assert [(r["target"], r["taken"]) for r in mixing.mix(docs).collect()] == [(0.0, 0)] * 3
    assert mixing.mix(docs.limit(0)).count() == 0
