from __future__ import annotations

import itertools
import random

import pytest

from tidemark.llm import buckets


def padding(lengths, widths):
    return sum(min(w for w in widths if w >= n) - n for n in lengths)


def least(lengths, k):
    own = sorted(set(lengths))
    choices = (
        (*c, own[-1]) for n in range(min(k, len(own))) for c in itertools.combinations(own[:-1], n)
    )
    return min(padding(lengths, c) for c in choices)


@pytest.mark.parametrize("seed", range(20))
def test_boundaries_are_the_best(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 2, 5, 9, 10, 40, 41, 300]) + rng.randint(0, 3) for _ in range(60)]
    lengths = [n for n in lengths if rng.random() < 0.9 or n > 5][:40]
    own = sorted(set(lengths))[:11]
    lengths = [n for n in lengths if n in own]
    bins = [(n, lengths.count(n), n * lengths.count(n)) for n in own]
    for k in (1, 2, 3, 4, 20):
        widths = buckets.best_boundaries(bins, k)
        assert len(widths) <= k and widths == sorted(set(widths)) and widths[-1] == own[-1]
        assert padding(lengths, widths) == least(lengths, k)


def test_no_bins():
    assert buckets.best_boundaries([], 4) == []


def test_bins_of_long_texts(spark):
    rows = spark.createDataFrame([(n,) for n in (0, 1, 4095, 4096, 4097, 8191, 100_000, 100_001, 1 << 40)], "n long")
    got = [r[0] for r in rows.select(buckets.length_bin(rows["n"])).collect()]
    assert got == [0, 1, 4095, 4096, 4096, 8190, 100_000, 100_000, 1 << 40]


def test_bins_do_not_mix_octaves(spark):
    rows = spark.createDataFrame([(3125,), (100_000,)], "n long")
    assert buckets.histogram(rows, "n") == [(3125, 1, 3125), (100_000, 1, 100_000)]


def test_pack(make_docs):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n "), (None, "a b"), (None, "a b"), (1003, "long " * 5000), (1, "again")]
    packed = buckets.pack(make_docs(rows), buckets=4, token_budget=64).collect()
    assert len(packed) == len(rows)
    sizes = sorted((r["doc_id"] or -1, r["n_words"]) for r in packed)
    assert sizes == sorted((i or -1, len((t or "").split())) for i, t in rows)
    batches = {}
    for r in packed:
        assert r["padding"] == r["width"] - r["n_words"] >= 0
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for own in batches.values():
        width = own[0]["width"]
        assert len(own) * width <= 64 or len(own) == 1 and own[0]["over_budget"]
        assert sorted(r["place"] for r in own) == list(range(len(own)))
    for bucket in {b for b, _ in batches}:
        full = [len(v) for (b, n), v in sorted(batches.items()) if b == bucket]
        assert len(set(full[:-1])) <= 1 and full[-1] <= full[0]
    lengths = [r["n_words"] for r in packed]
    assert sum(r["padding"] for r in packed) == least(lengths, 4)
    again = buckets.pack(make_docs(rows[::-1]), buckets=4, token_budget=64).collect()
    assert sorted(map(str, packed)) == sorted(map(str, again))


def test_pack_nothing(make_docs):
    assert buckets.pack(make_docs([(1, "a")]).limit(0)).count() == 0
