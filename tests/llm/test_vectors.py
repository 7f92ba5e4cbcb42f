from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, topk
from tidemark.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def exact(rows, is_query, k, score, better):
    """Brute force; rows of (id, vector)."""
    queries = {}
    for i, v in rows:
        if is_query(i) and (i not in queries or list(v) < list(queries[i])):
            queries[i] = v
    out = []
    for q, own in queries.items():
        found = sorted((better(score(own, v)), i) for i, v in rows if i != q)[:k]
        out += [(q, n, i, better(s)) for n, (s, i) in enumerate(found, 1)]
    return out


def euclid(a, b):
    return float(np.sqrt(((np.array(a, float) - np.array(b, float)) ** 2).sum()))


def inner(a, b):
    return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(map(float, a), map(float, b), strict=True))


def rows_of(seed, n=300, d=5):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.integers(-4, 5, d) / 4]) for i in range(n)]
    rows += [(i, rows[7][1]) for i in range(n, n + 150)] + [(20, rows[3][1]), (20, rows[4][1]), (-10, rows[8][1])]
    return rows


BAD = [(None, [1.0] * 5, 0), (2, None, 0), (4, [], 0), (10, [1.0, None, 0.0, 0.0, 0.0], 0), (10, [NAN] * 5, 0), (0, [INF] * 5, 0), (6, [1.0] * 4, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_adaptive_scan_of_small_tables(spark, seed):
    rows = [r for r in rows_of(seed) if any(r[1])]
    df = spark.createDataFrame([(*r, 1) for r in rows] + BAD + [(30, [0.0] * 5, 1)], SCHEMA).withColumn("list", F.lit("clash"))
    found = ann.nearest(df, F.col("vec_id") % 10 == 0, k=10).collect()
    want = exact(rows, lambda i: i % 10 == 0, 10, euclid, lambda s: s)
    by_query = {}
    for q, _, i, s in want:
        by_query.setdefault(q, []).append((i, s))
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == by_query.keys()
    hits = 0
    vectors = {}
    for i, v in rows:
        vectors.setdefault(i, []).append(v)
    for q, near in got.items():
        assert len(near) == 10 and near == sorted(near, key=lambda x: (x[1], x[0]))
        hits += sum(1 for x in near if x in by_query[q])
    assert hits / len(want) > 0.9


def test_scan_equals_brute_force_without_slack_errors():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((5000, 32))
    turn, _ = np.linalg.qr(rng.standard_normal((32, 32)))
    ids = rng.permutation(5000)
    hits = 0
    for q in x[:40]:
        got, distance = ann.scan(q, q @ turn, ids, x, x @ turn, 10)
        order = np.lexsort((ids, np.sqrt(((x - q) ** 2).sum(1))))[:10]
        hits += len(set(got) & set(ids[order]))
        assert (np.diff(distance) >= 0).all()
    assert hits / 400 > 0.97


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    df = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = df.collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(found[ids[q]] & set(ids[d.argsort()[:10]]))
        total += 10
    assert hits / total >= 0.9


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 1.0], 0) for i in range(4)], SCHEMA)
    assert [tuple(r)[:3] for r in ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert topk.top_products(df, F.col("vec_id") == 0).count() == 3
    one = df.limit(1)
    assert ann.nearest(one, F.lit(True)).count() == 0 and topk.top_products(one, F.lit(True)).count() == 0
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0 and topk.top_products(df.limit(0), F.lit(True)).count() == 0


def test_copies_of_one_vector(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(500)], SCHEMA)
    for search in (ann.nearest, topk.top_products):
        got = search(df, F.col("vec_id") % 100 == 0, k=3).collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted(
            (q, n + 1, i) for q in range(0, 500, 100) for n, i in enumerate([i for i in range(5) if i != q][:3])
        )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_block_pruning_is_exact(spark, monkeypatch, seed):
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", 16)
    monkeypatch.setattr(topk, "ROWS_PER_RANGE", 100)
    monkeypatch.setattr(topk, "QUERIES_PER_CELL", 10)
    monkeypatch.setattr(topk, "SAMPLE", 64)
    rows = rows_of(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows] + BAD, SCHEMA).withColumn("range", F.lit("clash"))
    got = topk.top_products(df, F.col("vec_id") % 10 == 0).collect()
    want = exact(rows, lambda i: i % 10 == 0, 5, inner, lambda s: -s)
    assert sorted(map(tuple, got)) == sorted(want)


def test_large_weights(spark):
    big = 2.0**40
    df = spark.createDataFrame(
        [(0, [big, 1.0], 0), (1, [big, -1.0], 0), (2, [-big, 3.0], 0), (3, [0.0, 0.5], 0), (4, [1e38, 0.0], 0)],
        SCHEMA,
    )
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in topk.top_products(df, F.lit(True)).collect()}
    assert got[0, 1] == 2**63 - 1 and got[0, 2] == -(2**63) and got[0, 3] == 256 * 128
    # A weight beyond a long is the largest one.
    assert got[4, 3] == 0 and got[4, 1] == 2**63 - 1 and got[4, 2] == -(2**63)


def test_each_dimension_is_searched_among_its_own(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 3 + i % 3)], 0) for i in range(120)]
    rows += [(0, [0.5] * 5, 0), (3, [9.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    asked = F.col("vec_id") % 10 == 0

    def want(score, better, k):
        out = []
        for d in (1, 3, 4, 5):
            own = [r[:2] for r in rows if len(r[1]) == d]
            out += exact(own, lambda i: i % 10 == 0 and not (i == 0 and d == 5 and rows[0][1] < [0.5] * 5), k, score, better)
        return sorted(out)

    assert sorted(map(tuple, topk.top_products(df, asked).collect())) == want(inner, lambda s: -s, 5)
    got = ann.nearest(df, asked, k=10).collect()
    assert {r["query_id"] for r in got} == set(range(0, 120, 10))
    size = {r[0]: len(r[1]) for r in rows[:120]}
    found = {(r["query_id"], r["vec_id"]) for r in got}
    near = {(q, i) for q, _, i, _ in want(euclid, lambda s: s, 10)}
    assert len(found & near) / len(near) > 0.9
    assert all(size[r["vec_id"]] == size[r["query_id"]] for r in got if r["vec_id"] not in (0, 3))


def test_bounds_stop_early():
    blocks = [(np.array([1, 2]), np.array([[10, 0], [9, 0]])), (np.array([3]), np.array([[1, 0]]))]
    seen = []

    class Watch(list):
        def __getitem__(self, b):
            seen.append(int(b))
            return super().__getitem__(b)

    ids, scores = topk.best_of(0, np.array([1, 0]), topk.LOWEST, Watch(blocks), np.array([10.0, 1.0]), 2)
    assert list(ids) == [1, 2] and list(scores) == [10, 9] and seen == [0]
