from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles, ranking, sampling, splitting
from tidemark.session import local_frame


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def by_hash(ids, salt):
    return sorted(ids, key=lambda i: (md5(salt + i), i))


@pytest.fixture
def tiny_buckets(monkeypatch):
    """Small limits, so that the paths for large tables run on a small one."""
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 7)
    monkeypatch.setattr(ranking, "PREFIX", 1)


@pytest.mark.parametrize("n", [0, 1, 17, 499, 500, 600])
def test_sample_is_the_first_by_hash(spark, tiny_buckets, n):
    ids = [f"k{i}" for i in range(500)]
    df = local_frame(spark, [(i,) for i in ids], "id string")
    got = {r["id"] for r in sampling.sample_fixed(df, "id", n, salt="s:").collect()}
    assert got == set(by_hash(ids, "s:")[:n])


def test_sample_keeps_copies_of_an_id_together(spark, tiny_buckets):
    rows = [("hot",)] * 400 + [(f"k{i}",) for i in range(300)]
    df = local_frame(spark, rows, "id string")
    got = [r["id"] for r in sampling.sample_fixed(df, "id", 350, salt="s:").collect()]
    assert got.count("hot") in (0, 400)
    order = by_hash({r[0] for r in rows}, "s:")
    taken = sorted(set(got), key=order.index)
    assert taken == order[: len(taken)]
    assert len(got) >= 350


@pytest.mark.parametrize("large", [False, True])
def test_split_sizes_and_order(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 5)
        monkeypatch.setattr(ranking, "PREFIX", 1)
    ids = [f"c{i}" for i in range(1000)]
    df = local_frame(spark, [(i, n % 2) for n, i in enumerate(ids)], "id string, y int")
    rows = splitting.stratified_split(df, "id", "y").collect()
    parts = {p: [r for r in rows if r["split"] == p] for p in ("train", "validation", "test")}
    assert [len(parts[p]) for p in parts] == [700, 150, 150]
    assert all(sum(r["y"] for r in part) == len(part) / 2 for part in parts.values())
    ones = by_hash([i for n, i in enumerate(ids) if n % 2], "split:")
    assert {r["id"] for r in parts["test"] if r["y"] == 1} == set(ones[:75])
    assert {r["id"] for r in parts["validation"] if r["y"] == 1} == set(ones[75:150])


def quotas_of(spark, sizes, kind="int"):
    frame = local_frame(spark, list(sizes.items()), f"stratum {kind}, n bigint")
    return {r["stratum"]: (r["test"], r["validation"]) for r in splitting.split_quotas(frame).collect()}


def test_split_quotas_of_the_published_run(spark):
    quotas = quotas_of(spark, {0: 5174, 1: 1869})
    assert sum(q[0] for q in quotas.values()) == 1057
    assert quotas[1][0] == 280
    assert quotas[0][0] == 777
    assert sum(q[1] for q in quotas.values()) == 1057


def shares_by_hand(sizes, total):
    everything = max(sum(sizes.values()), 1)
    shares = {c: total * n // everything for c, n in sizes.items()}
    order = sorted(sizes, key=lambda c: (-(total * sizes[c] % everything), str(c)))
    return {c: shares[c] + (i < total - sum(shares.values())) for i, c in enumerate(order)}


@pytest.mark.parametrize("seed", range(3))
def test_shares_of_many_classes(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([1, 3, 3, 50]) for i in range(700)} | {None: 40}
    total = sum(sizes.values())
    frame = local_frame(spark, list(sizes.items()), "stratum string, n bigint")
    found = splitting.proportional(frame, "n", total, total // 3, "share").collect()
    assert {r["stratum"]: r["share"] for r in found} == shares_by_hand(sizes, total // 3)


def test_shares_of_large_counts(spark):
    sizes = {"a": 4 * 10**17, "b": 2 * 10**17 + 1}
    frame = local_frame(spark, list(sizes.items()), "stratum string, n bigint")
    total = 5 * 10**17
    found = splitting.proportional(frame, "n", sum(sizes.values()), total, "share").collect()
    assert {r["stratum"]: r["share"] for r in found} == shares_by_hand(sizes, total)


def test_empty_table_is_split(spark):
    empty = local_frame(spark, [], "id string, y int")
    assert splitting.stratified_split(empty, "id", "y").columns == ["id", "y", "split"]
    assert splitting.stratified_split(empty, "id", "y").count() == 0
    assert splitting.stratified_folds(empty, "id", "y").count() == 0


@pytest.mark.parametrize("large", [False, True])
def test_null_class_is_a_class(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 5)
        monkeypatch.setattr(ranking, "PREFIX", 1)
    rows = [(f"c{i}", None if i % 5 == 0 else "x") for i in range(1000)]
    df = local_frame(spark, rows, "id string, y string")
    found = splitting.stratified_split(df, "id", "y").groupBy("y", "split").count().collect()
    own = {"train": 140, "validation": 30, "test": 30}
    assert {r["split"]: r["count"] for r in found if r["y"] is None} == own
    assert {r["split"]: r["count"] for r in found if r["y"] == "x"} == {k: 4 * n for k, n in own.items()}


def test_split_of_unknown_classes_is_null(spark):
    df = local_frame(spark, [("a", 0), ("b", 1), ("c", 7)], "id string, y int")
    rows = splitting.stratified_split(df, "id", "y", keys=df.filter("y < 2")).collect()
    assert {r["id"]: r["split"] is None for r in rows} == {"a": False, "b": False, "c": True}


def test_twenty_thousand_classes(spark):
    # Every class but one has seven rows; the other holds a third of all rows.
    df = spark.range(210_000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") < 140_000, F.col("id") % 20_000).otherwise(F.lit(20_000)).alias("y"),
    )
    folds = splitting.stratified_folds(df, "id", "y", folds=3).groupBy("y", "fold").count()
    spread = folds.groupBy("y").agg(F.min("count").alias("lo"), F.max("count").alias("hi"), F.count("*").alias("n"))
    assert spread.count() == 20_001
    assert spread.filter("hi - lo > 1 or n <> 3").count() == 0
    # The sizes of all parts of all classes, by the rule with integers on the driver.
    sizes = {y: 7 for y in range(20_000)} | {20_000: 70_000}
    n_dev = 210_000 - math.ceil(0.15 * 210_000)
    dev = shares_by_hand(sizes, n_dev)
    train = shares_by_hand(dev, n_dev - math.ceil(0.15 / 0.85 * n_dev))
    parts = splitting.stratified_split(df, "id", "y").groupBy("y").pivot("split", ["train", "test"]).count()
    got = {r["y"]: (r["train"], r["test"] or 0) for r in parts.collect()}
    assert got == {y: (train[y], sizes[y] - dev[y]) for y in sizes}


def test_folds_are_even_in_each_class(spark, tiny_buckets):
    df = local_frame(spark, [(f"c{i}", int(i % 10 < 3)) for i in range(203)], "id string, y int")
    folded = splitting.stratified_folds(df, "id", "y", folds=5)
    for y in (0, 1):
        sizes = [r["count"] for r in folded.filter(F.col("y") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 5
        assert max(sizes) - min(sizes) <= 1


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 4 + [(0,)] * 9, "y int")
    row = splitting.class_weights(df, "y").first()
    assert (row["positives"], row["negatives"]) == (4, 9)
    assert splitting.positive_weight(df, "y", "full") == 2.25
    assert splitting.positive_weight(df, "y", "sqrt") == 1.5
    assert splitting.positive_weight(df, "y", "none") == 1.0
    assert splitting.positive_weight(df.filter("y = 0"), "y", "full") == 9.0
    with pytest.raises(ValueError, match="pos_weight"):
        splitting.positive_weight(df, "y", "other")
    weights = splitting.with_weight(df, "y", 1.5).groupBy("y").agg(F.max("weight")).collect()
    assert {r[0]: r[1] for r in weights} == {0: 1.0, 1: 1.5}


@pytest.mark.parametrize("accuracy", [100_000, 20])
def test_quantiles_are_exact(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = random.Random(1)
    # A third of the values is one value, and the rest is skewed.
    values = [3.0] * 300 + [rng.lognormvariate(0, 2) for _ in range(600)]
    rows = [(i % 2, v) for i, v in enumerate(values)] + [(0, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = (0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = quantiles.exact_quantiles(df, ["v"], probs, by="g").collect()
    assert len(got) == 2 * len(probs)
    for r in got:
        own = [v for i, v in enumerate(values) if i % 2 == r["grp"]]
        assert r["value"] == pytest.approx(np.quantile(own, r["prob"]), rel=1e-12)


def test_describe_matches_numpy(spark):
    values = [1.0, 2.0, 2.0, 5.0, 9.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = quantiles.describe(df, ["v"]).first()
    assert row["count"] == 5
    assert row["mean"] == pytest.approx(np.mean(values))
    assert row["std"] == pytest.approx(np.std(values, ddof=1))
    assert (row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (1.0, 2.0, 2.0, 5.0, 9.5)


@pytest.mark.parametrize(
    "use",
    [
        lambda df: splitting.stratified_split(df, "id", "y"),
        lambda df: splitting.stratified_folds(df, "id", "y"),
        lambda df: sampling.sample_fixed(df, "id", 3),
    ],
)
def test_null_ids_are_refused(spark, use):
    df = local_frame(spark, [("a", 0), (None, 1), ("c", 0), ("d", 1)], "id string, y int")
    with pytest.raises(Exception, match="An id is NULL"):
        use(df).collect()


def test_quantiles_of_many_groups(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("g"), (F.col("id") * 1.0).alias("v"))
    found = quantiles.exact_quantiles(df, ["v"], [0.5], by="g")
    assert found.count() == 20_000
    assert found.filter(F.col("value") != F.col("grp") + 20_000).count() == 0
