from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.telco import population
from tidemark.operators.sampling import sample_fixed
from tidemark.plans import estimators, explain, training, trees
from tidemark.plans.boosting import HistogramBooster
from tidemark.roles import BASELINE, TELCO


@pytest.fixture(scope="module")
def data(spark):
    return training.prepare(population(spark, 240), TELCO, BASELINE, folds=3)


def random_tree(rng, d, depth):
    columns = {c: [] for c in ("feature", "threshold", "left", "right", "value", "kind")}

    def grow(level):
        i = len(columns["feature"])
        for c, v in zip(columns, (-1, 0.0, -1, -1, float(rng.normal()), 0.0), strict=True):
            columns[c].append(v)
        if level < depth and rng.random() < 0.9:
            columns["feature"][i], columns["threshold"][i] = int(rng.integers(d)), float(rng.integers(-2, 3))
            columns["left"][i] = grow(level + 1)
            columns["right"][i] = grow(level + 1)
        return i

    grow(0)
    return trees.TreeArrays(*(np.array(columns[c]) for c in columns))


def score(tree, row):
    i = 0
    while tree.feature[i] >= 0:
        i = tree.left[i] if row[tree.feature[i]] <= tree.threshold[i] else tree.right[i]
    return tree.value[i]


def enumerated(forest, x, z, d):
    """Shapley values by all subsets of features."""
    out = np.zeros(d)
    for size in range(d):
        for subset in itertools.combinations(range(d), size):
            weight = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
            for j in set(range(d)) - set(subset):
                for row in z:
                    without = row.copy()
                    without[list(subset)] = x[list(subset)]
                    with_j = without.copy()
                    with_j[j] = x[j]
                    out[j] += weight * sum(score(t, with_j) - score(t, without) for t in forest) / len(z)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shapley_values_equal_all_subsets_of_eight_features(seed):
    rng = np.random.default_rng(seed)
    d = 8
    forest = [random_tree(rng, d, 6) for _ in range(4)]
    x, z = rng.integers(-3, 4, (2, d)).astype(float), rng.integers(-3, 4, (3, d)).astype(float)
    got = trees.shapley_of([trees.paths_of(t) for t in forest], x, z)
    for own, row in zip(got, x, strict=True):
        assert own == pytest.approx(enumerated(forest, row, z, d), abs=1e-12)


def test_many_background_rows_and_trees_without_splits():
    rng = np.random.default_rng(5)
    forest = [random_tree(rng, 5, 4) for _ in range(6)] + [random_tree(rng, 5, 0)]
    x, z = rng.normal(size=(4, 5)) * 2, rng.normal(size=(150, 5)) * 2
    got = trees.shapley_of([trees.paths_of(t) for t in forest], x, z)
    base = np.mean([sum(score(t, r) for t in forest) for r in z])
    assert got.sum(axis=1) == pytest.approx([sum(score(t, r) for t in forest) - base for r in x])


@pytest.mark.parametrize("kind", ["forest", "booster"])
def test_values_add_up_to_the_score(data, kind):
    spec = (
        estimators.train_random_forest(TELCO, numTrees=7, maxDepth=8)
        if kind == "forest"
        else estimators.train_gbt_b(TELCO, maxIter=5, minInstancesPerNode=5)
    )
    train, held_out = data.part("train"), data.part("validation")
    model = spec.pipeline.fit(train)
    column = "probability" if kind == "forest" else "rawPrediction"
    options = {"n_background": 70, "n_explained": None}
    got = explain.tree_shapley_values(model, train, held_out, "customerID", **options)
    sums = {r["id"]: r["s"] for r in got.groupBy("id").agg(F.sum("value").alias("s")).collect()}

    def scores(rows):
        found = model.transform(rows).select("customerID", vector_to_array(column)[1])
        return dict(map(tuple, found.collect()))

    base = np.mean(list(scores(sample_fixed(train, "customerID", 70, salt="background:")).values()))
    want = scores(held_out)
    assert sums.keys() == want.keys() and len(want) == held_out.count()
    for i, p in want.items():
        assert sums[i] == pytest.approx(p - base, abs=1e-9)


def test_pruned_forests(data):
    """Whole shapes give the forest's own probabilities; cut ones those of the cut trees."""
    train = data.part("train")
    prep = estimators.prep(TELCO).fit(train)
    vectors = prep.transform(train).select("y", "weight", "features").cache()
    forest = RandomForestClassifier(numTrees=9, maxDepth=7, seed=1, labelCol="y", weightCol="weight").fit(vectors)
    arrays = trees.forest_arrays(forest)
    shapes = [(9, 7), (4, 7), (9, 2), (4, 0)]
    scored = forest.transform(vectors).withColumn("own", trees.forest_probabilities(arrays, shapes, "features"))
    rows = scored.select("y", "weight", vector_to_array("features").alias("v"), vector_to_array("probability")[1].alias("p"), "own").collect()
    assert [r["own"][0] for r in rows] == pytest.approx([r["p"] for r in rows])

    def cut(tree, row, depth):
        ends, i = trees.pruned(tree, depth), 0
        while not ends[i]:
            i = tree.left[i] if row[tree.feature[i]] <= tree.threshold[i] else tree.right[i]
        return tree.value[i]

    for r in rows[:20]:
        for (n, depth), p in zip(shapes[1:], r["own"][1:], strict=True):
            assert p == pytest.approx(np.mean([cut(t, r["v"], depth) for t in arrays[:n]]))
    for t in arrays:
        depth, ends = t.depths(), trees.pruned(t, 3)
        assert depth.max() <= 7 and (ends | (depth < 3)).all()
        assert (trees.pruned(t, 7) == (t.feature < 0)).all()


def test_only_trees_are_explained(data):
    logit = estimators.train_logreg(TELCO, maxIter=5).pipeline.fit(data.part("train"))
    with pytest.raises(ValueError, match="tree models"):
        explain.tree_shapley_values(logit, data.part("train"), data.part("test"), "customerID")
    booster = HistogramBooster(maxIter=2)
    model = estimators.ModelSpec("x", estimators.prep(TELCO), booster).pipeline.fit(data.part("train"))
    with pytest.raises(ValueError, match="No background"):
        explain.tree_shapley_values(model, data.part("train").limit(0), data.part("test"), "customerID")
