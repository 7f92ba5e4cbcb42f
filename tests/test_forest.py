"""Forests whose rows and trees stay on the executors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.plans import forest, trees
from tidemark.plans.forest import ForestModel, Growing, RandomForestClassifier, Rows

WHOLE = Growing(trees=1, depth=30, columns=3, least_rows=1, least_gain=0.0, rate=1.0, drawn=False, seed=1)


def rows_of(seed, n=300):
    rng = np.random.default_rng(seed)
    bins = np.stack([rng.integers(0, 8, n), rng.integers(0, 2, n), rng.integers(0, 5, n)]).astype(np.uint8)
    y = (bins[0] + 3 * bins[1] + rng.normal(0, 2, n) > 5).astype(np.int8)
    return Rows(bins, y, np.where(y == 1, 1.7, 1.0), rng.integers(1, 4, n))


def brute(rows, at, depth, least):
    """(share of class 1, or feature, bin and both sides) by trying every split."""
    w = (rows.w * rows.n)[at]
    p = w * rows.y[at]
    gini = lambda own: 2 * p[own].sum() * (1 - p[own].sum() / w[own].sum())
    best = None
    for f in range(len(rows.bins)):
        for b in range(8):
            low = rows.bins[f, at] <= b
            if min(rows.n[at][low].sum(), rows.n[at][~low].sum()) < least:
                continue
            gain = gini(slice(None)) - gini(low) - gini(~low)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, b, low)
    if best is None or not depth:
        return p.sum() / w.sum()
    sides = [brute(rows, at[s], depth - 1, least) for s in (best[3], ~best[3])]
    if not any(isinstance(s, list) for s in sides) and (sides[0] > 0.5) == (sides[1] > 0.5):
        return p.sum() / w.sum()
    return [best[0], *sides]


def listed(nodes, i=0):
    if nodes.feature[i] < 0:
        return nodes.value[i]
    return [nodes.gain[i], listed(nodes, nodes.left[i]), listed(nodes, nodes.right[i])]


def flat(tree):
    return [x for part in tree for x in flat(part)] if isinstance(tree, list) else [tree]


@pytest.mark.parametrize(("depth", "least"), [(30, 1), (4, 1), (30, 7)])
@pytest.mark.parametrize("cells", [1_000_000, 16])
def test_a_tree_of_all_features_equals_brute_force(monkeypatch, depth, least, cells):
    monkeypatch.setattr(forest, "CELLS", cells)
    rows = rows_of(depth)
    settings = Growing(**{**vars(WHOLE), "depth": depth, "least_rows": least})
    made = forest.assembled(None, {0: forest.grow(rows, 8, settings, 0, 0, 0)}, depth)
    want = brute(rows, np.arange(300), depth, least)
    got = flat(listed(made))
    assert len(got) == len(flat(want)) and got == pytest.approx(flat(want), rel=1e-9)


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(size=600), rng.integers(0, 2, 600), rng.integers(0, 30, 600)]
    y = (x[:, 0] + x[:, 1] + rng.normal(0, 0.5, 600) > 0.7).astype(int)
    rows = [(i, int(a), 1.0 + float(a), [float(v) for v in c]) for i, (a, c) in enumerate(zip(y, x, strict=True))]
    df = spark.createDataFrame(rows, "id int, y int, weight double, v array<double>")
    return df.withColumn("features", array_to_vector("v")).repartition(3).cache()


def probabilities(model, rows):
    scored = model.transform(rows).select("id", vector_to_array("probability")[1].alias("p"))
    return {r["id"]: r["p"] for r in scored.collect()}


OPTIONS = {"labelCol": "y", "weightCol": "weight", "seed": 5, "numTrees": 5, "maxDepth": 9}


def test_large_nodes_are_split_from_sums_of_blocks(monkeypatch, sample):
    """The same root whether a task grows the tree or all blocks do; every row is in its leaf."""
    local = RandomForestClassifier(**OPTIONS, featureSubsetStrategy="all").fit(sample)
    monkeypatch.setattr(forest, "LOCAL_CELLS", 300)
    spread = RandomForestClassifier(**OPTIONS, featureSubsetStrategy="all").fit(sample)
    tables = [{r["tree"]: forest.unpacked(r["data"]) for r in m.trees().collect()} for m in (local, spread)]
    assert tables[0].keys() == tables[1].keys() == set(range(5))
    for t, a in tables[0].items():
        b = tables[1][t]
        assert [a.feature[:3].tolist(), a.bin[:3].tolist(), len(a.feature)] == [b.feature[:3].tolist(), b.bin[:3].tolist(), len(b.feature)]
    assert spread.featureImportances.toArray() == pytest.approx(local.featureImportances.toArray(), abs=1e-9)
    want, got = probabilities(local, sample), probabilities(spread, sample)
    assert len(got) == 600 and [got[i] for i in want] == pytest.approx(list(want.values()), abs=1e-9)


@pytest.mark.parametrize(("least", "depth"), [(1, 30), (5, 6)])
def test_sums_of_whole_numbers_grow_the_trees_of_weighted_sums(monkeypatch, least, depth):
    """Features by bits of words, rows laid out anew by level, few looked up at once."""
    monkeypatch.setattr(forest, "LOOKED_UP", 90)
    rows = rows_of(11)
    rows.w = np.where(rows.y == 1, 2.0, 1.0)
    many = np.concatenate([rows.bins] * 9 + [np.random.default_rng(0).integers(0, 200, (7, 300)).astype(np.uint8)])
    for bins in (rows.bins, many):
        own = Rows(bins, rows.y, rows.w, rows.n)
        settings = Growing(**{**vars(WHOLE), "columns": len(bins), "least_rows": least, "depth": depth})
        fields = forest.Fields(bins.max(axis=1).astype(int) + 1)
        assert fields.words == (1 if bins is rows.bins else 2)
        got = forest.grow_counted(fields, fields.packed(bins), forest.counted(own.y, own.n), (1.0, 2.0), settings, 0, 0, 0)
        want = forest.grow_weighted(own, 200, settings, 0, 0, 0)
        assert flat(listed(got)) == pytest.approx(flat(listed(want)), rel=1e-9)
    assert forest.weights_by_label(rows.y, rows.w) == (1.0, 2.0)
    assert forest.weights_by_label(rows.y, np.arange(300.0)) is None


@pytest.mark.parametrize("weight", ["weight", "id + 1"])
def test_a_table_that_fits_is_sent_whole(monkeypatch, sample, weight):
    """Trees of rows sent tree by tree, from sums of blocks at the top, and of rows sent once to a task are the same."""
    rows = sample.withColumn("weight", F.expr(weight).cast("double"))
    options = {**OPTIONS, "featureSubsetStrategy": "all"}
    sent = []
    send = forest._split_tops
    monkeypatch.setattr(forest, "_split_tops", lambda *a: sent.append(1) or send(*a))
    whole = RandomForestClassifier(**options).fit(rows)
    assert not sent
    monkeypatch.setattr(forest, "WHOLE_CELLS", 0)
    monkeypatch.setattr(forest, "LOCAL_CELLS", 300)
    spread = RandomForestClassifier(**options).fit(rows)
    assert sent and whole.featureImportances.toArray() == pytest.approx(spread.featureImportances.toArray(), abs=1e-9)
    want, got = probabilities(whole, rows), probabilities(spread, rows)
    assert [got[i] for i in want] == pytest.approx(list(want.values()), abs=1e-9)


def test_a_node_ends_a_tree_up_to_a_depth():
    nodes = forest.assembled(None, {0: forest.grow(rows_of(5), 8, WHOLE, 0, 0, 0)}, 30)
    until, kind = forest.ends_until(nodes), nodes.value > 0.5
    for depth in (0, 1, 3, 6, 30):
        ends, at = forest.ends_of(nodes.feature, nodes.left, nodes.right, kind, depth), np.array([0])
        while len(at):
            assert (ends[at] == (until[at] >= depth)).all()
            inner = at[~ends[at]]
            at = np.concatenate([nodes.left[inner], nodes.right[inner]])


def test_the_driver_holds_no_trees_and_saving_keeps_them(sample, tmp_path):
    model = RandomForestClassifier(**OPTIONS).fit(sample)
    texts = [str(v) for v in model.extractParamMap().values()]
    nodes = model.state["nodes"]
    assert nodes > 200 and max(map(len, texts)) < 3_000
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "model"))
    want = probabilities(model, sample)
    model.discard()
    again = PipelineModel.load(str(tmp_path / "model")).stages[0]
    assert isinstance(again, ForestModel) and again.toDebugString == model.toDebugString
    assert probabilities(again, sample) == pytest.approx(want)
    y = {r["id"]: r["y"] for r in sample.collect()}
    assert np.mean([(p > 0.5) == y[i] for i, p in want.items()]) > 0.9


def test_shapes_are_the_smaller_forests(sample):
    whole = RandomForestClassifier(**OPTIONS).fit(sample)
    small = RandomForestClassifier(**{**OPTIONS, "numTrees": 3, "maxDepth": 2}).fit(sample)
    want = probabilities(small, sample)
    scored = whole.scores(sample.select("id", "features"), [(5, 9), (3, 2)], "ps").collect()
    assert {r["id"]: r["ps"][1] for r in scored} == pytest.approx(want)
    assert {r["id"]: r["ps"][0] for r in scored} == pytest.approx(probabilities(whole, sample))


def test_leaves_that_no_mix_reaches_are_not_looked_at():
    rows = rows_of(7)
    nodes = forest.grow(rows, 8, WHOLE, 0, 0, 0)
    tree = trees.TreeArrays(nodes.feature, nodes.bin.astype(float), nodes.left, nodes.right, nodes.value, nodes.value > 0.5)
    x, z = rows.bins.T[:6].astype(float), rows.bins.T[6:10].astype(float)
    paths = trees.paths_of(tree)
    assert trees.shapley_of([paths], x, z, [tree]) == pytest.approx(trees.shapley_of([paths], x, z), abs=1e-12)
    sides = trees._bits((z[:, np.maximum(tree.feature, 0)] <= tree.threshold).T)
    assert len(trees.reached(tree, x[0], sides)) < (tree.feature < 0).sum()


def test_edges(spark, sample):
    with pytest.raises(ValueError, match="No rows"):
        RandomForestClassifier(**OPTIONS).fit(sample.limit(0))
    with pytest.raises(ValueError, match="0 and 1"):
        RandomForestClassifier(**OPTIONS).fit(sample.withColumn("y", F.lit(2)))
    one = RandomForestClassifier(**OPTIONS).fit(sample.limit(1))
    assert one.getNumTrees == 5 and one.transform(sample.limit(0)).count() == 0
