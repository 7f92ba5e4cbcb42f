from __future__ import annotations

import json
import math

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.plans import boosting
from tidemark.plans.boosting import BoostedModel, HistogramBooster

PLAIN = {"subsamplingRate": 1.0, "columnRate": 1.0}


def rows_of(seed, n=400):
    """Label, weight and four features: whole numbers, a 0/1 column, a rare one and a negative one."""
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 12, n), rng.integers(0, 2, n), rng.integers(0, 20, n) == 0, rng.integers(-5, 3, n)].astype(float)
    y = (x[:, 0] + 3 * x[:, 1] - x[:, 3] + rng.normal(0, 3, n) > 9).astype(int)
    return y, np.where(y == 1, 1.7, 1.0), x


@pytest.fixture(scope="module")
def sample(spark):
    y, w, x = rows_of(1)
    rows = [(int(a), float(b), [float(v) for v in c]) for a, b, c in zip(y, w, x, strict=True)]
    df = spark.createDataFrame(rows, "y int, weight double, v array<double>")
    df = df.select("y", "weight", array_to_vector("v").alias("features")).repartition(3).cache()
    return df, y, w, x


def table_of(df):
    part = df.select("y", "weight", vector_to_array("features").alias("v")).toPandas()
    return part.assign(**{f"x{i}": part["v"].str[i] for i in range(4)}).drop(columns="v")


GAINS = """
WITH g AS (SELECT *, weight * ({p} - y) AS g, weight * {p} * (1 - {p}) AS h FROM t),
t0 AS (SELECT sum(g) AS tg, sum(h) AS th FROM g),
l AS (UNPIVOT g ON x0, x1, x2, x3 INTO NAME f VALUE v),
s AS (SELECT f, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM l GROUP BY f, v),
c AS (SELECT f, v, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(n) OVER w AS ln, sum(n) OVER (PARTITION BY f) AS n
  FROM s WINDOW w AS (PARTITION BY f ORDER BY v))
SELECT f, v AS threshold, lg * lg / (lh + {l2}) + (tg - lg) * (tg - lg) / (th - lh + {l2}) - tg * tg / (th + {l2}) AS gain,
  -lg / (lh + {l2}) * 0.5 AS low, -(tg - lg) / (th - lh + {l2}) * 0.5 AS high, ln, n - ln AS hn
FROM c, t0 WHERE ln < n AND lh >= {least} AND th - lh >= {least} AND ln >= {rows} AND n - ln >= {rows}
ORDER BY gain DESC, f, v LIMIT 1
"""


@pytest.mark.parametrize(
    ("options", "l2", "least", "rows"),
    [
        ({"growth": "level", "l2": 1.0, "minCurvature": 1.0}, 1.0, 1.0, 1),
        ({"growth": "leaf", "l2": 0.0, "minCurvature": 1e-3, "minInstancesPerNode": 20}, 0.0, 1e-3, 20),
        ({"growth": "leaf", "l2": 5.0, "minInstancesPerNode": 150, "minCurvature": 40.0}, 5.0, 40.0, 150),
    ],
)
def test_one_split_equals_sql(sample, options, l2, least, rows):
    df, *_ = sample
    model = HistogramBooster(maxIter=1, maxDepth=1, stepSize=0.5, **PLAIN, **options).fit(df)
    db = duckdb.connect()
    db.register("t", table_of(df))
    f, threshold, gain, low, high, ln, hn = db.execute(GAINS.format(p=0.5, l2=l2, least=least, rows=rows)).fetchone()
    tree = model.state["trees"][0]
    assert (tree["feature"], tree["threshold"][0]) == ([int(f[1:]), -1, -1], threshold)
    assert tree["gain"][0] == pytest.approx(gain, rel=1e-12)
    assert tree["value"][1:] == pytest.approx([low, high], rel=1e-12)
    assert tree["rows"] == [ln + hn, ln, hn]


def test_start_from_the_mean_equals_sql(sample):
    df, y, w, _ = sample
    model = HistogramBooster(maxIter=1, maxDepth=1, stepSize=0.5, startFromMean=True, **PLAIN).fit(df)
    share = float((w * y).sum() / w.sum())
    assert model.state["base"] == pytest.approx(math.log(share / (1 - share)))
    db = duckdb.connect()
    db.register("t", table_of(df))
    f, threshold, gain, low, high, *_ = db.execute(GAINS.format(p=repr(share), l2=1.0, least=1.0, rows=1)).fetchone()
    tree = model.state["trees"][0]
    assert (tree["feature"][0], tree["threshold"][0]) == (int(f[1:]), threshold)
    assert tree["value"][1:] == pytest.approx([low, high], rel=1e-9)


def brute(y, w, x, steps, depth, leaves, rate=0.3, l2=1.0, least=1.0):
    """Trees grown on the whole matrix, all distinct values as thresholds; a list of (split or value)."""
    margin = np.zeros(len(y))
    gains = []
    for _ in range(steps):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        score = lambda at: g[at].sum() ** 2 / (h[at].sum() + l2)

        def best(at, score=score, h=h):
            found = None
            for f in range(x.shape[1]):
                for t in np.unique(x[at, f])[:-1]:
                    low, high = at[x[at, f] <= t], at[x[at, f] > t]
                    if min(h[low].sum(), h[high].sum()) < least:
                        continue
                    gain = score(low) + score(high) - score(at)
                    if gain > 1e-6 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, low, high)
            return found

        open_leaves = [(np.arange(len(y)), 0)]
        done, count = [], 1
        while open_leaves:
            options = [(best(at) if d < depth else None) for at, d in open_leaves]
            i = max(range(len(options)), key=lambda i: options[i][0] if options[i] else -1)
            if options[i] is None or count >= leaves:
                break
            gains.append(options[i][0])
            at, d = open_leaves.pop(i)
            open_leaves += [(options[i][1], d + 1), (options[i][2], d + 1)]
            count += 1
        for at, _ in [*open_leaves, *done]:
            margin[at] += -g[at].sum() / (h[at].sum() + l2) * rate
    return margin, gains


@pytest.mark.parametrize(("growth", "depth", "leaves"), [("level", 3, 8), ("leaf", 6, 5), ("leaf", 4, 11)])
def test_whole_models_equal_brute_force(monkeypatch, sample, growth, depth, leaves):
    monkeypatch.setattr(boosting, "PASSES", 5)
    df, y, w, x = sample
    options = {"growth": growth, "maxDepth": depth, "maxLeaves": leaves, "maxIter": 4, "stepSize": 0.3}
    model = HistogramBooster(**options, **PLAIN).fit(df)
    margin, gains = brute(y, w, x, 4, depth, leaves)
    own = sorted(g for t in model.state["trees"] for g in t["gain"] if g)
    assert own == pytest.approx(sorted(gains), rel=1e-6)
    scored = model.transform(df).select(vector_to_array("features").alias("v"), vector_to_array("rawPrediction")[1].alias("m"))
    by_row = {tuple(r["v"]): r["m"] for r in scored.collect()}
    assert [by_row[tuple(r)] for r in x] == pytest.approx(list(margin), rel=1e-6, abs=1e-9)


def test_sparse_and_dense_vectors_give_the_same_model(spark, sample):
    df, y, w, x = sample
    rows = [(int(a), float(b), Vectors.sparse(4, [i for i in range(4) if c[i]], [v for v in c if v])) for a, b, c in zip(y, w, x, strict=True)]
    sparse = spark.createDataFrame(rows, ["y", "weight", "features"])
    own = HistogramBooster(maxIter=3, **PLAIN)
    dense_trees, sparse_trees = own.fit(df).state["trees"], own.fit(sparse).state["trees"]
    for a, b in zip(dense_trees, sparse_trees, strict=True):
        assert (a["feature"], a["threshold"]) == (b["feature"], b["threshold"])
        assert a["value"] == pytest.approx(b["value"], rel=1e-9)


def test_a_prefix_is_the_shorter_model(sample):
    df, *_ = sample
    own = HistogramBooster(maxDepth=3)
    longer, shorter = own.fit(df, {own.maxIter: 20}), own.fit(df, {own.maxIter: 10})
    assert longer.state["trees"][:10] == shorter.state["trees"]
    assert longer.prefix(10).state == shorter.state
    maps = [{own.maxIter: 20}, {own.maxIter: 10}, {own.maxIter: 10, own.maxDepth: 2}]
    together = own.fit_groups(df, [(0, m) for m in maps])
    assert [m.state["trees"] for m in together[:2]] == [longer.state["trees"], shorter.state["trees"]]
    assert together[2].state["trees"] == own.fit(df, maps[2]).state["trees"]
    assert together[1].getOrDefault("maxIter") == 10


def test_groups_learn_from_their_own_rows(sample):
    df, *_ = sample
    cut = df.withColumn("part", (F.rand(3) > 0.5).cast("int")).cache()
    own = HistogramBooster(maxIter=3, maxDepth=2, **PLAIN)
    together = own.fit_groups(cut, [(0, {}), (1, {})], "part")
    for part, model in enumerate(together):
        alone = own.fit(cut.where(F.col("part") == part))
        for a, b in zip(model.state["trees"], alone.state["trees"], strict=True):
            assert (a["feature"], a["threshold"]) == (b["feature"], b["threshold"])
            assert a["value"] == pytest.approx(b["value"], rel=1e-9)


def test_rates_are_drawn_once_per_tree(sample):
    df, *_ = sample
    model = HistogramBooster(maxIter=12, maxDepth=4, columnRate=0.5, subsamplingRate=0.5).fit(df)
    for t in model.state["trees"]:
        assert len({f for f in t["feature"] if f >= 0}) <= 2
        assert 100 < t["rows"][0] < 300
    assert len({f for t in model.state["trees"] for f in t["feature"]}) > 3


@pytest.mark.parametrize(("growth", "leaves", "at_once"), [("level", 8, 7), ("leaf", 5, 10**6)])
def test_a_model_that_fits_a_task_takes_no_passes(monkeypatch, sample, growth, leaves, at_once):
    """Rows of a group are sent to the model's task once; the trees are those of passes over all tasks."""
    df, *_ = sample
    cut = df.withColumn("part", (F.rand(3) > 0.5).cast("int")).cache()
    own = HistogramBooster(maxIter=20, maxDepth=3, growth=growth, maxLeaves=leaves, subsamplingRate=0.7, startFromMean=True)
    asked = [(0, {}), (1, {}), (1, {own.maxDepth: 4}), (2, {})]
    sent = []
    order = boosting.Order
    monkeypatch.setattr(boosting, "Order", lambda *args: sent.append(1) or order(*args))
    monkeypatch.setattr(boosting, "SUMMED_AT_ONCE", at_once)
    whole = own.fit_groups(cut, asked, "part")
    assert not sent and whole[3].state["trees"] == []
    monkeypatch.setattr(boosting, "WHOLE_CELLS", 0)
    passes = own.fit_groups(cut, asked, "part")
    assert len(sent) > 60
    for a, b in zip(whole, passes, strict=True):
        for s, t in zip(a.state["trees"], b.state["trees"], strict=True):
            assert all(s[c] == t[c] for c in ("feature", "threshold", "left", "right", "rows"))
            assert s["value"] == pytest.approx(t["value"], rel=1e-7, abs=1e-12)


@pytest.mark.parametrize("dense", [0, 10**9])
def test_sums_of_a_table_equal_those_of_its_blocks(monkeypatch, dense):
    monkeypatch.setattr(boosting, "DENSE", dense)
    rng = np.random.default_rng(6)
    ends = [np.array([0.0 if f % 2 else -1.0]) for f in range(11)] + [np.zeros(0), np.arange(-3.0, 4), np.arange(0.0, 300)]
    layout = boosting.Layout(len(ends), ends)
    blocks = []
    for number in (5, 2):
        x = np.c_[rng.integers(0, 2, (90, 11)) * np.where(np.arange(11) % 2, 1, -1), np.ones(90), rng.integers(-5, 6, 90), rng.integers(0, 400, 90)]
        rows, index = np.nonzero(x)
        cells = layout.cells_of(index, x[rows, index].astype(float))
        blocks.append(boosting.Block(layout, 0, number, rng.random(90), rng.random(90), rows.astype(np.int32), cells))
    g, h, at = rng.random(180), rng.random(180), np.sort(rng.permutation(180)[:70])
    slot = np.full(180, -1)
    slot[at] = 0
    # The block of the smaller number comes first.
    parts = [b.sums(layout, slot[o : o + 90], 1, g[o : o + 90], h[o : o + 90]) for b, o in zip(blocks[::-1], (0, 90), strict=True)]
    sums, total = boosting.Table(layout, blocks).sums(at, g, h)
    assert total == pytest.approx(sum(p[1][0] for p in parts))
    # A sparse block leaves the zeros to the rest.
    known = np.ones(layout.cells, bool)
    known[layout.start[:-1] + layout.zero] = False
    assert sums[known] == pytest.approx(sum(p[0][0] for p in parts)[known])


def test_saved_and_reloaded(tmp_path, sample):
    df, *_ = sample
    model = HistogramBooster(maxIter=3).fit(df)
    path = str(tmp_path / "model")
    PipelineModel([model]).save(path)
    again = PipelineModel.load(path).stages[0]
    assert isinstance(again, BoostedModel) and again.state == model.state
    scored = [m.transform(df).select("probability", "prediction").collect() for m in (model, again)]
    assert scored[0] == scored[1]
    assert sum(model.featureImportances.toArray()) == pytest.approx(1.0)


def test_edges(spark, sample):
    df, *_ = sample
    for few in (df.limit(0), df.where("y = 1"), df.limit(1)):
        model = HistogramBooster(maxIter=2, startFromMean=True).fit(few)
        assert model.transform(df).where("probability IS NULL").count() == 0
        json.loads(model.getOrDefault("ensemble"))
    clash = df.withColumns({c: F.lit("clash") for c in ("_group", "_size", "_entries", "_v", "i", "x", "block", "w")})
    assert HistogramBooster(maxIter=2).fit(clash).state["trees"]
    with pytest.raises(ValueError, match="Growth"):
        HistogramBooster(growth="sideways")


def test_a_pass_places_rows_in_few_trees(monkeypatch, sample):
    df, *_ = sample
    sent = []

    order = boosting.Order
    own = HistogramBooster(maxIter=10, maxDepth=2)
    monkeypatch.setattr(boosting, "Order", lambda *args: sent.append(len(args[4])) or order(*args))
    state = own.fit(df).state
    # Twenty passes, none of which writes: the margins are kept on the way.
    assert len(sent) == 20 and max(sent) <= 2
    assert len(state["trees"]) == 10


@pytest.mark.parametrize("dense", [0, 10**9])
def test_sums_of_a_block_equal_its_rows(monkeypatch, dense):
    monkeypatch.setattr(boosting, "DENSE", dense)
    rng = np.random.default_rng(4)
    n, zeros = 500, [np.array([0.0]), np.array([-1.0])]
    # Eleven features of two bins, the zero's left or right of the other, one of a single bin, two of many.
    ends = [zeros[f % 2] for f in range(11)] + [np.zeros(0), np.arange(-3.0, 4), np.arange(0.0, 300)]
    layout = boosting.Layout(len(ends), ends)
    x = np.c_[rng.integers(0, 2, (n, 11)) * np.where(np.arange(11) % 2, -1, 1), np.ones(n), rng.integers(-5, 6, n), rng.integers(0, 400, n)]
    rows, index = np.nonzero(x)
    order = rng.permutation(len(rows))
    rows, index = rows[order], index[order]
    y, w, g, h = (rng.random(n) for _ in range(4))
    block = boosting.Block(layout, 0, 1, y, w, rows.astype(np.int32), layout.cells_of(index, x[rows, index].astype(float)))
    assert block.dense == (dense > 0)
    slot = rng.integers(-1, 3, n)
    sums, totals = block.sums(layout, slot, 3, g, h)
    for s in range(3):
        at = slot == s
        assert totals[s] == pytest.approx([g[at].sum(), h[at].sum(), at.sum()])
        for f, own in enumerate(ends):
            bins = np.searchsorted(own, x[:, f])
            for b in range(len(own) + 1):
                if b != layout.zero[f]:
                    here = at & (bins == b)
                    assert sums[s, layout.start[f] + b] == pytest.approx([g[here].sum(), h[here].sum(), here.sum()])
    tree = boosting.Tree()
    for f, b, left, right in ((12, 3, 1, 2), (9, 0, 3, 4), (8, 0, 5, 6), (13, 250, 7, 8), *[(-1, -1, -1, -1)] * 5):
        tree.add(0.0, 0.0)
        tree.feature[-1], tree.bin[-1], tree.left[-1], tree.right[-1] = f, b, left, right
    places = block.chosen(layout, tree, list(range(9)), {})
    for row, place in zip(x, places, strict=True):
        at = 0
        while tree.feature[at] >= 0:
            f = tree.feature[at]
            at = tree.left[at] if np.searchsorted(ends[f], row[f]) <= tree.bin[at] else tree.right[at]
        assert at == place
