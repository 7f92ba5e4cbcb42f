from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.telco import population
from tidemark.operators import curves
from tidemark.plans import boosting, estimators, experiment, search, training
from tidemark.plans.forest import columns_drawn
from tidemark.roles import BASELINE, TELCO


@pytest.fixture(scope="module")
def data(spark):
    return training.prepare(population(spark, 240), TELCO, BASELINE, folds=3)


def test_measures_equal_the_curves(spark):
    rows = [(i % 3 == 0, [((i * 7) % 11) / 10, 0.5, (i % 4) / 4]) for i in range(200)]
    scored = spark.createDataFrame([(int(y), ps) for y, ps in rows], "y int, ps array<double>")
    got = search.measures(scored, curves.METRICS)
    for i, own in enumerate(got):
        one = scored.select("y", F.col("ps")[i].alias("p"), (F.col("ps")[i] > 0.5).cast("int").alias("flag"))
        for m in curves.METRICS:
            assert own[m] == pytest.approx(curves.metric_value(one, m, flag="flag").first()["value"])
    none = search.measures(scored.where("y = 0"), curves.METRICS)
    assert none[0]["pr_auc"] == 0.0


@pytest.fixture
def fits(monkeypatch):
    """Counts passes of boosters and fits of other models."""
    made = []
    boost, forest = boosting.boost, estimators.RandomForestClassifier._fit
    monkeypatch.setattr(boosting, "boost", lambda *a, **k: made.append([s.steps for _, s in a[1]]) or boost(*a, **k))
    monkeypatch.setattr(estimators.RandomForestClassifier, "_fit", lambda self, rows: made.append("forest") or forest(self, rows))
    return made


def test_boosters_of_a_search_are_fitted_together(data, fits):
    spec = estimators.train_gbt_a(TELCO, grid={"maxIter": [2, 5], "maxDepth": [1, 2]})
    found = training.grid_search(spec, data.part("train"), metric="pr_auc", select_metric="mcc", folds=3)
    # One call: three folds and all rows, by two depths; the shorter models are parts of the longer.
    assert fits == [[5] * 8]
    assert len(found.means) == 4 and found.best == max(range(4), key=lambda i: found.means[i])
    chosen = spec.grid[found.best]
    assert {p.name: found.model.stages[-1].getOrDefault(p.name) for p in chosen} == {p.name: v for p, v in chosen.items()}
    assert len(found.model.stages[-1].state["trees"]) == chosen[spec.classifier.maxIter]


def test_scores_of_shared_fits_are_those_of_own_fits(data):
    train = data.part("train")
    spec = estimators.train_gbt_b(
        TELCO, grid={"maxIter": [3, 6], "stepSize": [0.1, 0.5]}, subsamplingRate=1.0, minInstancesPerNode=5
    )
    means, _ = training.cross_validate(spec, train, metric="pr_auc", folds=3)
    for params, mean in zip(spec.grid, means, strict=True):
        own = []
        for fold in range(3):
            fit_rows, held = train.filter(F.col("fold") != fold), train.filter(F.col("fold") == fold)
            prep = spec.prep.fit(fit_rows)
            model = spec.classifier.fit(prep.transform(fit_rows), params)
            scored = estimators.positive_probability(model.transform(prep.transform(held)))
            own.append(curves.metric_value(scored.select("y", "p"), "pr_auc").first()["value"])
        assert mean == pytest.approx(sum(own) / 3, abs=1e-6)


def test_one_forest_serves_its_smaller_shapes(data, fits):
    spec = estimators.train_random_forest(
        TELCO, grid={"numTrees": [3, 6], "maxDepth": [1, 4], "minInstancesPerNode": [1, 5]}
    )
    means, stds = training.cross_validate(spec, data.part("train"), metric="f1", folds=3)
    assert fits == ["forest"] * 6 and len(means) == len(stds) == 8
    assert all(0 <= m <= 1 for m in means) and max(means) > 0


def test_strategies_that_draw_as_many_features_are_one_forest(data, fits):
    size = len(estimators.prep(TELCO).fit(data.part("train")).feature_names())
    grid = {"numTrees": [2, 4], "featureSubsetStrategy": ["sqrt", str(columns_drawn("sqrt", size, 4)), "all"]}
    spec = estimators.train_random_forest(TELCO, grid=grid)
    means, _ = training.cross_validate(spec, data.part("train"), metric="pr_auc", folds=3)
    assert fits == ["forest"] * 6
    named = {(p["numTrees"], p["featureSubsetStrategy"]): m for p, m in zip(({q.name: v for q, v in g.items()} for g in spec.grid), means, strict=True)}
    for n in (2, 4):
        assert named[n, "sqrt"] == named[n, grid["featureSubsetStrategy"][1]] != named[n, "all"]


def test_a_ledger_spares_what_was_fitted(spark, data, fits, tmp_path):
    train, path = data.part("train"), str(tmp_path / "ledger")
    spec = estimators.train_random_forest(TELCO, grid={"maxDepth": [1, 3]}, numTrees=3)
    first = training.grid_search(spec, train, folds=3, ledger=search.Ledger(spark, path, train))
    assert fits == ["forest"] * 4
    again = training.grid_search(spec, train, folds=3, ledger=search.Ledger(spark, path, train))
    assert fits == ["forest"] * 4
    assert (again.means, again.stds, again.best) == (first.means, first.stds, first.best)
    assert again.model.stages[-1].toDebugString == first.model.stages[-1].toDebugString
    # Other settings, another metric or other rows are fitted.
    other = estimators.train_random_forest(TELCO, grid={"maxDepth": [1, 3]}, numTrees=4)
    training.cross_validate(other, train, folds=3, ledger=search.Ledger(spark, path, train))
    training.cross_validate(spec, train, folds=3, metric="mcc", ledger=search.Ledger(spark, path, train))
    few = train.filter(F.col("customerID") != train.first()["customerID"])
    training.cross_validate(spec, few, folds=3, ledger=search.Ledger(spark, path, few))
    assert fits == ["forest"] * 13


def test_a_stopped_run_goes_on(spark, fits, tmp_path, monkeypatch):
    options = {"models": ("random_forest", "gbt_b"), "forest": {"numTrees": 3, "grid": {"maxDepth": [1, 2]}}}
    options["booster"] = {"maxIter": 3, "grid": {"maxDepth": [1, 2]}}
    settings = training.RunSettings(folds=2, run_shap=False)
    raw, path = population(spark, 240), str(tmp_path / "run")
    boost = search.HistogramBooster.fit_groups
    monkeypatch.setattr(search.HistogramBooster, "fit_groups", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        experiment.run_training(raw, TELCO, path, run_id="r", settings=settings, **options)
    assert fits == ["forest"] * 3
    monkeypatch.setattr(search.HistogramBooster, "fit_groups", boost)
    done = experiment.run_training(raw, TELCO, path, run_id="r", settings=settings, **options)
    assert fits == ["forest"] * 3 + [[3] * 6]
    again = experiment.run_training(raw, TELCO, path, run_id="r", settings=settings, **options)
    assert len(fits) == 4
    assert again["models"] == done["models"]
