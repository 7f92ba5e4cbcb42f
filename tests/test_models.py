from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.telco import customers, population
from tidemark.operators import cleaning, scores, splitting
from tidemark.operators.scores import ScoreColumns
from tidemark.plans import estimators, experiment, explain, release, scoring, training
from tidemark.roles import BASELINE, ENGINEERED, TELCO
from tidemark.session import local_frame
from tidemark.sources.metrics import metrics_frame, read_metrics
from tidemark.sources.predictions import read_predictions

FOREST = {"numTrees": 5, "maxDepth": 4}
BOOSTER = {"maxIter": 3, "maxDepth": 2}
COLS = ScoreColumns(id="customerID", probability="churn_probability", flag="churn_flag")


@pytest.fixture(scope="module")
def data(spark):
    return training.prepare(population(spark, 240), TELCO, BASELINE, folds=3)


@pytest.fixture(scope="module")
def suite(data):
    specs = estimators.model_specs(TELCO, tune=False, forest=FOREST, booster=BOOSTER)
    return training.train_suite(specs, data, TELCO, folds=3)


@pytest.fixture(scope="module")
def logit(data):
    return estimators.train_logreg(TELCO, maxIter=50).pipeline.fit(data.part("train"))


def test_prepared_rows(data):
    rows = data.rows.collect()
    assert len(rows) == 240
    assert {r["split"] for r in rows} == {"train", "validation", "test"}
    assert all((r["fold"] is None) == (r["split"] != "train") for r in rows)
    train = [r for r in rows if r["split"] == "train"]
    pos = sum(r["y"] for r in train)
    assert data.weight == pytest.approx(math.sqrt((len(train) - pos) / pos))
    assert {r["weight"] for r in train if r["y"] == 1} == {data.weight}
    assert "gender" not in data.rows.columns


def test_suite_results(spark, suite):
    assert list(suite) == ["logreg", "random_forest", "gbt_a", "gbt_b"]
    for model in suite.values():
        assert 0.0 <= model.threshold <= 1.0
        assert model.test["rows"] == 36
        assert model.test["tn"] + model.test["fp"] + model.test["fn"] + model.test["tp"] == 36
        assert sum(g["n"] for g in model.groups) == 36
        assert 0.5 < model.test["roc_auc"] <= 1.0
    best = training.winner(suite)
    assert suite[best].cv_score == max(m.cv_score for m in suite.values())


def test_champion_report(spark, suite):
    metrics = training.suite_metrics(spark, suite, "r1")
    row = training.champion_report(metrics, "random_forest").first()
    forest = suite["random_forest"]
    assert row["report_recall"] == forest.test["recall"]
    assert row["development_validation_recall"] == forest.validation["recall"]
    assert row["development_cv_f1"] == forest.cv_score
    assert row["threshold"] == forest.threshold


def test_report_is_apart_from_development(spark):
    rows = [
        ("r", "logreg", "cv", "cv_score", 0.61),
        ("r", "logreg", "validation", "recall", 0.75),
        ("r", "logreg", "test", "recall", 0.72),
        ("r", "logreg", "validation", "threshold", 0.42),
    ]
    row = training.champion_report(metrics_frame(spark, rows), "logreg").first()
    assert row["report_recall"] == 0.72
    assert row["development_validation_recall"] == 0.75
    assert row["development_cv_f1"] == 0.61
    assert row["threshold"] == 0.42


def test_grid_search_keeps_the_best(spark, data):
    spec = estimators.train_random_forest(TELCO, numTrees=3, grid={"maxDepth": [1, 4]})
    fitted = training.grid_search(spec, data.part("train"), metric="mcc", folds=3)
    table = training.grid_table(spark, spec, fitted).collect()
    assert [json.loads(r["params"])["maxDepth"] for r in table] == [1, 4]
    best = max(table, key=lambda r: r["mean"])
    assert fitted.best == best["position"]
    assert fitted.model.stages[-1].getOrDefault("maxDepth") == json.loads(best["params"])["maxDepth"]


def test_full_grids():
    specs = {s.name: s for s in estimators.model_specs(TELCO)}
    assert {n: len(s.grid) for n, s in specs.items()} == {
        "logreg": 1, "random_forest": 32, "gbt_a": 12, "gbt_b": 12
    }
    forest = specs["random_forest"].classifier
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (300, 30)


def test_linear_model_levels():
    full, slim = estimators.train_logreg(TELCO), estimators.train_logreg(TELCO, selected=["num__tenure"])
    assert full.prep.getOrDefault("dropFirst")
    assert not slim.prep.getOrDefault("dropFirst")


def test_penalty_matches_its_definition(spark):
    """The gradient of C * weighted loss + |w|^2 / 2 is zero at the fitted coefficients."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2))
    y = (x[:, 0] + 0.5 * rng.normal(size=60) > 0).astype(int)
    w = np.where(y == 1, 1.7, 1.0)
    rows = [(int(a), float(b), [float(v) for v in c]) for a, b, c in zip(y, w, x, strict=True)]
    df = spark.createDataFrame(rows, "y int, weight double, v array<double>")
    from pyspark.ml.functions import array_to_vector

    df = df.select("y", "weight", array_to_vector("v").alias("features"))
    model = estimators.PenalisedLogit(inverseStrength=0.5, maxIter=500).fit(df)
    beta, intercept = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ beta + intercept)))
    gradient = 0.5 * (x * (w * (p - y))[:, None]).sum(axis=0) + beta
    assert np.abs(gradient).max() < 1e-3
    assert abs((w * (p - y)).sum()) < 1e-3


def test_metric_choice():
    assert training.resolve_training_metrics("f2") == ("f2", "f2")
    with pytest.warns(UserWarning, match="differs"):
        assert training.resolve_training_metrics("f1", "pr_auc") == ("pr_auc", "f1")
    with pytest.raises(ValueError, match="Unknown metric"):
        training.resolve_training_metrics("accuracy")


def test_run_config(spark):
    config = training.run_config(training.RunSettings(feature_set=ENGINEERED), 1.66384)
    assert config["pos_weight_value"] == 1.6638
    assert config["data_split"] == {"train": 0.7, "validation": 0.15, "test": 0.15}
    assert config["metrics_aligned"]
    assert (config["grid_metric"], config["select_metric"]) == ("f1", "f1")
    row = training.run_config_frame(spark, "r", config).first()
    assert json.loads(row["config"]) == config


def test_save_load_and_parity(spark, suite, tmp_path):
    model = suite["random_forest"].pipeline
    path = str(tmp_path / "forest")
    training.save_model(model, path)
    raw = population(spark, 60, seed=9).drop("Churn")
    options = {"threshold": 0.4, "model_name": "random_forest", "model_version": "v1", "cols": COLS}
    a = scoring.score_batch(raw, model, TELCO, **options)
    b = scoring.score_batch(raw, training.load_model(path), TELCO, **options)
    assert tuple(scores.score_parity(a, b, cols=COLS).first()) == (60, 0, 0, 0, 0)
    assert tuple(scores.score_parity(a, b.withColumn("churn_flag", 1 - F.col("churn_flag")), cols=COLS).first())[4] == 60
    with pytest.raises(FileNotFoundError):
        training.load_model(str(tmp_path / "none"))


def test_a_pipeline_without_classifier_is_refused(spark, data, tmp_path):
    stage = estimators.prep(TELCO)
    path = str(tmp_path / "prep")
    training.save_model(Pipeline(stages=[stage]).fit(data.rows), path)
    with pytest.raises(TypeError):
        training.load_model(path)


def test_scores_keep_their_id(spark, logit):
    raw = customers(
        spark,
        {"customerID": "low-risk", "tenure": 60, "TotalCharges": "3000"},
        {"customerID": "high-risk", "tenure": 2, "TotalCharges": "100"},
        {"customerID": "broken", "tenure": 2, "TotalCharges": ""},
    ).drop("Churn")
    scored = scoring.score_batch(
        raw, logit, TELCO, threshold=0.5, model_name="logreg", model_version="v1", cols=COLS
    )
    rows = {r["customerID"]: r for r in scored.collect()}
    assert set(rows) == {"low-risk", "high-risk"}
    assert rows["high-risk"]["churn_probability"] > rows["low-risk"]["churn_probability"]
    assert all(r["churn_flag"] == int(r["churn_probability"] >= 0.5) for r in rows.values())


def test_missing_feature_is_reported(spark, logit):
    raw = population(spark, 5).drop("Churn", "Contract")
    with pytest.raises(Exception, match="Contract"):
        scoring.score_batch(raw, logit, TELCO, threshold=0.5, model_name="m", model_version="v")


def test_score_and_append(spark, logit, tmp_path):
    path = str(tmp_path / "predictions")
    raw = population(spark, 30, seed=2).drop("Churn")
    options = {"source_table": "t", "threshold": 0.5, "model_name": "logreg", "model_version": "v1", "cols": COLS}
    for run in ("r1", "r2", "r2"):
        summary = scoring.score_and_append(raw, logit, TELCO, path, run_id=run, **options).collect()
        assert [(r["run_id"], r["scored"], r["threshold"]) for r in summary] == [(run, 30, 0.5)]
    table = read_predictions(spark, path, COLS)
    assert table.count() == 60
    assert summary[0]["flagged"] == table.filter("run_id = 'r2'").agg(F.sum("churn_flag")).first()[0]
    with pytest.raises(ValueError, match="is empty"):
        scoring.score_and_append(raw.limit(0), logit, TELCO, path, **options)


def test_scores_next_to_the_actual_label(spark, logit):
    raw = customers(spark, {"customerID": "a", "Churn": True}, {"customerID": "b"}, {"customerID": "c"})
    options = {"threshold": 0.5, "model_name": "logreg", "cols": COLS}
    rows = scoring.score_one_with_actual(raw, ["a", "b"], logit, TELCO, **options).collect()
    assert {r["customerID"]: r["actual"] for r in rows} == {"a": 1, "b": 0}
    with pytest.raises(ValueError, match="No row found"):
        scoring.score_one_with_actual(raw, ["q"], logit, TELCO, **options)


def test_rescoring_recreates_the_test_part(spark, data, logit):
    scored = training.rescore_test(logit, population(spark, 240), TELCO)
    again = training.score_labelled(logit, data.part(splitting.TEST), TELCO)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, again.collect()))


def test_importances_are_ranked(suite):
    rows = explain.tree_importance(suite["random_forest"].pipeline, 5).collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True)


def test_probe_audit(data):
    audit = explain.probe_audit(data.part("train"), TELCO, folds=3, **FOREST)
    rows = audit.collect()
    probes = [r for r in rows if r["probe"]]
    assert len(probes) == 3
    assert all("probe" in r["feature"] for r in probes)
    limit = sum(r["importance"] for r in probes) / 3
    assert all(r["threshold"] == pytest.approx(limit) for r in rows)
    features = [r for r in rows if not r["probe"]]
    dropped = [r for r in features if r["dropped"]]
    kept = explain.probe_kept(audit)
    assert len(kept) + len(dropped) == len(features)
    assert kept == [r["feature"] for r in features if r["importance"] >= limit]
    assert "num__tenure" in kept
    spec = estimators.train_random_forest(TELCO, selected=kept, **FOREST)
    model = spec.pipeline.fit(data.part("train"))
    assert model.stages[-1].numFeatures == len(kept)


def test_kept_names_follow_importance(spark):
    rows = [
        ("num__tenure", 0.1, False, 0.05, False),
        ("cat__Partner_False", 0.01, False, 0.05, True),
        ("cat__Contract_Month-to-month", 0.08, False, 0.05, False),
        ("binary_probe_0", 0.05, True, 0.05, False),
    ]
    audit = local_frame(spark, rows, "feature string, importance double, probe boolean, threshold double, dropped boolean")
    assert explain.probe_kept(audit) == ["num__tenure", "cat__Contract_Month-to-month"]


def test_shapley_is_exact_for_a_linear_margin(data, logit):
    """For a linear model the value is weight times the distance to the background mean."""
    train, held_out = data.part("train"), data.part("validation")
    got = explain.shapley_values(
        logit, train, held_out, "customerID", draws=20, output="margin", n_background=20, n_explained=4
    ).collect()
    stage, classifier = logit.stages
    names, weights = stage.feature_names(), classifier.coefficients.toArray()
    from tidemark.operators.sampling import sample_fixed

    def matrix(rows, n, salt):
        picked = stage.transform(sample_fixed(rows, "customerID", n, salt=salt))
        return {r[0]: r[1] for r in picked.select("customerID", vector_to_array("features")).collect()}

    mean = np.mean(list(matrix(train, 20, "background:").values()), axis=0)
    explained = matrix(held_out, 4, "explain:")
    assert {r["id"] for r in got} == set(explained)
    assert len(got) == 4 * len(names)
    for r in got:
        j = names.index(r["feature"])
        assert r["value"] == pytest.approx(weights[j] * (explained[r["id"]][j] - mean[j]), abs=1e-9)


def test_shapley_values_add_up(data, suite):
    model = suite["random_forest"].pipeline
    got = explain.shapley_values(
        model, data.part("train"), data.part("validation"), "customerID", draws=10, n_background=10, n_explained=3
    )
    sums = {r["id"]: r["s"] for r in got.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    from tidemark.operators.sampling import sample_fixed

    def probabilities(rows, n, salt):
        picked = model.transform(sample_fixed(rows, "customerID", n, salt=salt))
        return {r[0]: r[1][1] for r in picked.select("customerID", vector_to_array("probability")).collect()}

    base = np.mean(list(probabilities(data.part("train"), 10, "background:").values()))
    for i, p in probabilities(data.part("validation"), 3, "explain:").items():
        assert sums[i] == pytest.approx(p - base)


def test_shapley_importance_is_for_trees(data, logit):
    with pytest.raises(ValueError, match="tree models"):
        explain.shap_importance(logit, data.part("train"), data.part("test"), "customerID")


def test_odds_ratios(spark):
    rows = explain.odds_ratios(
        population(spark, 200), TELCO, "Contract", ["tenure", "MonthlyCharges", "TotalCharges"]
    ).collect()
    assert len([r for r in rows if r["drop_first"]]) == 2
    assert len([r for r in rows if not r["drop_first"]]) == 6
    assert all(r["odds_ratio"] == pytest.approx(math.exp(r["beta"])) for r in rows)


def test_manifest(spark, suite, tmp_path):
    metrics = training.suite_metrics(spark, suite, "r1")
    options = {"model_id": "forest", "release_id": "v1", "artifact": "m"}
    manifest = release.release_manifest(
        metrics, TELCO, model="random_forest", provenance={"commit": "abc"},
        run_config=training.run_config(training.RunSettings(), 1.5), **options,
    )
    path = str(tmp_path / "manifest")
    release.write_manifest(manifest, path)
    read = release.read_manifest(spark, path).first()
    forest = suite["random_forest"]
    assert read["release_id"] == "v1"
    assert read["threshold"] == forest.threshold
    assert read["headline_metrics"]["f1"] == forest.test["f1"]
    assert set(read["headline_metrics"]) == set(release.HEADLINE)
    assert read["validation_metrics"]["recall"] == forest.validation["recall"]
    assert json.loads(read["run_config"])["pos_weight_mode"] == "sqrt"
    assert len(read["feature_columns"]) == 18
    assert read["provenance"] == {"commit": "abc"}
    assert read["packaged_at"]
    with pytest.raises(Exception, match="No threshold"):
        release.release_manifest(metrics, TELCO, model="none", **options).collect()


def test_unknown_labels_stop_a_training(spark):
    raw = customers(spark, {"Churn": True}, {"customerID": "c-2", "Churn": None})
    with pytest.raises(ValueError, match="1 rows have a label of neither class"):
        training.prepare(raw, TELCO)


def test_threshold_fallback():
    assert release.threshold_of({"threshold": 0.441}) == 0.441
    assert release.threshold_of({"test": {"threshold": 0.5}}) == 0.5
    with pytest.raises(KeyError):
        release.threshold_of({"test": {}})


def test_baseline_and_legacy_summary(spark, suite, tmp_path):
    path = str(tmp_path / "baseline")
    metrics = training.suite_metrics(spark, suite, "r1")
    training.write_baseline(metrics, path)
    assert training.read_baseline(spark, path).count() == 4 * len(training.REPORT)
    nested = {"models": {"a": {"report": {"recall": 0.72, "f1": 0.63}}, "b": {"test_recall": 0.71, "test_f1": 0.62}}}
    (tmp_path / "summary.json").write_text(json.dumps(nested, indent=2))
    rows = training.read_summary(spark, str(tmp_path / "summary.json")).collect()
    assert {(r["model"], r["metric"]): r["value"] for r in rows} == {
        ("a", "recall"): 0.72, ("a", "f1"): 0.63, ("b", "recall"): 0.71, ("b", "f1"): 0.62
    }
    (tmp_path / "full.json").write_text(json.dumps({"full_feature_set": nested}))
    assert training.read_summary(spark, str(tmp_path / "full.json")).count() == 4


def test_engineered_set(spark):
    rows = cleaning.make_dataset(population(spark, 30), TELCO, ENGINEERED)
    assert len(rows.columns) == 2 + 22
    encoded = estimators.prep(TELCO, ENGINEERED).fit(rows).feature_names()
    assert "num__addon_count" in encoded
    assert any(n.startswith("cat__tenure_bucket_") for n in encoded)


def test_whole_runs_and_their_comparison(spark, tmp_path):
    path = str(tmp_path / "run")
    options = {"models": ("random_forest",), "forest": FOREST}
    settings = training.RunSettings(tune=False, folds=2, probe_train=True, run_shap=False)
    raw = population(spark, 240)
    first = experiment.run_training(
        raw, TELCO, path, run_id="r1", settings=settings, **options
    )
    assert first["winner"] in first["models"]
    assert first["champion"]["model"] == first["winner"]
    assert first["recommendation"] in ("full", "probe_selected")
    audit = first["probe_audit"]
    assert audit["n_selected"] + audit["n_dropped"] == audit["n_features_in"]
    assert experiment.read_run_summary(spark, f"{path}/summary") == json.loads(json.dumps(first))
    model = training.load_model(f"{path}/models/random_forest")
    assert len(model.stages[0].feature_names()) == audit["n_features_in"]
    settings = training.RunSettings(tune=False, folds=2, feature_set=ENGINEERED, sample=200)
    second = experiment.run_training(raw, TELCO, path, run_id="r2", settings=settings, **options)
    assert len(second["baseline_comparison"]) == len(training.REPORT)
    assert "probe_audit" not in second
    runs = {r["run_id"] for r in read_metrics(spark, f"{path}/metrics").collect()}
    assert runs == {"r1", "r1-slim", "r2"}
    assert spark.read.json(f"{path}/models_shap").count() > 0


def test_missing_columns_are_named(data, logit, spark):
    raw = population(spark, 20).drop("Contract", "TotalCharges")
    with pytest.raises(ValueError, match="Missing feature columns: .*Contract.*TotalCharges"):
        scoring.score_batch(raw, logit, TELCO, threshold=0.5, model_name="m", model_version="v", cols=COLS)


def test_the_metric_of_a_score_is_stored(suite):
    rows = suite[estimators.LOGREG].metric_rows("r")
    by_name = {r[3]: r[4] for r in rows if r[2] == "cv"}
    assert by_name["cv_f1"] == by_name["cv_score"]


def test_a_sample_bounds_the_rows_of_fits_only(spark):
    raw = population(spark, 240)
    whole = training.prepare(raw, TELCO, BASELINE, folds=3)
    some = training.prepare(raw, TELCO, BASELINE, folds=3, sample=40)
    assert some.part("train").count() == 40
    for split in ("validation", "test"):
        ids = [sorted(r[0] for r in d.part(split).select(TELCO.id).collect()) for d in (whole, some)]
        assert ids[0] == ids[1]
