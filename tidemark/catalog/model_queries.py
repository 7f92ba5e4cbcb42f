"""Queries of training, scoring, explanation and comparison.

Models, grids, folds and explanation use the library's defaults, and the rows are all rows.
Fitted numbers are no matter of SQL but for a single split, so what most of these queries
return of them is what SQL can foresee: how many rows of each class a split has, that rates
follow from their cells, that a choice is the best of its list, that two ways to the same
number agree. ``training_run`` is a run without tuning of two models; ``training_run_whole`` is
the whole one.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.catalog.table_queries import THRESHOLD, Query, rounded
from tidemark.operators import curves, deltas, splitting
from tidemark.operators.correlation import correlations, exploration_matrix
from tidemark.operators.encoding import FeaturePrep
from tidemark.operators.scores import score_parity as compare_scores
from tidemark.plans import estimators, experiment, explain, release, scoring, training
from tidemark.plans.boosting import HistogramBooster
from tidemark.roles import ACCOUNTS, ENGINEERED
from tidemark.session import local_frame, materialise, work_path
from tidemark.sources import metrics as metric_tables
from tidemark.sources.jsonl import export_cache, export_jsonl, load_batch_output, load_cache
from tidemark.sources.predictions import read_predictions
from tidemark.sources.views import accounts, score_log, scored_events


def rows_of(spark: SparkSession, sf_dir: str, feature_set: str = "baseline") -> training.TrainingRows:
    """The prepared training rows."""
    return training.prepare(accounts(spark, sf_dir), ACCOUNTS, feature_set)


def fitted(spark: SparkSession, sf_dir: str, kind: str, data: training.TrainingRows | None = None):
    """A pipeline fitted on the training rows."""
    spec = (
        estimators.train_logreg(ACCOUNTS)
        if kind == estimators.LOGREG
        else estimators.train_random_forest(ACCOUNTS)
    )
    return spec.pipeline.fit((data or rows_of(spark, sf_dir)).part(splitting.TRAIN))


def suite(spark: SparkSession, sf_dir: str):
    """All four models trained and measured."""
    specs = estimators.model_specs(ACCOUNTS, tune=False)
    return training.train_suite(specs, rows_of(spark, sf_dir), ACCOUNTS)


def checked_metrics(metrics: DataFrame) -> DataFrame:
    """Per model and split: rows, positives, and whether the measures are in order.

    The rates must follow from the cells, and every score must be one. Groups of the test
    part have rows only.
    """
    wide = metrics.filter("split <> 'cv'").groupBy("run_id", "model", "split")
    names = [*training.REPORT, *training.CELLS, "n", "actual_rate", "flagged_rate", "threshold"]
    wide = wide.agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names])

    def share(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    same = lambda metric, value: F.abs(F.col(metric) - value) < 1e-9
    whole = (
        same("precision", share(tp, tp + fp))
        & same("recall", share(tp, tp + fn))
        & same("f1", share(2 * tp, 2 * tp + fp + fn))
        & same("f2", share(5 * tp, 5 * tp + fp + 4 * fn))
        & F.col("pr_auc").between(0, 1)
        & F.col("roc_auc").between(0, 1)
        & (F.col("split") == "test").eqNullSafe(F.col("threshold").isNull())
    )
    group = F.col("actual_rate").between(0, 1) & F.col("flagged_rate").between(0, 1)
    return wide.select(
        "run_id",
        "model",
        "split",
        F.coalesce("n", tp + fp + fn + tn).cast("bigint").alias("n"),
        F.coalesce(tp + fn, F.round(F.col("n") * F.col("actual_rate"))).cast("bigint").alias("positives"),
        F.when(F.col("n").isNull(), whole).otherwise(group).alias("in_order"),
    )


def _train(spark, sf_dir, spec, feature_set: str = "baseline") -> DataFrame:
    model = training.train_one(spec, rows_of(spark, sf_dir, feature_set), ACCOUNTS)
    return checked_metrics(metric_tables.metrics_frame(spark, model.metric_rows("run")))


# Training


def train_logreg(spark, sf_dir):
    return _train(spark, sf_dir, estimators.train_logreg(ACCOUNTS))


def train_random_forest(spark, sf_dir):
    return _train(spark, sf_dir, estimators.train_random_forest(ACCOUNTS))


def train_gbt_a(spark, sf_dir):
    return _train(spark, sf_dir, estimators.train_gbt_a(ACCOUNTS))


def train_gbt_b(spark, sf_dir):
    return _train(spark, sf_dir, estimators.train_gbt_b(ACCOUNTS))


def booster_stump(spark, sf_dir):
    """The first split of both boosters over all dummies, whole rows: gain, leaf values and rows."""
    data = rows_of(spark, sf_dir)
    prep = FeaturePrep(numeric=[], categorical=list(ACCOUNTS.categorical), markers=list(ACCOUNTS.redundant_markers))
    train = data.part(splitting.TRAIN)
    fitted_prep = prep.fit(train)
    vectors = materialise(fitted_prep.transform(train).select(estimators.LABEL, estimators.WEIGHT, estimators.FEATURES), "stump")
    names = fitted_prep.feature_names()
    rows = []
    for model, preset in estimators.BOOSTER_PRESETS.items():
        booster = HistogramBooster(**{**preset, "maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "columnRate": 1.0})
        tree = booster.fit(vectors).state["trees"][0]
        low, high = tree["left"][0], tree["right"][0]
        values = (tree["value"][low], tree["value"][high], int(tree["rows"][low]), int(tree["rows"][high]))
        rows.append((model, names[tree["feature"][0]], tree["gain"][0], *values))
    schema = "model string, feature string, gain double, low double, high double, n_low bigint, n_high bigint"
    return rounded(local_frame(spark, rows, schema))


def train_engineered(spark, sf_dir):
    return _train(spark, sf_dir, estimators.train_logreg(ACCOUNTS, ENGINEERED), ENGINEERED)


def grid_search(spark, sf_dir):
    """The forest's whole grid by average precision: the maps that were tried, and which one the search took."""
    return _searched(spark, sf_dir, estimators.train_random_forest(ACCOUNTS, grid=estimators.FOREST_GRID))


def grid_search_forest(spark, sf_dir):
    """The forest's whole grid by F1."""
    return _searched(spark, sf_dir, estimators.train_random_forest(ACCOUNTS, grid=estimators.FOREST_GRID), "f1")


def grid_search_gbt_a(spark, sf_dir):
    """The booster's whole grid, first preset."""
    return _searched(spark, sf_dir, estimators.train_gbt_a(ACCOUNTS, grid=estimators.BOOSTER_GRID))


def grid_search_gbt_b(spark, sf_dir):
    """The booster's whole grid, second preset."""
    return _searched(spark, sf_dir, estimators.train_gbt_b(ACCOUNTS, grid=estimators.BOOSTER_GRID))


def _searched(spark, sf_dir, spec, metric: str = "pr_auc") -> DataFrame:
    train = rows_of(spark, sf_dir).part(splitting.TRAIN)
    search = training.grid_search(spec, train, metric=metric)
    tried = training.grid_table(spark, spec, search)
    chosen = F.lit(search.means[search.best])
    return tried.agg(
        F.count("*").alias("maps"),
        F.countDistinct("params").alias("settings"),
        F.bool_and(F.col("mean") <= chosen).alias("best_taken"),
        F.bool_and(F.col("mean").between(0, 1) & F.col("std").between(0, 1)).alias("in_order"),
    )


def cv_score(spark, sf_dir):
    """Grid by one metric, selection by another: the chosen model is validated again."""
    spec = estimators.train_random_forest(ACCOUNTS, grid=estimators.FOREST_GRID)
    data = rows_of(spark, sf_dir)
    model = training.train_one(spec, data, ACCOUNTS, grid_metric="pr_auc", select_metric="mcc")
    rows = [r for r in model.metric_rows("run") if r[2] == "cv"]
    metrics = metric_tables.metrics_frame(spark, rows)
    return metrics.select("metric", F.col("value").between(-1, 1).alias("in_order"))


def train_suite(spark, sf_dir):
    return checked_metrics(training.suite_metrics(spark, suite(spark, sf_dir), "run"))


def training_run(spark, sf_dir):
    """A whole run with probe selection; the metrics of both feature sets as written."""
    path = work_path(spark, "run")
    experiment.run_training(
        accounts(spark, sf_dir),
        ACCOUNTS,
        path,
        run_id="r1",
        settings=training.RunSettings(tune=False, probe_train=True),
        models=(estimators.LOGREG, estimators.FOREST),
    )
    return checked_metrics(metric_tables.read_metrics(spark, f"{path}/metrics"))


def training_run_whole(spark, sf_dir):
    """A whole run with probe selection: four models, tuned, and the Shapley step."""
    path = work_path(spark, "run")
    settings = training.RunSettings(probe_train=True)
    experiment.run_training(accounts(spark, sf_dir), ACCOUNTS, path, run_id="r1", settings=settings)
    return checked_metrics(metric_tables.read_metrics(spark, f"{path}/metrics"))


def suite_winner(spark, sf_dir):
    """Whether the winner has the best CV score of the four."""
    results = training.cv_results(spark, suite(spark, sf_dir))
    best = deltas.select_winner(results).select(F.col("model").alias("won"), F.col("value").alias("top"))
    return results.crossJoin(best).agg(
        F.count("*").alias("models"),
        F.bool_and(F.col("value") <= F.col("top")).alias("best_won"),
        F.bool_or(F.col("model") == F.col("won")).alias("known"),
    )


def champion_report(spark, sf_dir):
    """The report of one of the score log's models: flags at two thresholds as its splits."""
    test = metric_long(spark, sf_dir, THRESHOLD).withColumn("split", F.lit("test"))
    validation = metric_long(spark, sf_dir, 0.6).withColumn("split", F.lit("validation"))
    f1 = test.filter("metric = 'f1'")
    cv = f1.withColumns({"metric": F.lit("cv_score"), "split": F.lit("cv")})
    chosen = f1.withColumns(
        {"metric": F.lit("threshold"), "value": F.lit(THRESHOLD), "split": F.lit("validation")}
    )
    metrics = test.unionByName(validation).unionByName(cv).unionByName(chosen)
    return rounded(training.champion_report(metrics, "purchase"))


def suite_champion(spark, sf_dir):
    results = suite(spark, sf_dir)
    best = training.winner(results)
    metrics = training.suite_metrics(spark, results, "run")
    report = training.champion_report(metrics, best)
    tests = metrics.filter((F.col("model") == best) & (F.col("split") == "test"))
    tests = tests.groupBy("model").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in training.REPORT]
    )
    same = [F.col(f"report_{m}") == F.col(m) for m in training.REPORT]
    agrees = same[0]
    for other in same[1:]:
        agrees = agrees & other
    return report.join(tests, "model").select(
        "selected_by", "threshold_tuned_on", agrees.alias("test_reported"),
        F.col("threshold").between(0, 1).alias("threshold_known"),
    )


def run_config(spark, sf_dir):
    """Every knob of a run that sets some of them, as text."""
    settings = training.RunSettings(metric="f2", tune=False, threshold_strategy="f2", recall_floor=0.8)
    row = training.run_config_frame(spark, "run", training.run_config(settings, rows_of(spark, sf_dir).weight))
    knobs = F.explode(F.from_json("config", "map<string,string>")).alias("knob", "value")
    return row.select("run_id", knobs).filter("value IS NOT NULL")


def baseline_snapshot(spark, sf_dir):
    path = work_path(spark, "baseline")
    metrics = metric_long(spark, sf_dir, THRESHOLD)
    training.write_baseline(metrics.withColumn("split", F.lit("test")), path)
    return rounded(training.read_baseline(spark, path))


def release_manifest(spark, sf_dir):
    """The record of the best of the score log's models, by its measured flags."""
    long = metric_long(spark, sf_dir, THRESHOLD).withColumn("split", F.lit("test"))
    choice = long.filter("metric = 'f1'").select(
        "model",
        F.lit("threshold").alias("metric"),
        F.lit(THRESHOLD).alias("value"),
        F.lit("validation").alias("split"),
    )
    manifest = release.release_manifest(
        long.unionByName(choice),
        ACCOUNTS,
        model="purchase",
        model_id="events-purchase",
        release_id="v1",
        artifact="model",
    )
    path = work_path(spark, "manifest")
    release.write_manifest(manifest, path)
    read = release.read_manifest(spark, path)
    return rounded(
        read.select(
            "release_id",
            "model",
            "threshold",
            F.size("feature_columns").alias("features"),
            *[F.col("headline_metrics")[m].alias(m) for m in ("precision", "recall", "f1")],
        )
    )


def model_io(spark, sf_dir):
    """A saved and reloaded pipeline gives the scores of the original."""
    model = fitted(spark, sf_dir, estimators.FOREST)
    path = work_path(spark, "model")
    training.save_model(model, path)
    return _parity(spark, sf_dir, model, training.load_model(path))


def score_parity(spark, sf_dir):
    """Batch scores against answers to request lines, as they are and tampered with."""
    model = fitted(spark, sf_dir, estimators.LOGREG)
    raw = accounts(spark, sf_dir).drop(ACCOUNTS.label)
    batch = materialise(_score(spark, sf_dir, model), "batch")
    requests, responses = work_path(spark, "requests"), work_path(spark, "responses")
    export_jsonl(raw, ACCOUNTS, requests)
    scoring.score_requests(
        spark, requests, responses, model, ACCOUNTS, _instance(raw), threshold=0.3
    )
    served = load_batch_output(spark, responses, pattern="*.txt")
    tampered = F.col("account_id").cast("bigint") % 10 == 0
    changed = served.filter("account_id NOT IN ('7', '10')").withColumns({
        "probability": F.when(tampered, F.col("probability") / 2 + 0.25).otherwise(F.col("probability")),
        "flag": F.when(tampered, 1 - F.col("flag")).otherwise(F.col("flag")),
    })
    same = compare_scores(batch, served).withColumn("copy", F.lit("served"))
    return same.unionByName(compare_scores(batch, changed).withColumn("copy", F.lit("tampered")))


def _instance(raw: DataFrame) -> str:
    """The schema of a request's instance: features as the cleaned table has them, and the id."""
    numbers = ", ".join(f"{c} double" for c in ACCOUNTS.numeric)
    texts = ", ".join(f"{c} string" for c in (*ACCOUNTS.categorical, ACCOUNTS.id))
    return f"{numbers}, {texts}"


def _score(spark, sf_dir, model) -> DataFrame:
    return scoring.score_batch(
        accounts(spark, sf_dir).drop(ACCOUNTS.label),
        model,
        ACCOUNTS,
        threshold=0.3,
        model_name="model",
        model_version="m/v1",
    )


def _parity(spark, sf_dir, left, right) -> DataFrame:
    return compare_scores(_score(spark, sf_dir, left), _score(spark, sf_dir, right))


def metrics_sink(spark, sf_dir):
    path = work_path(spark, "metrics")
    long = metric_long(spark, sf_dir, THRESHOLD)
    rows = long.select(F.lit("r1").alias("run_id"), "model", F.lit("test").alias("split"), "metric", "value")
    metric_tables.write_metrics(rows, path)
    metric_tables.write_metrics(rows, path)
    return rounded(metric_tables.read_metrics(spark, path))


# Scoring


def score_batch(spark, sf_dir):
    scored = _score(spark, sf_dir, fitted(spark, sf_dir, estimators.FOREST))
    within = F.col("probability").between(0.0, 1.0)
    agrees = F.col("flag") == (F.col("probability") >= F.col("threshold")).cast("int")
    return scored.select(
        "account_id", "threshold", "model", "model_version", within.alias("within"), agrees.alias("agrees")
    )


def score_and_append(spark, sf_dir):
    """Two runs appended, one of them again on the next day: the retry adds no rows."""
    path = work_path(spark, "predictions")
    raw = accounts(spark, sf_dir).drop(ACCOUNTS.label)
    data = rows_of(spark, sf_dir)
    models = {k: fitted(spark, sf_dir, k, data) for k in (estimators.LOGREG, estimators.FOREST)}
    late, early = datetime(2026, 1, 1, 23, 59, tzinfo=UTC), datetime(2026, 1, 2, 0, 1, tzinfo=UTC)
    for kind, run, at in (
        (estimators.LOGREG, "a", late), (estimators.FOREST, "b", late), (estimators.FOREST, "b", early)
    ):
        scoring.score_and_append(
            raw,
            models[kind],
            ACCOUNTS,
            path,
            source_table="accounts",
            run_id=run,
            scored_at=at,
            threshold=0.3,
            model_name=kind,
            model_version="m/v1",
        )
    return read_predictions(spark, path).groupBy("run_id", "model", "threshold").agg(F.count("*").alias("scored"))


def append_batch_output(spark, sf_dir):
    """Responses of an external job, appended as a run and cached."""
    responses, path, cache_path = (work_path(spark, k) for k in ("responses", "predictions", "cache"))
    row = F.struct("account_id", "probability", "flag", "threshold")
    latest = score_log(spark, sf_dir).groupBy("account_id").agg(
        F.max("probability").alias("probability"), F.max("flag").alias("flag"), F.max("threshold").alias("threshold")
    )
    latest.select(F.to_json(F.struct(F.array(row).alias("predictions"))).alias("value")).write.text(responses)
    scoring.append_batch_output(
        spark,
        responses,
        path,
        model_name="view",
        model_version="m/v1",
        source_table="events",
        run_id="r1",
        pattern="*.txt",
    )
    export_cache(read_predictions(spark, path), cache_path)
    return load_cache(spark, cache_path).drop("scored_at")


def score_one_with_actual(spark, sf_dir):
    """Chosen rows, scored alone and as part of the population."""
    model = fitted(spark, sf_dir, estimators.FOREST)
    scored = scoring.score_one_with_actual(
        accounts(spark, sf_dir),
        ["7", "10", "100"],
        model,
        ACCOUNTS,
        threshold=0.3,
        model_name="model",
    )
    return _against_batch(spark, sf_dir, model, scored).select(
        "account_id", "actual", "threshold", "model", "same_score"
    )


def _against_batch(spark, sf_dir, model, scored: DataFrame) -> DataFrame:
    """Whether each row's probability is that of the written batch scores."""
    batch = materialise(_score(spark, sf_dir, model), "batch")
    batch = batch.select("account_id", F.col("probability").alias("batch_probability"))
    same = F.abs(F.col("probability") - F.col("batch_probability")) < 1e-12
    return scored.join(batch, "account_id", "left").withColumn("same_score", F.coalesce(same, F.lit(False)))


def rescore_test(spark, sf_dir):
    model = fitted(spark, sf_dir, estimators.FOREST)
    scored = training.rescore_test(model, accounts(spark, sf_dir), ACCOUNTS).withColumnRenamed("p", "probability")
    checked = _against_batch(spark, sf_dir, model, scored)
    return rounded(
        checked.agg(
            F.count("*").alias("n"),
            F.sum("y").alias("positives"),
            F.avg("y").alias("prevalence"),
            F.count_if(~F.col("same_score")).alias("differs"),
        )
    )


# Comparisons, on metrics of the score log per model


def metric_long(spark, sf_dir, threshold: float) -> DataFrame:
    """Rows (model, metric, value) of the flags of each model of the score log."""
    cells = curves.confusion(F.col("y"), F.col("p") >= threshold)
    counts = scored_events(spark, sf_dir).withColumn("y", F.when(F.col("p") * 7 % 1 < 0.3, 1).otherwise(0))
    counts = counts.groupBy("model").agg(*[c.alias(k) for k, c in cells.items()])
    rates = curves.with_rates(counts)
    return rates.unpivot(["model"], ["precision", "recall", "f1", "f2"], "metric", "value")


def baseline_delta(spark, sf_dir):
    current = metric_long(spark, sf_dir, THRESHOLD)
    baseline = metric_long(spark, sf_dir, 0.6).filter("NOT (model = 'view' AND metric = 'f2')")
    return rounded(deltas.baseline_delta(current, baseline))


def feature_set_delta(spark, sf_dir):
    full, slim = metric_long(spark, sf_dir, THRESHOLD), metric_long(spark, sf_dir, 0.6)
    return rounded(deltas.feature_set_delta(full, slim.filter("model <> 'signup'")))


def recommend_feature_set(spark, sf_dir):
    full, slim = metric_long(spark, sf_dir, THRESHOLD), metric_long(spark, sf_dir, 0.6)
    return rounded(deltas.recommend_feature_set(full, slim, "recall"))


def select_winner(spark, sf_dir):
    position = {m: i for i, m in enumerate(["click", "error", "purchase", "signup", "view"])}
    places = local_frame(spark, list(position.items()), "model string, position int")
    return rounded(deltas.select_winner(metric_long(spark, sf_dir, THRESHOLD).join(places, "model"), "f1"))


def rank_importance(spark, sf_dir):
    """Features of the exploration matrix by the size of their correlation."""
    matrix = exploration_matrix(accounts(spark, sf_dir), ACCOUNTS, drop_first=False)
    sizes = correlations(matrix).select("feature", F.round(F.abs("correlation"), 6).alias("importance"))
    return deltas.rank_importance(sizes.filter("importance IS NOT NULL"), 20)


# Explanation


def tree_importance(spark, sf_dir):
    """Ranks in the order of shares that add up to 1."""
    ranked = explain.tree_importance(fitted(spark, sf_dir, estimators.FOREST), None)
    return _ranked_in_order(ranked).withColumn("adds_up", F.abs(F.col("total") - 1) < 1e-9).drop("total")


def _ranked_in_order(ranked: DataFrame) -> DataFrame:
    other = ranked.select(F.col("rank").alias("next"), F.col("importance").alias("next_importance"))
    paired = ranked.join(other, F.col("next") == F.col("rank") + 1, "left")
    return paired.agg(
        F.count("*").alias("features"),
        F.max("rank").cast("bigint").alias("last_rank"),
        F.bool_and(F.col("importance") >= F.coalesce("next_importance", F.lit(0.0))).alias("in_order"),
        F.sum("importance").alias("total"),
    )


def probe_audit(spark, sf_dir):
    """What is dropped are the features below the mean of the probes."""
    audit = _audit(spark, sf_dir)
    limit = audit.filter("probe").agg(F.avg("importance").alias("limit"))
    below = F.col("importance") < F.col("limit")
    clear = F.abs(F.col("importance") - F.col("limit")) > 1e-9
    return audit.crossJoin(limit).agg(
        F.count_if(~F.col("probe")).alias("features"),
        F.count_if("probe").alias("probes"),
        F.bool_and((F.col("dropped") == (below & ~F.col("probe"))) | ~clear).alias("in_order"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_up"),
    )


def _audit(spark, sf_dir) -> DataFrame:
    return explain.probe_audit(rows_of(spark, sf_dir).part(splitting.TRAIN), ACCOUNTS)


def probe_kept(spark, sf_dir):
    """The kept names are the audit's features that are not dropped, strongest first."""
    audit = _audit(spark, sf_dir)
    kept = [(i + 1, n) for i, n in enumerate(explain.probe_kept(audit))]
    names = local_frame(spark, kept, "position int, feature string")
    both = audit.filter("NOT probe").join(names, "feature", "left")
    order = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("before", F.min(F.when(F.col("position").isNotNull(), F.col("importance"))).over(order))
    falling = F.col("position").isNull() | F.col("before").isNull() | (F.col("importance") <= F.col("before"))
    return both.agg(
        F.count("*").alias("features"),
        F.bool_and(F.col("dropped") == F.col("position").isNull()).alias("kept_only"),
        F.bool_and(falling).alias("in_order"),
    )


def probe_correlations(spark, sf_dir):
    train = rows_of(spark, sf_dir).part(splitting.TRAIN)
    return rounded(explain.probe_correlations(train, ACCOUNTS))


def shap_importance(spark, sf_dir):
    data = rows_of(spark, sf_dir)
    ranked = explain.shap_importance(
        fitted(spark, sf_dir, estimators.FOREST, data),
        data.part(splitting.TRAIN),
        data.part(splitting.VALIDATION),
        ACCOUNTS.id,
    )
    return _ranked_in_order(ranked).drop("total")


def odds_ratios(spark, sf_dir):
    """Levels by setting, and that each ratio is exp of its coefficient."""
    ratios = explain.odds_ratios(
        accounts(spark, sf_dir), ACCOUNTS, "contract", ["tenure", "monthly", "total_text"]
    )
    same = F.abs(F.col("odds_ratio") - F.exp("beta")) < 1e-9
    return ratios.select("drop_first", "strength", "feature", same.alias("in_order"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        train_logreg,
        train_random_forest,
        train_gbt_a,
        train_gbt_b,
        booster_stump,
        train_engineered,
        grid_search_forest,
        grid_search_gbt_a,
        grid_search_gbt_b,
        grid_search,
        cv_score,
        train_suite,
        training_run,
        suite_winner,
        suite_champion,
        champion_report,
        run_config,
        baseline_snapshot,
        release_manifest,
        model_io,
        score_parity,
        metrics_sink,
        score_batch,
        score_and_append,
        append_batch_output,
        score_one_with_actual,
        rescore_test,
        baseline_delta,
        feature_set_delta,
        recommend_feature_set,
        select_winner,
        rank_importance,
        tree_importance,
        probe_audit,
        probe_kept,
        probe_correlations,
        shap_importance,
        odds_ratios,
    )
}

# A whole tuned run of all models on both feature sets: see the README for its time.
WHOLE: dict[str, Query] = {q.__name__: q for q in (training_run_whole,)}
