"""Training runs: split, search, threshold on validation, report on test."""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.operators import cleaning, curves, fairness, splitting
from tidemark.operators.sampling import sample_fixed
from tidemark.plans.estimators import LABEL, WEIGHT, ModelSpec, positive_probability
from tidemark.plans.search import Ledger, score_folds
from tidemark.roles import BASELINE, ColumnRoles
from tidemark.session import local_frame, materialise, path_exists
from tidemark.sources.metrics import metrics_frame

DEFAULT_METRIC = "f1"
REPORT = ("pr_auc", "roc_auc", "recall", "precision", "f1", "f2")
CELLS = ("tn", "fp", "fn", "tp")


@dataclass
class TrainingRows:
    """The written rows of all three parts, and the weight of the positive class.

    The table also holds the protected columns, which are read for audits only.
    """

    table: DataFrame
    roles: ColumnRoles
    weight: float

    @property
    def rows(self) -> DataFrame:
        """Id, label, features, split, fold and weight."""
        return self.table.drop(*self.roles.protected)

    def part(self, split: str) -> DataFrame:
        """The rows of one split; the others are not read."""
        return self.rows.filter(F.col("split") == split)

    def demographics(self, split: str) -> DataFrame:
        """Id and protected columns of one split."""
        return cleaning.demographics(self.table.filter(F.col("split") == split), self.roles)


@dataclass
class TrainedModel:
    """A fitted pipeline with its threshold and metrics."""

    name: str
    pipeline: PipelineModel
    threshold: float
    cv_score: float
    cv_std: float
    grid_score: float | None
    validation: Row
    test: Row
    groups: list[Row] = field(default_factory=list)
    select_metric: str = DEFAULT_METRIC

    def metric_rows(self, run_id: str) -> list[tuple]:
        """Long rows (run_id, model, split, metric, value)."""
        rows = [
            (run_id, self.name, "cv", "cv_score", self.cv_score),
            # The same under the name of the metric that it is the score of.
            (run_id, self.name, "cv", f"cv_{self.select_metric}", self.cv_score),
            (run_id, self.name, "cv", "cv_std", self.cv_std),
            (run_id, self.name, "validation", "threshold", self.threshold),
        ]
        if self.grid_score is not None:
            rows.append((run_id, self.name, "cv", "grid_score", self.grid_score))
        for split, values in (("validation", self.validation), ("test", self.test)):
            rows += [(run_id, self.name, split, m, _number(values[m])) for m in (*REPORT, *CELLS)]
        for g in self.groups:
            rows += [
                (run_id, self.name, f"test:{g['attribute']}={g['grp']}", m, _number(g[m]))
                for m in ("n", "actual_rate", "flagged_rate", "recall", "precision")
            ]
        return rows


def _number(value) -> float | None:
    return None if value is None else float(value)


def resolve_training_metrics(
    metric: str, grid_metric: str | None = None, select_metric: str | None = None
) -> tuple[str, str]:
    """Metric of the grid search and of the selection; both default to ``metric``."""
    grid, select = grid_metric or metric, select_metric or metric
    if curves.resolve_metric(grid) != curves.resolve_metric(select):
        warnings.warn(f"Grid metric {grid} differs from selection metric {select}", stacklevel=2)
    return grid, select


def prepare(
    raw: DataFrame,
    roles: ColumnRoles,
    feature_set: str = BASELINE,
    *,
    weight_mode: str = "sqrt",
    folds: int = splitting.FOLDS,
    sample: int | None = None,
) -> TrainingRows:
    """Clean, split, fold and weight a raw table, and write the rows once, by part.

    ``sample`` bounds the rows that models are fitted on: that many of the train part, by
    the order of their hashes. Validation and test are always whole.
    The splits are worked out on a narrow table of ids and labels. Every fit and
    evaluation reads the written rows of its part, so nothing upstream runs twice.
    """
    cleaned = cleaning.clean(raw, roles)
    dataset = cleaning.split_roles(cleaned, roles, feature_set, roles.protected)
    keys = materialise(dataset.select(name(roles.id), LABEL), "keys")
    unknown = keys.filter(F.col(LABEL).isNull()).count()
    if unknown:
        raise ValueError(f"{unknown} rows have a label of neither class")
    split_keys = materialise(splitting.stratified_split(keys, roles.id, LABEL), "split")
    in_train = F.col("split") == splitting.TRAIN
    train_keys = split_keys.filter(in_train)
    weight = splitting.positive_weight(train_keys, LABEL, weight_mode)
    rows = splitting.stratified_split(dataset, roles.id, LABEL, keys=keys)
    rows = splitting.stratified_folds(rows, roles.id, LABEL, keys=train_keys, folds=folds)
    rows = rows.withColumn("fold", F.when(in_train, F.col("fold")))
    weighted = splitting.with_weight(rows, LABEL, weight, WEIGHT)
    if sample is not None:
        fitted_on = sample_fixed(train_keys, roles.id, sample).select(name(roles.id)).distinct()
        chosen = weighted.filter(in_train).join(fitted_on, roles.id, "left_semi")
        weighted = weighted.filter(~in_train).unionByName(chosen)
    return TrainingRows(materialise(weighted, "rows", ["split", "fold"]), roles, weight)


@dataclass
class SearchResult:
    """Mean and deviation of the metric per parameter map, and the best map refitted."""

    means: list[float]
    stds: list[float]
    best: int
    model: PipelineModel
    # Mean and deviation of the selection metric of the best map.
    selected: float
    selected_std: float


def cross_validate(
    spec: ModelSpec,
    train: DataFrame,
    *,
    metric: str = DEFAULT_METRIC,
    folds: int = splitting.FOLDS,
    parallelism: int | None = None,
    ledger: Ledger | None = None,
) -> tuple[list[float], list[float]]:
    """Mean and deviation over the folds for each parameter map."""
    scores = score_folds(spec, train, [metric], folds, parallelism=parallelism, ledger=ledger)
    return _moments(scores.values[curves.resolve_metric(metric)])


def _moments(values: list[list[float]]) -> tuple[list[float], list[float]]:
    return [fmean(s) for s in values], [pstdev(s) for s in values]


def grid_search(
    spec: ModelSpec,
    train: DataFrame,
    *,
    metric: str = DEFAULT_METRIC,
    select_metric: str | None = None,
    folds: int = splitting.FOLDS,
    parallelism: int | None = None,
    ledger: Ledger | None = None,
) -> SearchResult:
    """Cross-validate every parameter map and refit the best, the first of equals, on all rows.

    ``select_metric`` is measured on the same fits.
    """
    key, select = (curves.resolve_metric(m) for m in (metric, select_metric or metric))
    saved = any(ledger.model(spec, params) for params in spec.grid) if ledger else False
    options = {"parallelism": parallelism, "ledger": ledger}
    scores = score_folds(spec, train, list(dict.fromkeys([key, select])), folds, refits=not saved, **options)
    means, stds = _moments(scores.values[key])
    best = max(range(len(means)), key=lambda i: means[i])
    model = ledger.model(spec, spec.grid[best]) if ledger else None
    if model is None:
        model = scores.refits.get(best) or refit(spec, train, spec.grid[best])
        if ledger:
            ledger.save(spec, spec.grid[best], model)
    (chosen,), (deviation,) = _moments([scores.values[select][best]])
    return SearchResult(means, stds, best, model, chosen, deviation)


def refit(spec: ModelSpec, train: DataFrame, params: dict) -> PipelineModel:
    prep = spec.prep.fit(train)
    return PipelineModel([prep, spec.classifier.fit(prep.transform(train), params)])


def grid_table(spark: SparkSession, spec: ModelSpec, result: SearchResult) -> DataFrame:
    """One row per parameter map: its settings as JSON, mean and std of the metric."""
    rows = []
    for i, params in enumerate(spec.grid):
        settings = json.dumps({p.name: v for p, v in params.items()}, sort_keys=True)
        rows.append((spec.name, i, settings, result.means[i], result.stds[i]))
    return local_frame(
        spark, rows, "model string, position int, params string, mean double, std double"
    )


def score_labelled(model: PipelineModel, rows: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Id, label and probability of labelled rows."""
    predicted = positive_probability(model.transform(rows))
    return predicted.select(name(roles.id), name(LABEL), "p")


def train_one(
    spec: ModelSpec,
    data: TrainingRows,
    roles: ColumnRoles,
    *,
    grid_metric: str = DEFAULT_METRIC,
    select_metric: str = DEFAULT_METRIC,
    strategy: str = "f1",
    recall_floor: float = curves.RECALL_FLOOR,
    folds: int = splitting.FOLDS,
    parallelism: int | None = None,
    ledger: str | Ledger | None = None,
) -> TrainedModel:
    """Search, fit, choose the threshold on validation, and measure validation and test.

    In ``ledger``, or below that path, fits are remembered: begun again, a run goes on where it stopped.
    """
    train = data.part(splitting.TRAIN)
    ledger = Ledger(train.sparkSession, ledger, train) if isinstance(ledger, str) else ledger
    search = grid_search(
        spec,
        train,
        metric=grid_metric,
        select_metric=select_metric,
        folds=folds,
        parallelism=parallelism,
        ledger=ledger,
    )
    cv_score, cv_std = search.selected, search.selected_std
    grid_score = search.means[search.best] if len(spec.grid) > 1 else None
    pipeline = search.model
    # Validation and test are scored once and written; the metrics read that table.
    held_out = data.rows.filter(F.col("split") != splitting.TRAIN)
    scored = positive_probability(pipeline.transform(held_out)).select(
        name(roles.id), name(LABEL), "p", "split"
    )
    scored = materialise(scored, f"scored-{spec.name}")
    validation = scored.filter(F.col("split") == splitting.VALIDATION)
    test = scored.filter(F.col("split") == splitting.TEST)
    curve = curves.score_counts(validation, LABEL, "p")
    threshold = curves.pick_threshold(curve, strategy=strategy, recall_floor=recall_floor)
    groups = (
        fairness.fairness_join(
            test,
            data.demographics(splitting.TEST),
            roles.id,
            roles.protected,
            threshold,
            LABEL,
            "p",
        ).collect()
        if roles.protected
        else []
    )
    return TrainedModel(
        spec.name,
        pipeline,
        threshold,
        cv_score,
        cv_std,
        grid_score,
        curves.evaluate_curve(curve, threshold).first(),
        curves.evaluate(test, threshold, LABEL, "p").first(),
        groups,
        select_metric,
    )


def train_suite(
    specs: Iterable[ModelSpec],
    data: TrainingRows,
    roles: ColumnRoles,
    *,
    parallelism: int | None = None,
    ledger: str | Ledger | None = None,
    **options,
) -> dict[str, TrainedModel]:
    """Train the models on the same rows, all of them or ``parallelism`` at a time.

    A booster's many short passes wait for one another, so the other models use the cores meanwhile.
    """
    specs = list(specs)
    if not specs:
        return {}
    spark = data.table.sparkSession
    if isinstance(ledger, str):
        # Read once, before any model writes to it.
        ledger = Ledger(spark, ledger, data.part(splitting.TRAIN))

    def one(spec: ModelSpec) -> TrainedModel:
        return train_one(spec, data, roles, parallelism=parallelism, ledger=ledger, **options)

    with ThreadPool(min(len(specs), parallelism or len(specs))) as pool:
        trained = pool.map(inheritable_thread_target(spark)(one), specs, chunksize=1)
    return {spec.name: model for spec, model in zip(specs, trained, strict=True)}


def suite_metrics(spark: SparkSession, results: dict[str, TrainedModel], run_id: str) -> DataFrame:
    return metrics_frame(spark, [r for m in results.values() for r in m.metric_rows(run_id)])


def cv_results(spark: SparkSession, results: dict[str, TrainedModel]) -> DataFrame:
    """Rows (model, position, metric, value) for :func:`tidemark.operators.deltas.select_winner`."""
    rows = [(m.name, i, "cv_score", m.cv_score) for i, m in enumerate(results.values())]
    return local_frame(spark, rows, "model string, position int, metric string, value double")


def winner(results: dict[str, TrainedModel]) -> str:
    """The model with the best CV score, the first among equals."""
    return max(results, key=lambda k: results[k].cv_score)


def cv_metrics(metrics: DataFrame) -> DataFrame:
    """Rows (model, metric, value) of the CV scores, by the name of their metric."""
    named = F.col("metric").startswith("cv_") & ~F.col("metric").isin("cv_score", "cv_std")
    wanted = metrics.filter((F.col("split") == "cv") & named)
    return wanted.select("model", "metric", "value")


def report_metrics(metrics: DataFrame, split: str = "test") -> DataFrame:
    """Headline rows (model, metric, value) of one split."""
    wanted = metrics.filter((F.col("split") == split) & F.col("metric").isin(*REPORT))
    return wanted.select("model", "metric", "value")


def champion_report(metrics: DataFrame, champion: str, metric: str = DEFAULT_METRIC) -> DataFrame:
    """One row: the champion's test metrics as headline, CV and validation as development only."""
    section = (
        F.when(F.col("split") == "test", F.concat(F.lit("report_"), "metric"))
        .when(F.col("metric") == "threshold", F.lit("threshold"))
        .when(F.col("metric") == "cv_score", F.lit(f"development_cv_{metric}"))
        .when(F.col("split") == "validation", F.concat(F.lit("development_validation_"), "metric"))
    )
    columns = [f"report_{m}" for m in REPORT]
    columns += [f"development_validation_{m}" for m in REPORT if m != "roc_auc"]
    columns += [f"development_cv_{metric}", "threshold"]
    return (
        metrics.filter(F.col("model") == champion)
        .withColumn("section", section)
        .groupBy("model")
        .agg(*[F.max(F.when(F.col("section") == c, F.col("value"))).alias(c) for c in columns])
        .withColumn("selected_by", F.lit(f"cv_{metric} on train (stratified CV)"))
        .withColumn("threshold_tuned_on", F.lit("validation"))
    )


@dataclass(frozen=True)
class RunSettings:
    """Every knob of one run."""

    feature_set: str = BASELINE
    sample: int | None = None
    tune: bool = True
    metric: str = DEFAULT_METRIC
    grid_metric: str | None = None
    select_metric: str | None = None
    pos_weight_mode: str = "sqrt"
    threshold_strategy: str = "f1"
    recall_floor: float = curves.RECALL_FLOOR
    probe_audit: bool = False
    probe_train: bool = False
    save_baseline: bool = False
    run_shap: bool = True
    folds: int = splitting.FOLDS
    parallelism: int | None = None

    def resolved(self) -> RunSettings:
        """The settings with the grid and selection metrics filled in."""
        grid, select = resolve_training_metrics(self.metric, self.grid_metric, self.select_metric)
        return replace(self, grid_metric=grid, select_metric=select)


def run_config(settings: RunSettings, weight: float) -> dict:
    """The record of a run: its settings, the class weight used, and how data was split."""
    record = asdict(settings.resolved())
    record["metrics_aligned"] = record["grid_metric"] == record["select_metric"]
    record["pos_weight_value"] = round(weight, 4)
    record["data_split"] = {
        splitting.TRAIN: round(1 - splitting.VAL_SIZE - splitting.TEST_SIZE, 2),
        splitting.VALIDATION: splitting.VAL_SIZE,
        splitting.TEST: splitting.TEST_SIZE,
    }
    record["threshold_tuned_on"] = splitting.VALIDATION
    return record


def run_config_frame(spark: SparkSession, run_id: str, config: dict) -> DataFrame:
    text = json.dumps(config, sort_keys=True)
    return local_frame(spark, [(run_id, text)], "run_id string, config string")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing one is an error, and so is one without a probability."""
    if not path_exists(SparkSession.active(), path):
        raise FileNotFoundError(f"{path} not found: train and save the model first")
    model = PipelineModel.load(path)
    if not model.stages or not model.stages[-1].hasParam("probabilityCol"):
        raise TypeError(f"{path} holds no classifier with probabilities")
    return model


def rescore_test(model: PipelineModel, raw: DataFrame, roles: ColumnRoles, feature_set: str = BASELINE) -> DataFrame:
    """Recreate the test part of a raw table and score it with a saved model."""
    dataset = cleaning.make_dataset(raw, roles, feature_set)
    rows = splitting.stratified_split(dataset, roles.id, LABEL)
    return score_labelled(model, rows.filter(F.col("split") == splitting.TEST), roles)


# Metric names of an older summary layout, whose entries were flat.
LEGACY_PREFIX = "test_"


def write_baseline(metrics: DataFrame, path: str) -> None:
    """Freeze the test metrics of a run as the baseline."""
    report_metrics(metrics).coalesce(1).write.mode("overwrite").json(path)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """The frozen rows (model, metric, value); flat ``test_x`` names are read as ``x``."""
    rows = spark.read.schema("model string, metric string, value double").json(path)
    return rows.withColumn("metric", F.regexp_replace("metric", f"^{LEGACY_PREFIX}", ""))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Test metrics (model, metric, value) of a summary JSON document, nested or flat entries."""
    names = ", ".join(f"{m}: double" for m in REPORT)
    flat = ", ".join(f"{LEGACY_PREFIX}{m}: double" for m in REPORT)
    models = f"map<string, struct<report: struct<{names}>, {flat}>>"
    schema = f"models {models}, full_feature_set struct<models: {models}>"
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", schema).alias("s"))
    entries = parsed.select(
        F.explode(F.coalesce("s.full_feature_set.models", "s.models")).alias("model", "entry")
    )
    value = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.coalesce(f"entry.report.{m}", f"entry.{LEGACY_PREFIX}{m}").alias("value"),
            )
            for m in REPORT
        ]
    )
    return (
        entries.select("model", F.explode(value).alias("pair"))
        .select("model", "pair.metric", "pair.value")
        .filter("value IS NOT NULL")
    )
