"""The four classifiers as ML pipelines, their grids and the metric they are tuned by."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.operators.curves import metric_value, resolve_metric
from tidemark.operators.encoding import FeaturePrep
from tidemark.plans.boosting import LEAF, LEVEL, HistogramBooster
from tidemark.plans.forest import RandomForestClassifier
from tidemark.roles import BASELINE, ColumnRoles

SEED = 42
LABEL, WEIGHT, FEATURES = "y", "weight", "features"
LOGREG, FOREST, BOOSTER_A, BOOSTER_B = "logreg", "random_forest", "gbt_a", "gbt_b"
MODELS = (LOGREG, FOREST, BOOSTER_A, BOOSTER_B)

# Unlimited tree depth is the deepest tree MLlib grows.
MAX_DEPTH = 30

# Defaults and search grids of the four models.
FOREST_DEFAULTS = {"numTrees": 300, "maxDepth": MAX_DEPTH, "featureSubsetStrategy": "sqrt"}
BOOSTER_DEFAULTS = {
    "maxIter": 300,
    "maxDepth": 4,
    "stepSize": 0.1,
    "subsamplingRate": 0.9,
    "columnRate": 0.9,
}
# Growth by level with a penalty, and growth by leaf with larger leaves from the mean.
BOOSTER_PRESETS = {
    BOOSTER_A: {"growth": LEVEL, "l2": 1.0, "minCurvature": 1.0, "maxBins": 256},
    BOOSTER_B: {
        "growth": LEAF,
        "maxLeaves": 31,
        "l2": 0.0,
        "minCurvature": 1e-3,
        "minInstancesPerNode": 20,
        "maxBins": 255,
        "startFromMean": True,
    },
}
FOREST_GRID = {
    "maxDepth": [8, 12, 16, MAX_DEPTH],
    "numTrees": [300, 500],
    "minInstancesPerNode": [1, 5],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
BOOSTER_GRID = {"maxDepth": [3, 4, 5], "maxIter": [200, 400], "stepSize": [0.05, 0.1]}


class PenalisedLogit(Estimator):
    """Logistic regression with an L2 penalty given as inverse strength C.

    MLlib averages the loss over the weights, so its penalty is 1 / (C * sum of weights),
    taken from the rows at hand: each fold gets its own.
    """

    inverseStrength = Param(
        Params._dummy(), "inverseStrength", "C, larger is weaker", TypeConverters.toFloat
    )
    maxIter = Param(Params._dummy(), "maxIter", "iterations at most", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inverseStrength=1.0, maxIter=2000):
        super().__init__()
        self._setDefault(inverseStrength=1.0, maxIter=2000)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        total = dataset.agg(F.sum(WEIGHT)).first()[0]
        logit = LogisticRegression(
            featuresCol=FEATURES,
            labelCol=LABEL,
            weightCol=WEIGHT,
            standardization=False,
            maxIter=self.getOrDefault("maxIter"),
            regParam=1.0 / (self.getOrDefault("inverseStrength") * total),
        )
        return logit.fit(dataset)


@dataclass
class ModelSpec:
    """A named preparation and classifier, and the classifier's parameter maps to search."""

    name: str
    prep: FeaturePrep
    classifier: Estimator
    grid: list[dict] = field(default_factory=lambda: [{}])

    @property
    def pipeline(self) -> Pipeline:
        return Pipeline(stages=[self.prep, self.classifier])


def prep(
    roles: ColumnRoles,
    feature_set: str = BASELINE,
    *,
    drop_first: bool = False,
    scale: bool = False,
    selected: Sequence[str] = (),
) -> FeaturePrep:
    return FeaturePrep(
        numeric=roles.numeric_columns(feature_set),
        categorical=roles.categorical_columns(feature_set),
        markers=list(roles.redundant_markers),
        dropFirst=drop_first,
        scale=scale,
        selected=list(selected),
        outputCol=FEATURES,
    )


def train_logreg(
    roles: ColumnRoles, feature_set: str = BASELINE, *, selected: Sequence[str] = (), **settings
) -> ModelSpec:
    """Scaled logistic regression, not tuned; all levels are kept when columns are selected."""
    stage = prep(roles, feature_set, drop_first=not selected, scale=True, selected=selected)
    return ModelSpec(LOGREG, stage, PenalisedLogit(**settings))


def train_random_forest(
    roles: ColumnRoles,
    feature_set: str = BASELINE,
    *,
    selected: Sequence[str] = (),
    grid: Mapping[str, Sequence] | None = None,
    **settings,
) -> ModelSpec:
    forest = RandomForestClassifier(
        **{**FOREST_DEFAULTS, **settings}, labelCol=LABEL, weightCol=WEIGHT, seed=SEED
    )
    return _tree_spec(FOREST, forest, prep(roles, feature_set, selected=selected), grid)


def train_gbt(
    roles: ColumnRoles,
    feature_set: str = BASELINE,
    *,
    label: str = BOOSTER_A,
    selected: Sequence[str] = (),
    grid: Mapping[str, Sequence] | None = None,
    **settings,
) -> ModelSpec:
    booster = HistogramBooster(
        **{**BOOSTER_DEFAULTS, **BOOSTER_PRESETS[label], **settings}, labelCol=LABEL, weightCol=WEIGHT, seed=SEED
    )
    return _tree_spec(label, booster, prep(roles, feature_set, selected=selected), grid)


def train_gbt_a(roles: ColumnRoles, feature_set: str = BASELINE, **options) -> ModelSpec:
    """Boosted trees of second order, grown level by level."""
    return train_gbt(roles, feature_set, label=BOOSTER_A, **options)


def train_gbt_b(roles: ColumnRoles, feature_set: str = BASELINE, **options) -> ModelSpec:
    """Boosted trees of second order, the leaf of the largest gain first."""
    return train_gbt(roles, feature_set, label=BOOSTER_B, **options)


def _tree_spec(label: str, tree, stage: FeaturePrep, grid) -> ModelSpec:
    builder = ParamGridBuilder()
    for param, values in (grid or {}).items():
        builder = builder.addGrid(tree.getParam(param), list(values))
    return ModelSpec(label, stage, tree, builder.build())


def model_specs(
    roles: ColumnRoles,
    feature_set: str = BASELINE,
    *,
    tune: bool = True,
    selected: Sequence[str] = (),
    forest: Mapping | None = None,
    booster: Mapping | None = None,
) -> list[ModelSpec]:
    """The four models in their fixed order; ``forest`` and ``booster`` override settings."""
    forest, booster = dict(forest or {}), dict(booster or {})
    if tune:
        forest.setdefault("grid", FOREST_GRID)
        booster.setdefault("grid", BOOSTER_GRID)
    return [
        train_logreg(roles, feature_set, selected=selected),
        train_random_forest(roles, feature_set, selected=selected, **forest),
        train_gbt_a(roles, feature_set, selected=selected, **booster),
        train_gbt_b(roles, feature_set, selected=selected, **booster),
    ]


def positive_probability(predicted: DataFrame, column: str = "p") -> DataFrame:
    """Take the probability of class 1 out of the model's vector."""
    return predicted.withColumn(column, vector_to_array("probability")[1])


class MetricEvaluator(Evaluator):
    """Average precision, or f1, f2 or mcc of the positive class as predicted."""

    metric = Param(Params._dummy(), "metric", "pr_auc, f1, f2 or mcc", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, metric="f1"):
        super().__init__()
        self._set(metric=resolve_metric(metric))

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = positive_probability(dataset).select(name(LABEL), "p", "prediction")
        row = metric_value(scored, self.getOrDefault("metric"), LABEL, "p", "prediction").first()
        return float(row["value"])

    def isLargerBetter(self) -> bool:
        return True
