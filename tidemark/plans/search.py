"""Cross-validation of many parameter maps with few fits, and a ledger of what was fitted.

Some maps need no fit of their own. The first trees of a boosted model are the shorter model,
and all boosted models of a search, over maps and folds, advance in common passes. The
first trees of a forest are a smaller forest, and its trees, cut at a depth, are those of a
shallower one; so one forest per fold serves all numbers of trees and all depths.

Rows are encoded once per fold, by a preparation fitted on the fold's training rows only. The
held-out rows of a fold are scored once for all maps and measured by a few aggregates.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.operators import curves
from tidemark.plans.boosting import HistogramBooster
from tidemark.plans.estimators import FEATURES, LABEL, WEIGHT, ModelSpec, positive_probability
from tidemark.plans.forest import RandomForestClassifier, columns_drawn
from tidemark.session import local_frame, path_exists, scratch

# Ranges of scores that cumulative counts are taken in; they steer balance only.
SCORE_RANGES = 4_096

LEDGER = "key string, model string, params string, fold int, metric string, value double"
FITTED = "fitted"
# Number of the group that has all training rows, next to the folds.
ALL = -1


class Ledger:
    """Scores and models of a search below a path; what is there is not fitted again.

    An entry hangs on the settings of model and preparation, on the fold and on a digest of the
    rows, so other data or settings never meet it. Entries of a fit are written together
    and as a whole; a repeated write replaces the same entries.
    """

    def __init__(self, spark: SparkSession, path: str, rows: DataFrame):
        self.spark, self.path = spark, path
        hashed = F.xxhash64(*[name(c) for c in sorted(rows.columns)])
        totals = rows.agg(F.count("*"), F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(hashed)).first()
        self.rows = "/".join(str(v) for v in totals)
        self.known: dict[str, float] = {}
        if path_exists(spark, f"{path}/scores"):
            found = spark.read.schema(LEDGER).option("recursiveFileLookup", True).json(f"{path}/scores")
            self.known = {r["key"]: r["value"] for r in found.select("key", "value").collect()}

    def key(self, spec: ModelSpec, params: Mapping, fold: int | None, metric: str) -> str:
        stages = [
            {p.name: v for p, v in {**stage.extractParamMap(), **own}.items()}
            for stage, own in ((spec.prep, {}), (spec.classifier, params))
        ]
        text = json.dumps([type(spec.classifier).__name__, *stages, fold, metric, self.rows], sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()

    def write(self, spec: ModelSpec, entries: Iterable[tuple[Mapping, int | None, str, float]]) -> None:
        rows = []
        for params, fold, metric, value in entries:
            settings = json.dumps({p.name: v for p, v in params.items()}, sort_keys=True)
            rows.append((self.key(spec, params, fold, metric), spec.name, settings, fold, metric, value))
        label = hashlib.sha256("".join(sorted(r[0] for r in rows)).encode()).hexdigest()
        frame = local_frame(self.spark, rows, LEDGER).coalesce(1)
        frame.write.mode("overwrite").json(f"{self.path}/scores/{label}")
        self.known.update({r[0]: r[5] for r in rows})

    def model(self, spec: ModelSpec, params: Mapping) -> PipelineModel | None:
        """The refitted pipeline, if it was saved to its end."""
        key = self.key(spec, params, None, FITTED)
        return PipelineModel.load(f"{self.path}/models/{key}") if key in self.known else None

    def save(self, spec: ModelSpec, params: Mapping, model: PipelineModel) -> None:
        model.write().overwrite().save(f"{self.path}/models/{self.key(spec, params, None, FITTED)}")
        self.write(spec, [(params, None, FITTED, 1.0)])


@dataclass
class Scores:
    """Values by metric, map and fold; models refitted on the way, by map."""

    values: dict[str, list[list[float]]]
    refits: dict[int, PipelineModel] = field(default_factory=dict)


def measures(scored: DataFrame, metrics: Sequence[str]) -> list[dict[str, float]]:
    """The metrics of each entry of ``ps`` next to the label, in a few aggregates for all of them.

    A row is flagged by a score above 0.5, as the models predict.
    """
    keys = [curves.resolve_metric(m) for m in metrics]
    long = scored.select(name(LABEL), F.posexplode("ps").alias("i", "p"))
    counts = long.groupBy("i").agg(
        *[c.alias(k) for k, c in curves.confusion(name(LABEL), F.col("p") > 0.5).items()]
    )
    rated = curves.with_rates(counts)
    if "pr_auc" in keys:
        rated = rated.join(average_precision(long), "i")
    found = {r["i"]: r for r in rated.collect()}
    return [{k: float(found[i][k]) for k in keys} for i in sorted(found)]


def average_precision(long: DataFrame) -> DataFrame:
    """(i, pr_auc) of rows (label, i, p): the sum of precision over the steps of recall."""
    points = long.groupBy("i", F.floor(F.col("p") * SCORE_RANGES).alias("range"), "p").agg(
        F.sum(name(LABEL)).alias("pos"), F.count("*").alias("n")
    )
    # At most SCORE_RANGES rows per map.
    sums = points.groupBy("i", "range").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    above = Window.partitionBy("i").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_before") for c in ("pos", "n")]
    inside = Window.partitionBy("i", "range").orderBy(F.desc("p"))
    joined = points.join(sums.select("i", "range", *before), ["i", "range"])
    cumulative = {c: F.sum(c).over(inside) + F.col(f"{c}_before") for c in ("pos", "n")}
    steps = joined.select("i", "pos", (F.col("pos") * cumulative["pos"] / cumulative["n"]).alias("step"))
    ap = F.when(F.sum("pos") > 0, F.sum("step") / F.sum("pos")).otherwise(0.0)
    return steps.groupBy("i").agg(ap.alias("pr_auc"))


def families(spec: ModelSpec, maps: Sequence[int], size: int) -> list[list[int]]:
    """Maps whose models are parts of one larger model; alone where that is not known.

    Of ``size`` features, names of strategies that draw the same number of them name the same forest.
    """
    if not isinstance(spec.classifier, RandomForestClassifier):
        return [[i] for i in maps]
    own: dict[str, list[int]] = {}
    for i in maps:
        other = {p.name: v for p, v in spec.grid[i].items() if p.name not in ("numTrees", "maxDepth")}
        if "featureSubsetStrategy" in other:
            trees = spec.grid[i].get(spec.classifier.numTrees, spec.classifier.getOrDefault("numTrees"))
            other["featureSubsetStrategy"] = columns_drawn(other["featureSubsetStrategy"], size, trees)
        own.setdefault(json.dumps(other, sort_keys=True), []).append(i)
    return list(own.values())


def _fitted_family(spec: ModelSpec, family: Sequence[int], fit_rows: DataFrame) -> tuple[Model, list[tuple[int, int]]]:
    """The model that serves all maps of a family, and of a forest the shapes that it is cut to."""
    if not isinstance(spec.classifier, RandomForestClassifier):
        return spec.classifier.fit(fit_rows, spec.grid[family[0]]), []
    trees_param, depth_param = (spec.classifier.getParam(p) for p in ("numTrees", "maxDepth"))
    shapes = [
        tuple(spec.grid[i].get(p, spec.classifier.getOrDefault(p)) for p in (trees_param, depth_param)) for i in family
    ]
    largest = {**spec.grid[family[0]], trees_param: max(n for n, _ in shapes), depth_param: max(d for _, d in shapes)}
    return spec.classifier.fit(fit_rows, largest), shapes


def _encoded(
    spec: ModelSpec, train: DataFrame, folds: Sequence[int], whole: bool
) -> tuple[DataFrame, PipelineModel | None, dict[int, int]]:
    """Vectors of all training rows per fold, and those of a preparation fitted on all rows; features by fold."""
    rows = train.filter(F.col("fold").isNotNull())
    fitted = {f: spec.prep.fit(rows.filter(F.col("fold") != f)) for f in folds}
    if whole:
        fitted[ALL] = spec.prep.fit(rows)
    parts = [p.transform(rows).select(name(LABEL), WEIGHT, "fold", FEATURES, F.lit(f).alias("held")) for f, p in fitted.items()]
    return reduce(DataFrame.unionByName, parts), fitted.get(ALL), {f: len(p.feature_names()) for f, p in fitted.items()}


def score_folds(
    spec: ModelSpec,
    train: DataFrame,
    metrics: Sequence[str],
    folds: int,
    *,
    parallelism: int | None = None,
    ledger: Ledger | None = None,
    refits: bool = False,
) -> Scores:
    """Every metric of every parameter map on every fold.

    Forests and other models are fitted ``parallelism`` at a time, half of the cores unless
    given. With ``refits`` a booster's maps are fitted on all rows in the same passes.
    """
    spark = train.sparkSession
    keys = [curves.resolve_metric(m) for m in metrics]
    values: dict[tuple[str, int, int], float] = {}
    if ledger:
        for m in keys:
            for i, params in enumerate(spec.grid):
                for f in range(folds):
                    known = ledger.known.get(ledger.key(spec, params, f, m))
                    if known is not None:
                        values[m, i, f] = known
    missing = {f: [i for i in range(len(spec.grid)) if any((m, i, f) not in values for m in keys)] for f in range(folds)}
    missing = {f: maps for f, maps in missing.items() if maps}

    def record(fold: int, maps: Sequence[int], scored: DataFrame) -> None:
        with scratch(scored, "held-out") as table:
            found = measures(table, keys)
        for i, own in zip(maps, found, strict=True):
            values.update({(m, i, fold): v for m, v in own.items()})
        if ledger:
            ledger.write(spec, [(spec.grid[i], fold, m, v) for i, own in zip(maps, found, strict=True) for m, v in own.items()])

    models: dict[int, PipelineModel] = {}
    workers = parallelism or max(2, spark.sparkContext.defaultParallelism // 2)
    booster = isinstance(spec.classifier, HistogramBooster)
    if missing:
        encoded, prep, sizes = _encoded(spec, train, list(missing), booster and refits)
        with scratch(encoded, "vectors", ["held", "fold"]) as vectors, ThreadPool(workers) as pool:
            learned = vectors.filter(F.col("fold") != F.col("held"))
            held = {f: vectors.filter((F.col("held") == f) & (F.col("fold") == f)) for f in missing}
            if booster:
                asked = [(f, i) for f, maps in missing.items() for i in maps]
                if refits:
                    asked += [(ALL, i) for i in range(len(spec.grid))]
                fitted = spec.classifier.fit_groups(learned, [(f, spec.grid[i]) for f, i in asked], "held")
                found = dict(zip(asked, fitted, strict=True))
                models = {i: PipelineModel([prep, m]) for (f, i), m in found.items() if f == ALL}

                def measure(fold: int) -> None:
                    ps = held[fold]
                    columns: list[Column] = []
                    for i in missing[fold]:
                        p = f"p_{i}"
                        own = found[fold, i]
                        outputs = [own.getOrDefault(c) for c in ("rawPredictionCol", "probabilityCol", "predictionCol")]
                        ps = positive_probability(own.transform(ps), p).drop(*outputs)
                        columns.append(F.col(p))
                    record(fold, missing[fold], ps.select(name(LABEL), F.array(*columns).alias("ps")))

                pool.map(inheritable_thread_target(spark)(measure), list(missing))
            else:

                def fit(job: tuple[int, list[int]]) -> None:
                    fold, family = job
                    model, shapes = _fitted_family(spec, family, learned.filter(F.col("held") == fold))
                    if not shapes:
                        scored = positive_probability(model.transform(held[fold]))
                        record(fold, family, scored.select(name(LABEL), F.array("p").alias("ps")))
                        return
                    own = held[fold].select(name(LABEL), FEATURES)
                    record(fold, family, model.scores(own, shapes, "ps").select(name(LABEL), "ps"))
                    model.discard()

                jobs = [(f, family) for f, maps in missing.items() for family in families(spec, maps, sizes[f])]
                pool.map(inheritable_thread_target(spark)(fit), jobs, chunksize=1)
    table = {m: [[values[m, i, f] for f in range(folds)] for i in range(len(spec.grid))] for m in keys}
    return Scores(table, models)
