"""Exact precision-recall curve, threshold choice and metrics of a scored table.

Rows are merged to one per distinct score with partial aggregation and written once; the
scored rows, often the output of a model, are so evaluated only once. That small table is
cumulated by :mod:`tidemark.operators.ranking`, and every metric is one aggregate over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import f_beta, name, ratio
from tidemark.operators.ranking import running_totals, value_buckets
from tidemark.session import materialise

STRATEGIES = ("f1", "f2", "recall_floor")
RECALL_FLOOR = 0.75
DEFAULT_THRESHOLD = 0.5


def score_counts(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row per distinct score: positives, rows and the cumulative counts from above.

    A missing label or score fails the job.
    """
    score = name(p).cast("double")
    checked = scored.select(
        F.coalesce(name(y).cast("int"), F.raise_error(F.lit("label is missing"))).alias("y"),
        F.coalesce(
            F.when(~F.isnan(score), score), F.raise_error(F.lit("score is missing"))
        ).alias("p"),
    )
    distinct = checked.groupBy("p").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    distinct = materialise(distinct, "curve")
    return running_totals(value_buckets(distinct, "p"), "p", ["pos", "n"])


def pr_curve(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Precision and recall at each distinct score, and the closing point (1, 0)."""
    curve = _with_ratios(score_counts(scored, y, p)).select("threshold", "precision", "recall")
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def _with_ratios(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("p").alias("threshold"),
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        ratio(F.col("cum_pos"), F.col("total_pos"), empty=1.0).alias("recall"),
    )


def best_threshold(scored: DataFrame, y: str = "y", p: str = "p", **options) -> DataFrame:
    """:func:`best_point` of a scored table."""
    return best_point(score_counts(scored, y, p), **options)


def best_point(
    counts: DataFrame,
    *,
    strategy: str = "f1",
    recall_floor: float = RECALL_FLOOR,
    beta: float = 2.0,
) -> DataFrame:
    """The one row of a curve the strategy picks; the lowest threshold among equals."""
    if strategy not in STRATEGIES:
        raise ValueError(f"threshold strategy must be one of {STRATEGIES}, got {strategy!r}")
    curve = _with_ratios(counts)
    precision, recall = F.col("precision"), F.col("recall")
    tiny = 1e-12  # fixed value: keeps the quotient defined where both ratios are 0
    if strategy == "recall_floor":
        enough = recall >= recall_floor
        objective = F.when(enough, precision).otherwise(recall)
        order = [F.desc(enough), F.desc("objective")]
    else:
        if strategy == "f2":
            weight = beta**2
            objective = (1 + weight) * precision * recall / (weight * precision + recall + tiny)
        else:
            objective = 2 * precision * recall / (precision + recall + tiny)
        order = [F.desc("objective")]
    return curve.withColumn("objective", objective).orderBy(*order, F.asc("threshold")).limit(1)


def pick_threshold(counts: DataFrame, **options) -> float:
    """The threshold of :func:`best_point` as a number, 0.5 for an empty curve."""
    row = best_point(counts, **options).first()
    return DEFAULT_THRESHOLD if row is None else float(row["threshold"])


def confusion(y: Column, flag: Column) -> dict[str, Column]:
    """Aggregates tn, fp, fn, tp of a 0/1 label and a boolean flag."""
    return {
        "tn": F.count_if((y == 0) & ~flag),
        "fp": F.count_if((y == 0) & flag),
        "fn": F.count_if((y == 1) & ~flag),
        "tp": F.count_if((y == 1) & flag),
    }


def confusion_matrix(
    scored: DataFrame, threshold: float, y: str = "y", p: str = "p"
) -> DataFrame:
    """One row tn, fp, fn, tp at a threshold (flagged when the score reaches it)."""
    cells = confusion(name(y), name(p) >= threshold)
    return scored.agg(*[c.alias(k) for k, c in cells.items()])


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall, f1, f2 and mcc to columns tn, fp, fn, tp (0 where undefined)."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    precision, recall = ratio(tp, tp + fp, 0.0), ratio(tp, tp + fn, 0.0)
    spread = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return counts.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "f1": f_beta(precision, recall, 1.0),
            "f2": f_beta(precision, recall, 2.0),
            "mcc": ratio(tp * tn - fp * fn, spread, 0.0),
        }
    )


def evaluate(scored: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """:func:`evaluate_curve` of a scored table."""
    return evaluate_curve(score_counts(scored, y, p), threshold)


def evaluate_curve(counts: DataFrame, threshold: float) -> DataFrame:
    """Average precision, ROC-AUC, rates and confusion counts at a threshold, in one row."""
    pos, n, cum_pos, cum_n = (F.col(c) for c in ("pos", "n", "cum_pos", "cum_n"))
    flagged = F.col("p") >= threshold
    neg = n - pos
    # Average precision sums precision over the recall steps; the area under the ROC
    # counts pairs ranked right, ties by half.
    sums = counts.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(flagged, pos)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(flagged, neg)), F.lit(0)).alias("fp"),
        F.sum(pos * (cum_pos / cum_n)).alias("ap"),
        F.sum(neg * (cum_pos - pos / 2)).alias("ranked"),
    )
    cells = sums.withColumns(
        {
            "fn": F.col("positives") - F.col("tp"),
            "tn": F.col("rows") - F.col("positives") - F.col("fp"),
        }
    )
    negatives = F.col("rows") - F.col("positives")
    return with_rates(cells).select(
        F.lit(float(threshold)).alias("threshold"),
        ratio(F.col("ap"), F.col("positives"), 0.0).alias("pr_auc"),
        ratio(
            F.col("ranked"), F.col("positives").cast("double") * negatives.cast("double")
        ).alias("roc_auc"),
        "precision",
        "recall",
        "f1",
        "f2",
        "mcc",
        "tn",
        "fp",
        "fn",
        "tp",
        "positives",
        "rows",
    )


def pr_summary(scored: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """Average precision, prevalence, lift over random and the operating point."""
    prevalence = ratio(F.col("positives"), F.col("rows"))
    lift = F.when(prevalence > 0, F.col("pr_auc") / prevalence).otherwise(F.lit(float("nan")))
    return evaluate(scored, threshold, y, p).select(
        "threshold",
        "pr_auc",
        prevalence.alias("prevalence"),
        lift.alias("lift_over_random"),
        F.col("precision").alias("operating_precision"),
        F.col("recall").alias("operating_recall"),
    )


METRICS = ("pr_auc", "f1", "f2", "mcc")
ALIASES = {"average_precision": "pr_auc"}


def resolve_metric(metric: str) -> str:
    key = ALIASES.get(metric.lower(), metric.lower())
    if key not in METRICS:
        raise ValueError(f"Unknown metric {metric!r}; expected one of {METRICS}")
    return key


def metric_value(
    scored: DataFrame, metric: str, y: str = "y", p: str = "p", flag: str | None = None
) -> DataFrame:
    """One row (metric, value): average precision, or f1, f2, mcc of the positive class.

    The last three need only confusion counts, by ``flag`` or by a score of 0.5 and more.
    """
    key = resolve_metric(metric)
    if key == "pr_auc":
        row = evaluate(scored, DEFAULT_THRESHOLD, y, p)
    else:
        flagged = (name(flag) == 1) if flag else (name(p) >= DEFAULT_THRESHOLD)
        cells = confusion(name(y), flagged)
        row = with_rates(scored.agg(*[c.alias(k) for k, c in cells.items()]))
    return row.select(F.lit(key).alias("metric"), F.col(key).alias("value"))
