"""The append-only predictions: flags, latest score per key, reports and monitoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import name


@dataclass(frozen=True)
class ScoreColumns:
    """Column names of a predictions table."""

    id: str = "account_id"
    probability: str = "probability"
    flag: str = "flag"
    threshold: str = "threshold"
    model: str = "model"
    model_version: str = "model_version"
    run_id: str = "run_id"
    source_table: str = "source_table"
    scored_at: str = "scored_at"


SCORES = ScoreColumns()


def threshold_flag(scored: DataFrame, threshold: float, cols: ScoreColumns = SCORES) -> DataFrame:
    """Attach the threshold and the flag: 1 where the probability reaches it."""
    return scored.withColumns(
        {
            cols.flag: (name(cols.probability) >= F.lit(threshold)).cast("int"),
            cols.threshold: F.lit(float(threshold)),
        }
    )


def latest_scores(predictions: DataFrame, cols: ScoreColumns = SCORES) -> DataFrame:
    """The newest row per key, by time and then run id.

    The rank filter is applied on each task before the shuffle as well, so a key with very
    many scores sends one row per task.
    """
    newest = Window.partitionBy(name(cols.id)).orderBy(
        name(cols.scored_at).desc(), name(cols.run_id).desc()
    )
    return (
        predictions.withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .drop("_rank")
    )


def reapply_threshold(
    predictions: DataFrame, threshold: float, cols: ScoreColumns = SCORES
) -> DataFrame:
    """Latest scores with flags recomputed for a new threshold; nothing is scored again."""
    return threshold_flag(latest_scores(predictions, cols), threshold, cols)


def filter_run(
    predictions: DataFrame, run_id: str, n: int = 20, cols: ScoreColumns = SCORES
) -> DataFrame:
    """The ``n`` highest scores of one run; the run filter reaches the scan."""
    return top_risk(predictions.filter(name(cols.run_id) == run_id), n, cols)


def top_risk(predictions: DataFrame, n: int = 20, cols: ScoreColumns = SCORES) -> DataFrame:
    """The ``n`` highest probabilities, ties by id and run."""
    return predictions.orderBy(
        name(cols.probability).desc(), name(cols.id), name(cols.run_id)
    ).limit(n)


def newest(predictions: DataFrame, n: int = 20, cols: ScoreColumns = SCORES) -> DataFrame:
    """The ``n`` rows scored last."""
    return predictions.orderBy(
        name(cols.scored_at).desc(), name(cols.id), name(cols.run_id)
    ).limit(n)


def prediction_monitor(predictions: DataFrame, cols: ScoreColumns = SCORES) -> DataFrame:
    """Rows, mean probability and flag rate per day of scoring, newest first."""
    return (
        predictions.groupBy(F.to_date(name(cols.scored_at)).alias("score_date"))
        .agg(
            F.count("*").alias("n"),
            F.avg(name(cols.probability)).alias("avg_probability"),
            F.avg(name(cols.flag)).alias("flag_rate"),
        )
        .orderBy(F.desc("score_date"))
    )


def run_summary(
    predictions: DataFrame, by: str | None = None, cols: ScoreColumns = SCORES
) -> DataFrame:
    """Scored and flagged rows, flag rate and threshold per run (or another column)."""
    flagged = F.sum(name(cols.flag))
    return predictions.groupBy(name(by or cols.run_id)).agg(
        F.count("*").alias("scored"),
        flagged.alias("flagged"),
        (flagged / F.count("*")).alias("flag_rate"),
        F.max(name(cols.threshold)).alias("threshold"),
    )


def score_parity(
    left: DataFrame, right: DataFrame, tolerance: float = 1e-6, cols: ScoreColumns = SCORES
) -> DataFrame:
    """Compare two scorings by id: ids of one side only, and ids that differ.

    Each side is reduced to one row per id first, on the partitioning of the join; copies
    of an id agree if their number and the range of their values do.
    """

    def per_id(df: DataFrame) -> DataFrame:
        p, flag = name(cols.probability), name(cols.flag)
        return df.groupBy(name(cols.id).alias("id")).agg(
            F.count("*").alias("n"),
            F.min(p).alias("p_low"),
            F.max(p).alias("p_high"),
            F.sum(flag).alias("flags"),
        )

    a, b = per_id(left).alias("a"), per_id(right).alias("b")
    both = F.col("a.id").isNotNull() & F.col("b.id").isNotNull()
    apart = F.lit(False)
    for c in ("p_low", "p_high"):
        apart = apart | (F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) > tolerance)
    flags_differ = (F.col("a.flags") != F.col("b.flags")) | (F.col("a.n") != F.col("b.n"))
    return a.join(b, F.col("a.id") == F.col("b.id"), "full").agg(
        F.count_if(both).alias("compared"),
        F.count_if(F.col("b.id").isNull()).alias("only_left"),
        F.count_if(F.col("a.id").isNull()).alias("only_right"),
        F.count_if(both & apart).alias("probability_differs"),
        F.count_if(both & flags_differ).alias("flag_differs"),
    )
