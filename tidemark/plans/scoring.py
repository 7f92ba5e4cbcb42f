"""Batch scoring of an unlabelled population into the predictions table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tidemark.functions import name
from tidemark.operators.cleaning import scoring_features, validate_schema
from tidemark.operators.scores import SCORES, ScoreColumns, run_summary, threshold_flag
from tidemark.plans.estimators import positive_probability
from tidemark.roles import ColumnRoles
from tidemark.sources.jsonl import load_batch_output
from tidemark.sources.predictions import new_run_id, read_predictions, write_predictions
from tidemark.sources.tables import select_keys


def score_batch(
    raw: DataFrame,
    model: PipelineModel,
    roles: ColumnRoles,
    *,
    threshold: float,
    model_name: str,
    model_version: str,
    keep: Sequence[str] = (),
    cols: ScoreColumns = SCORES,
) -> DataFrame:
    """Clean, check, predict and flag: one narrow pass over the population.

    Columns ``keep`` of the raw table are passed on behind the six score columns.
    """
    needed = [roles.id, roles.tenure, roles.amount, *roles.feature_columns(), *keep]
    features = scoring_features(validate_schema(raw, needed, exact=False), roles, keep)
    predicted = positive_probability(model.transform(features), cols.probability)
    flagged = threshold_flag(predicted, threshold, cols)
    return flagged.select(
        name(roles.id).cast("string").alias(cols.id),
        name(cols.probability),
        name(cols.flag),
        name(cols.threshold),
        F.lit(model_name).alias(cols.model),
        F.lit(model_version).alias(cols.model_version),
        *[name(c) for c in keep],
    )


def score_and_append(
    raw: DataFrame,
    model: PipelineModel,
    roles: ColumnRoles,
    path: str,
    *,
    source_table: str,
    run_id: str | None = None,
    scored_at: datetime | None = None,
    cols: ScoreColumns = SCORES,
    **options,
) -> DataFrame:
    """Score a population, append the run, and return its summary from the written rows."""
    if raw.isEmpty():
        raise ValueError(f"{source_table} is empty: seed the scoring population first")
    run_id = run_id or new_run_id()
    scored = score_batch(raw, model, roles, cols=cols, **options)
    write_predictions(
        scored, path, run_id=run_id, source_table=source_table, scored_at=scored_at, cols=cols
    )
    return run_summary(read_predictions(raw.sparkSession, path, cols, run_id=run_id), cols=cols)


def score_requests(
    spark: SparkSession,
    requests: str,
    responses: str,
    model: PipelineModel,
    roles: ColumnRoles,
    schema: str,
    *,
    threshold: float,
    cols: ScoreColumns = SCORES,
) -> None:
    """Answer request lines with response lines, as an external prediction service does.

    ``schema`` is that of one instance. A line that is no request fails the job.
    """
    instance = StructType([StructField("instances", ArrayType(StructType.fromDDL(schema)))])
    lines = spark.read.text(requests)
    parsed = lines.select(F.from_json("value", instance, {"mode": "FAILFAST"}).alias("request"))
    rows = parsed.select(F.explode("request.instances").alias("row")).select("row.*")
    scored = score_batch(
        rows, model, roles, threshold=threshold, model_name="", model_version="", cols=cols
    )
    fields = [name(c) for c in (cols.id, cols.probability, cols.flag, cols.threshold)]
    answer = F.struct(F.array(F.struct(*fields)).alias("predictions"))
    scored.select(F.to_json(answer).alias("value")).write.mode("overwrite").text(responses)


def append_batch_output(
    spark: SparkSession,
    responses: str,
    path: str,
    *,
    model_name: str,
    model_version: str,
    source_table: str,
    run_id: str | None = None,
    scored_at: datetime | None = None,
    pattern: str = "*.jsonl",
    cols: ScoreColumns = SCORES,
) -> DataFrame:
    """Append the JSON lines of an external batch job as one run, and return its summary."""
    run_id = run_id or new_run_id()
    scored = load_batch_output(spark, responses, cols, pattern=pattern).withColumns(
        {cols.model: F.lit(model_name), cols.model_version: F.lit(model_version)}
    )
    write_predictions(
        scored, path, run_id=run_id, source_table=source_table, scored_at=scored_at, cols=cols
    )
    return run_summary(read_predictions(spark, path, cols, run_id=run_id), cols=cols)


def score_one_with_actual(
    raw: DataFrame,
    ids: Iterable[str],
    model: PipelineModel,
    roles: ColumnRoles,
    *,
    threshold: float,
    model_name: str,
    model_version: str = "",
    cols: ScoreColumns = SCORES,
) -> DataFrame:
    """Score chosen ids of a labelled table next to their actual label; none found is an error."""
    wanted = select_keys(raw, roles.id, ids)
    if wanted.isEmpty():
        raise ValueError(f"No row found for the wanted {roles.id}")
    scored = score_batch(
        wanted,
        model,
        roles,
        threshold=threshold,
        model_name=model_name,
        model_version=model_version,
        keep=[roles.label],
        cols=cols,
    )
    actual = roles.label_column(dict(raw.dtypes)[roles.label])
    return scored.withColumn("actual", actual).drop(roles.label)
