"""The release record of a champion, drawn from the metrics table of its run."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.roles import BASELINE, ColumnRoles

HEADLINE = ("recall", "precision", "f1", "pr_auc", "roc_auc")
MANIFEST_SCHEMA = (
    "release_id string, model_id string, model string, feature_set string, threshold double,"
    " feature_columns array<string>, headline_metrics map<string, double>,"
    " validation_metrics map<string, double>, cv_score double, run_config string,"
    " artifact string, provenance map<string, string>, packaged_at timestamp"
)


def threshold_of(metrics: Mapping) -> float:
    """The decision threshold of a metrics document, at the top or under ``test``."""
    for place in (metrics, metrics.get("test") or {}):
        if place.get("threshold") is not None:
            return float(place["threshold"])
    raise KeyError("No threshold in the metrics")


def _values(split: str, names: Sequence[str]) -> Column:
    """The named metrics of one split as a map; a run has one row per metric."""
    wanted = (F.col("split") == split) & F.col("metric").isin(*names)
    return F.map_from_entries(
        F.array_sort(F.collect_list(F.when(wanted, F.struct("metric", "value"))))
    )


def _value(metric: str) -> Column:
    return F.max(F.when(F.col("metric") == metric, F.col("value")))


def release_manifest(
    metrics: DataFrame,
    roles: ColumnRoles,
    *,
    model: str,
    model_id: str,
    release_id: str,
    artifact: str,
    feature_set: str = BASELINE,
    run_config: Mapping | None = None,
    provenance: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row: what is deployed, at which threshold, and the metrics it was chosen with.

    ``metrics`` is the metrics table of one run. Test metrics are the headline; a model
    without a threshold fails.
    """
    missing = F.raise_error(F.lit(f"No threshold in the metrics of {model}"))
    origin = [F.lit(text) for pair in (provenance or {}).items() for text in pair]
    record = (
        metrics.filter(F.col("model") == model)
        .agg(
            _value("threshold").alias("threshold"),
            _values("test", HEADLINE).alias("headline_metrics"),
            _values("validation", [m for m in HEADLINE if m != "roc_auc"]).alias(
                "validation_metrics"
            ),
            _value("cv_score").alias("cv_score"),
        )
        .withColumns(
            {
                "release_id": F.lit(release_id),
                "model_id": F.lit(model_id),
                "model": F.lit(model),
                "feature_set": F.lit(feature_set),
                "threshold": F.coalesce("threshold", missing),
                "feature_columns": F.array(*map(F.lit, roles.feature_columns(feature_set))),
                "run_config": F.lit(json.dumps(dict(run_config or {}), sort_keys=True)),
                "artifact": F.lit(artifact),
                "provenance": F.create_map(*origin).cast("map<string, string>"),
                "packaged_at": F.current_timestamp(),
            }
        )
    )
    return record.select(*StructType.fromDDL(MANIFEST_SCHEMA).names)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Write the record as one JSON object, next to the saved pipeline."""
    manifest.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(path)
