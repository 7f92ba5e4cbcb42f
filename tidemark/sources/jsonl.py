"""JSON lines: batch requests and responses, and the score cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import name
from tidemark.operators.cleaning import scoring_features
from tidemark.operators.scores import SCORES, ScoreColumns, latest_scores
from tidemark.roles import ColumnRoles


def request_lines(raw: DataFrame, roles: ColumnRoles) -> DataFrame:
    """One request per row: ``{"instances": [{features..., id}]}`` in column ``value``."""
    features = scoring_features(raw, roles)
    instance = F.struct(
        *[name(c) for c in roles.feature_columns()], name(roles.id).cast("string").alias(roles.id)
    )
    request = F.struct(F.array(instance).alias("instances"))
    return features.select(F.to_json(request, {"ignoreNullFields": "false"}).alias("value"))


def export_jsonl(raw: DataFrame, roles: ColumnRoles, path: str) -> None:
    """Write the batch requests; ``path`` becomes a folder of part files."""
    request_lines(raw, roles).write.mode("overwrite").text(path)


def parse_jsonl(lines: DataFrame, item: T.StructType | str) -> DataFrame:
    """Rows of response lines: a ``predictions`` list is flattened, else the object is the row.

    Blank lines are skipped; a malformed line fails the job; an empty list gives no row.
    """
    if isinstance(item, str):
        item = T.StructType.fromDDL(item)
    strict = {"mode": "FAILFAST"}
    text = lines.select(F.col(lines.columns[0]).alias("line")).filter(F.trim("line") != "")
    listed = T.StructType([T.StructField("predictions", T.ArrayType(item))])
    rows = text.select(
        F.from_json("line", listed, strict)["predictions"].alias("listed"),
        F.from_json("line", item, strict).alias("single"),
    ).select(F.explode(F.coalesce("listed", F.array("single"))).alias("row"))
    return rows.select("row.*")


def response_item(cols: ScoreColumns = SCORES) -> T.StructType:
    return T.StructType(
        [
            T.StructField(cols.id, T.StringType()),
            T.StructField(cols.probability, T.DoubleType()),
            T.StructField(cols.flag, T.LongType()),
            T.StructField(cols.threshold, T.DoubleType()),
        ]
    )


def load_batch_output(
    spark: SparkSession, path: str, cols: ScoreColumns = SCORES, *, pattern: str = "*.jsonl"
) -> DataFrame:
    """All files of ``pattern`` below a folder as typed rows; none, or one without id, is an error."""
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .text(path)
    )
    rows = parse_jsonl(lines, response_item(cols))
    if rows.isEmpty():
        raise FileNotFoundError(f"No batch output JSON lines under {path}")
    missing = F.raise_error(F.lit(f"Batch output without {cols.id}"))
    return rows.withColumn(cols.id, F.coalesce(name(cols.id), missing))


def cache_fields(cols: ScoreColumns = SCORES) -> list[str]:
    """Names of the cached columns, in alphabetical order."""
    return sorted(
        [
            cols.id,
            cols.probability,
            cols.flag,
            cols.threshold,
            cols.model,
            cols.model_version,
            cols.run_id,
            cols.scored_at,
        ]
    )


def export_cache(predictions: DataFrame, path: str, cols: ScoreColumns = SCORES) -> None:
    """Write the latest score per key, one JSON object per line with sorted keys."""
    if predictions.isEmpty():
        raise ValueError("No predictions to cache: score a population first")
    write_cache(latest_scores(predictions, cols), path, cols)


def write_cache(latest: DataFrame, path: str, cols: ScoreColumns = SCORES) -> None:
    fields = [
        name(c).cast("string").alias(c) if c == cols.scored_at else name(c)
        for c in cache_fields(cols)
    ]
    latest.select(*fields).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def load_cache(spark: SparkSession, path: str, cols: ScoreColumns = SCORES) -> DataFrame:
    """The cache keyed by id; of several lines for a key the newest (time, run) wins."""
    types: dict[str, T.DataType] = {
        cols.probability: T.DoubleType(),
        cols.flag: T.LongType(),
        cols.threshold: T.DoubleType(),
    }
    schema = T.StructType(
        [T.StructField(c, types.get(c, T.StringType())) for c in cache_fields(cols)]
    )
    lines = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return latest_scores(lines, cols)
