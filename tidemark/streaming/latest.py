"""The latest score per key, kept up to date from a stream of appended scores.

Each micro-batch is reduced to its newest row per key and written to a folder of its own
number; a batch that is run again overwrites that folder, so a replay adds nothing. Every so
many batches the folders are merged into a new base. A reader takes the newest row per key of
the last whole base and the batches after it: one shuffle, and no batch reads the table.
Rows may arrive in any order, as the time of scoring decides and not that of arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions import name, required
from tidemark.operators.scores import SCORES, ScoreColumns, latest_scores
from tidemark.session import path_exists
from tidemark.sources.predictions import predictions_schema


def keep_latest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    cols: ScoreColumns = SCORES,
    *,
    compact_every: int = 20,
    **trigger,
) -> StreamingQuery:
    """Start the job; without a trigger it takes what has arrived and ends.

    A table belongs to one job and its checkpoint. A NULL in one of the nine columns fails the
    batch. What lies before the last base but one is deleted, so a reader that planned its read
    before two merges may have to read again.
    """
    if compact_every < 1:
        raise ValueError("compact_every must be at least 1")

    def merge(batch: DataFrame, number: int) -> None:
        write_changes(batch, path, number, cols)
        if number % compact_every == compact_every - 1:
            compact(batch.sparkSession, path, number, cols)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_changes(batch: DataFrame, path: str, number: int, cols: ScoreColumns = SCORES) -> None:
    """The newest row per key of one batch, in place of what that batch wrote before."""
    schema = predictions_schema(cols)
    typed = batch.select(*[name(f.name).cast(f.dataType).alias(f.name) for f in schema])
    checked = typed.select(*[required(f.name) for f in schema])
    latest_scores(checked, cols).write.mode("overwrite").parquet(f"{path}/changes/batch={number}")


def compact(spark: SparkSession, path: str, number: int, cols: ScoreColumns = SCORES) -> None:
    """Merge all up to a batch into a base, and drop what the base before it covers."""
    before = _bases(spark, path, number - 1)
    current_scores(spark, path, cols, base=max(before, default=-1), upto=number).write.mode("overwrite").parquet(
        f"{path}/base/upto={number}"
    )
    if not before:
        return
    kept = max(before)
    old = [f"base/upto={n}" for n in before if n < kept]
    old += [f"changes/batch={n}" for n in _numbers(spark, f"{path}/changes", "batch=") if n <= kept]
    for folder in old:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def current_scores(
    spark: SparkSession, path: str, cols: ScoreColumns = SCORES, *, base: int | None = None, upto: int | None = None
) -> DataFrame:
    """The newest row per key; of a table that nothing was written to, no rows.

    ``base`` and ``upto`` name another base than the last whole one, and the last batch taken.
    """
    schema = predictions_schema(cols)
    if base is None:
        base = max(_bases(spark, path, upto), default=-1)
    parts = spark.createDataFrame([], schema)
    if base >= 0:
        parts = parts.unionByName(spark.read.schema(schema).parquet(f"{path}/base/upto={base}"))
    if path_exists(spark, f"{path}/changes"):
        layout = StructType([*schema, StructField("batch", LongType())])
        changes = spark.read.schema(layout).parquet(f"{path}/changes").filter(F.col("batch") > base)
        if upto is not None:
            changes = changes.filter(F.col("batch") <= upto)
        parts = parts.unionByName(changes.drop("batch"))
    return latest_scores(parts, cols)


def _bases(spark: SparkSession, path: str, upto: int | None) -> list[int]:
    """The whole bases: Spark marks a folder when its job has committed."""
    found = _numbers(spark, f"{path}/base", "upto=")
    found = [n for n in found if upto is None or n <= upto]
    return [n for n in found if path_exists(spark, f"{path}/base/upto={n}/_SUCCESS")]


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers in names of folders: a few per merge, as older ones are deleted."""
    if not path_exists(spark, folder):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))
