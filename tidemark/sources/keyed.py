"""Score tables clustered by key, so that a lookup reads a few row groups.

Rows are range-partitioned and sorted by key, and each row group carries its key range and
a bloom filter. A short list of keys becomes a filter that the scan skips files and row
groups with; a long one is joined, after the rows outside its key range are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.operators.scores import SCORES, ScoreColumns, latest_scores
from tidemark.session import local_frame
from tidemark.sources.tables import lookup_keys

# Bytes of a row group and of a page; the filter's share of false hits.
ROW_GROUP, PAGE, FALSE_HITS = 8 << 20, 64 << 10, 0.01
# Keys of the longest list that becomes a filter, and keys of one pushed IN.
SHORT, PUSHED = 200, 10


def write_keyed(
    df: DataFrame,
    path: str,
    id_col: str,
    *,
    partitions: int | None = None,
    row_group: int = ROW_GROUP,
    keys_per_file: int = 1_000_000,
) -> None:
    """Replace the table at ``path`` by rows in ranges of the key.

    A key of many rows stays in one range; give ``keys_per_file`` for the size of the bloom
    filters. Rows without a key come first. The frame must not read from ``path``.
    """
    ranges = df.repartitionByRange(*([partitions] if partitions else []), name(id_col))
    (
        ranges.sortWithinPartitions(name(id_col))
        .write.mode("overwrite")
        .option("parquet.block.size", row_group)
        .option("parquet.page.size", PAGE)
        .option(f"parquet.bloom.filter.enabled#{id_col}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{id_col}", keys_per_file)
        .option(f"parquet.bloom.filter.fpp#{id_col}", FALSE_HITS)
        .parquet(path)
    )


def export_keyed_cache(
    predictions: DataFrame, path: str, cols: ScoreColumns = SCORES, *, partitions: int | None = None
) -> None:
    """Write the latest score per key, clustered by key; no predictions are an error."""
    if predictions.isEmpty():
        raise ValueError("No predictions to cache: score a population first")
    write_keyed(latest_scores(predictions, cols), path, cols.id, partitions=partitions)


def one_of(id_col: str, keys: Sequence) -> Column:
    """Whether the key is among a few, in parts that a Parquet scan takes as equalities."""
    own = sorted(set(keys))
    parts = [name(id_col).isin(own[i : i + PUSHED]) for i in range(0, len(own), PUSHED)]
    chosen = F.lit(False)
    for i, part in enumerate(parts):
        chosen = part if i == 0 else chosen | part
    return chosen


def lookup_keyed(spark: SparkSession, path: str, keys: DataFrame, id_col: str) -> DataFrame:
    """Every wanted key with its row of a keyed table, and ``found`` = whether there is one.

    Rows of ``keys`` are kept as they are, repeated and NULL ones included; NULL is never
    found. The result is that of :func:`lookup_keys`, whatever the number of keys.
    """
    table = spark.read.parquet(path)
    wanted = keys.select(id_col).filter(name(id_col).isNotNull())
    few = [r[0] for r in wanted.distinct().limit(SHORT + 1).collect()]
    if len(few) <= SHORT:
        return lookup_keys(table.filter(one_of(id_col, few)), keys, id_col)
    ends = wanted.agg(F.min(id_col), F.max(id_col)).first()
    inside = table.filter(name(id_col).between(F.lit(ends[0]), F.lit(ends[1])))
    return lookup_keys(inside, keys, id_col)


def lookup_list(spark: SparkSession, path: str, keys: Sequence, id_col: str) -> DataFrame:
    """:func:`lookup_keyed` for keys of the driver's."""
    types = dict(spark.read.parquet(path).dtypes)
    frame = local_frame(spark, [(k,) for k in keys], f"`{id_col}` {types[id_col]}")
    return lookup_keyed(spark, path, frame, id_col)
