"""Exact quantiles, linearly interpolated, for tables of any size.

A sketch aggregate brackets each wanted rank between two values; more passes count the
rows below the brackets and the distinct values inside them. Groups, targets and results
are frames, for any number of groups. The built-in exact ``percentile`` would hold every
distinct value of a group in one task instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.functions.columns import to_number
from tidemark.session import materialise

ACCURACY = 100_000


def unpivot_numbers(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Long form (grp, column, value) of numeric columns; NULL and NaN are left out."""
    types = dict(df.dtypes)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), to_number(name(c), types[c]).alias("value"))
            for c in columns
        ]
    )
    group = name(by) if by else F.lit("all")
    return (
        df.select(group.alias("grp"), F.explode(pairs).alias("pair"))
        .select("grp", "pair.column", "pair.value")
        .filter(F.col("value").isNotNull())
    )


def summarise(
    df: DataFrame, columns: Sequence[str], by: str | None = None, probs: Sequence[float] = ()
) -> DataFrame:
    """One row per group and column: n, mean, std, min, max, and a sketch for ``probs``."""
    long = unpivot_numbers(df, columns, by)
    sketch = (
        [F.percentile_approx("value", list(probs), ACCURACY).alias("sketch")] if probs else []
    )
    return long.groupBy("grp", "column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *sketch,
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None = None
) -> DataFrame:
    """Rows (grp, column, prob, value): the quantile with linear interpolation."""
    return _quantiles(df, columns, probs, by).select("grp", "column", "prob", "value")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max of each numeric column."""
    found = _quantiles(df, columns, (0.25, 0.5, 0.75), None)
    quartile = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    return found.groupBy("column", "n", "mean", "std", "min", "max").agg(
        quartile(0.25).alias("q25"), quartile(0.5).alias("q50"), quartile(0.75).alias("q75")
    ).select("column", F.col("n").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def _quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None) -> DataFrame:
    """The summary of each group and column, with each quantile (prob, value)."""
    slack = 2.0 / ACCURACY
    bounds = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-slack, slack)})
    groups = materialise(summarise(df, columns, by, bounds), "summary")
    # Up to ACCURACY rows the bracket is the whole group; beyond, the sketch's error is less
    # than its slack, which is two rows at least.
    whole = F.col("n") <= ACCURACY
    edge = lambda p, end: F.when(whole, F.col(end)).otherwise(F.col("sketch")[bounds.index(p)])
    wanted = []
    for p in map(float, probs):
        position = (F.col("n") - 1) * F.lit(p)
        for rank in (F.floor(position) + 1, F.ceil(position) + 1):
            low, high = edge(max(p - slack, 0.0), "min"), edge(min(p + slack, 1.0), "max")
            wanted.append(F.struct(rank.cast("long").alias("rank"), low.alias("low"), high.alias("high")))
    targets = groups.select(
        F.col("grp").alias("g"), F.col("column").alias("c"), F.array(*wanted).alias("targets")
    )
    long = unpivot_numbers(df, columns, by)
    placed = long.join(targets, F.col("grp").eqNullSafe(F.col("g")) & (F.col("column") == F.col("c")))
    below = placed.groupBy("grp", "column").agg(
        F.array(*[F.count_if(F.col("value") < F.col("targets")[i]["low"]) for i in range(len(wanted))]).alias("below")
    )
    # Values outside all brackets are only counted; the others are merged before the shuffle.
    inside = F.filter(
        F.sequence(F.lit(0), F.lit(len(wanted) - 1)),
        lambda i: F.col("value").between(F.col("targets")[i]["low"], F.col("targets")[i]["high"]),
    )
    counted = placed.select(
        "grp", "column", "value", F.explode(inside).alias("i"), F.col("targets")[F.col("i")]["rank"].alias("rank")
    )
    counted = counted.groupBy("grp", "column", "i", "rank", "value").count()
    order = Window.partitionBy("grp", "column", "i").orderBy("value")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("upto", F.sum("count").over(order))
    both = below.select(F.col("grp").alias("g"), F.col("column").alias("c"), "below")
    counted = counted.join(both, F.col("grp").eqNullSafe(F.col("g")) & (F.col("column") == F.col("c")))
    rank = F.col("rank") - F.col("below")[F.col("i")]
    hits = counted.filter((F.col("upto") >= rank) & (F.col("upto") - F.col("count") < rank))
    at = lambda i: F.max(F.when(F.col("i") == i, F.col("value")))
    values = hits.groupBy(F.col("grp").alias("g"), F.col("column").alias("c")).agg(
        F.array(*[at(i) for i in range(len(wanted))]).alias("values")
    )
    joined = groups.join(values, F.col("grp").eqNullSafe(F.col("g")) & (F.col("column") == F.col("c")))
    found = []
    for k, p in enumerate(map(float, probs)):
        position = (F.col("n") - 1) * F.lit(p)
        low, high = F.col("values")[2 * k], F.col("values")[2 * k + 1]
        value = low + (high - low) * (position - F.floor(position))
        found.append(F.struct(F.lit(p).alias("prob"), value.alias("value")))
    rows = joined.withColumn("found", F.explode(F.array(*found)))
    return rows.select("grp", "column", "n", "mean", "std", "min", "max", "found.prob", "found.value")
