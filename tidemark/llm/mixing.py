"""Mixing sources to target weights, by water-filling under a cap of epochs.

Sources share a budget of words by weight. A source whose share would be more than
``max_epochs`` times its size stops there, and what is left over is shared again by weight
among the others, until no source is above. Each document is then taken as often as the
target holds its whole source, and the rest of the target, a fraction of the source, is
filled with documents in a seeded order: a document is taken if more than half of it
fits, so the words taken differ from the target by at most half a document.

Texts that are null or without words have size 0 and take no words. A null source is a
source, the last. Rows of equal id and text have the same place in the order. A table
without rows or words has targets of 0. Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, word_count
from tidemark.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Add the target to one row per source (source, source_size).

    With sources in ascending order of cap / weight, the level at a source is what is left
    by the caps before it, over the weights from it on. The sources whose cap is below
    that level are full; the first that is not sets the level of all others. The windows
    over all sources hold one row per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    position = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1
    caps = sizes.select(
        "source",
        "source_size",
        F.element_at(cycle, position).alias("weight"),
        (F.col("source_size") * float(max_epochs)).alias("cap"),
    )
    everything = Window.partitionBy(F.lit(0))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    left = budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = caps.withColumn("level", left / open_weight)
    set_level = F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level")))
    levelled = levels.withColumn("level", set_level.over(everything))
    # Without a level every source is full.
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return levelled.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often each document is taken.

    Columns: the id, source, size, source_size, target, taken (words), copies, row_key.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        row_key(doc_id, text, seed).alias("row_key"),
    )
    rows = materialise(rows, "sizes").withColumn("slice", _slice(F.col("row_key")))
    sums = materialise(rows.groupBy("source", "slice").agg(F.sum("size").alias("size")), "slices")
    sizes = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", whole)
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    # The slice of the order in which the rest ends, at most one per source.
    along = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("size").over(along), F.lit(0)))
    same = sums["source"].eqNullSafe(plan["source"])
    ends = sums.join(plan.select("source", "rest"), same).where(
        (F.col("ahead") < F.col("rest")) & (F.col("ahead") + F.col("size") >= F.col("rest"))
    )
    ends = ends.select(sums["source"].alias("end_source"), F.col("slice").alias("end"), "ahead")
    plan = plan.join(ends, plan["source"].eqNullSafe(ends["end_source"]), "left").drop("end_source")
    plan = plan.withColumnRenamed("source", "plan_source")

    # Before the end all are taken, behind it none; in it the running size decides. The rows
    # of the last slice are joined and windowed by source and slice, never by source alone.
    of_source = rows["source"].eqNullSafe(plan["plan_source"])
    sure = rows.join(plan, of_source).where(~F.col("slice").eqNullSafe(F.col("end")))
    sure = sure.withColumn("more", F.coalesce((F.col("slice") < F.col("end")).cast("long"), F.lit(0)))
    last = rows.join(plan, of_source & (rows["slice"] == plan["end"]))
    run = Window.partitionBy("source", "slice").orderBy("row_key")
    run = run.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("ahead") + F.coalesce(F.sum("size").over(run), F.lit(0))
    last = last.withColumn("more", (2 * start + F.col("size") <= 2 * F.col("rest")).cast("long"))
    copies = F.col("whole") + F.col("more")
    return sure.unionByName(last).select(
        F.col("id").alias(doc_id),
        F.col("source"),
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).alias("taken"),
        copies.alias("copies"),
        "row_key",
    )


def _slice(key: Column) -> Column:
    """The order in 65,536 slices: the first two bytes of the key."""
    return F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int")
