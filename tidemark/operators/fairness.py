"""Rates by protected group, joined to the scores by id after scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import name, ratio

SUMS = ("n", "positives", "flagged", "hits")


def _outcomes(threshold: float, y: str, p: str) -> dict[str, Column]:
    positive, flagged = name(y) == 1, name(p) >= threshold
    return {
        "n": F.count("*"),
        "positives": F.count_if(positive),
        "flagged": F.count_if(flagged),
        "hits": F.count_if(positive & flagged),
    }


def _rates(counts: DataFrame) -> DataFrame:
    n, positives, flagged, hits = (F.col(c) for c in SUMS)
    return counts.select(
        "attribute",
        "grp",
        "n",
        ratio(positives, n).alias("actual_rate"),
        ratio(flagged, n).alias("flagged_rate"),
        ratio(hits, positives, 0.0).alias("recall"),
        ratio(hits, flagged, 0.0).alias("precision"),
    ).orderBy("attribute", "grp")


def fairness_by_group(
    scored: DataFrame, groups: Sequence[str], threshold: float, y: str = "y", p: str = "p"
) -> DataFrame:
    """Count, actual and flagged rate, recall and precision per level of each group column."""
    pairs = F.array(
        *[
            F.struct(F.lit(g).alias("attribute"), name(g).cast("string").alias("grp"))
            for g in groups
        ]
    )
    long = scored.select(name(y).alias("y"), name(p).alias("p"), F.explode(pairs).alias("pair"))
    sums = _outcomes(threshold, "y", "p")
    return _rates(
        long.groupBy("pair.attribute", "pair.grp").agg(*[c.alias(k) for k, c in sums.items()])
    )


def fairness_join(
    scored: DataFrame,
    demographics: DataFrame,
    id_col: str,
    groups: Sequence[str],
    threshold: float,
    y: str = "y",
    p: str = "p",
) -> DataFrame:
    """:func:`fairness_by_group` with the groups looked up by id.

    Both sides are first reduced to one row per id on the join's own partitioning, so an
    id with very many scores is a single row of the join. A score without demographics, or
    demographics with two rows for an id, fail the job.
    """
    sums = _outcomes(threshold, y, p)
    per_id = scored.groupBy(name(id_col).alias("id")).agg(*[c.alias(k) for k, c in sums.items()])
    people = demographics.groupBy(name(id_col).alias("id")).agg(
        F.count("*").alias("copies"),
        *[F.first(name(g).cast("string")).alias(f"group_{i}") for i, g in enumerate(groups)],
    )
    joined = per_id.join(people, "id", "left")
    known = F.when(
        F.col("copies").isNull(),
        F.raise_error(F.concat(F.lit("No demographics for id "), F.col("id").cast("string"))),
    ).when(
        F.col("copies") > 1,
        F.raise_error(F.concat(F.lit("Two demographics rows for id "), F.col("id").cast("string"))),
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(g).alias("attribute"),
                F.coalesce(
                    known.cast("string"),
                    F.col(f"group_{i}"),
                    F.raise_error(F.lit(f"Group {g} is missing for a scored id")),
                ).alias("grp"),
            )
            for i, g in enumerate(groups)
        ]
    )
    return _rates(
        joined.select(*SUMS, F.explode(pairs).alias("pair"))
        .groupBy("pair.attribute", "pair.grp")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
    )


def unmatched(scored: DataFrame, demographics: DataFrame, id_col: str) -> DataFrame:
    """Scored rows whose id has no demographics, and ids with more than one row there."""
    per_id = scored.groupBy(name(id_col).alias("id")).agg(F.count("*").alias("n"))
    people = demographics.groupBy(name(id_col).alias("id")).agg(F.count("*").alias("copies"))
    return per_id.join(people, "id", "left").agg(
        F.coalesce(F.sum(F.when(F.col("copies").isNull(), F.col("n"))), F.lit(0)).alias(
            "unmatched_rows"
        ),
        F.count_if(F.col("copies") > 1).alias("ambiguous_ids"),
    )
