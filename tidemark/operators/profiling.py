"""Profiling of a labelled customer table: balance, rates, blanks, summaries.

Each report is one scan with partial aggregation; what is shuffled is its few groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import as_level, is_blank, known, name, pearson, percent, to_number
from tidemark.operators.quantiles import describe, exact_quantiles
from tidemark.roles import ColumnRoles
from tidemark.session import local_frame

# Tenure classes of the exploration report (left-closed) and of the bins chart.
REPORT_BUCKETS = ((12, "0-11 months"), (24, "12-23 months"), (48, "24-47 months"))
REPORT_LAST = "48+ months"
RATE_BINS = (0, 12, 24, 36, 48, 60, 72)


def _label(df: DataFrame, roles: ColumnRoles) -> Column:
    return roles.label_column(dict(df.dtypes)[roles.label])


def label_balance(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Rows per label and their percentage."""
    # The window runs over the grouped rows: one per label.
    total = F.sum("customers").over(Window.partitionBy())
    return (
        df.groupBy(name(roles.label).alias("label"))
        .agg(F.count("*").alias("customers"))
        .withColumn("pct", percent(F.col("customers"), total))
        .orderBy("label")
    )


def dup_check(df: DataFrame, id_col: str) -> DataFrame:
    """Rows and exact distinct keys."""
    return df.agg(
        F.count("*").alias("total_rows"), F.count_distinct(name(id_col)).alias("distinct_keys")
    )


def rate_by_category(df: DataFrame, roles: ColumnRoles, columns: Sequence[str]) -> DataFrame:
    """Count and positive rate per level of each column, highest rate first."""
    types = dict(df.dtypes)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.when(name(c).isNotNull(), as_level(name(c), types[c])).alias("level"),
            )
            for c in columns
        ]
    )
    long = df.select(_label(df, roles).alias("y"), F.explode(pairs).alias("pair"))
    return (
        long.groupBy("pair.column", "pair.level")
        .agg(F.count("*").alias("customers"), F.count_if(F.col("y") == 1).alias("positives"))
        .withColumn("rate_pct", percent(F.col("positives"), F.col("customers")))
        .drop("positives")
        .orderBy("column", F.desc("rate_pct"), "level")
    )


def rate_by_bucket(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Count and positive rate by left-closed tenure class."""
    tenure = name(roles.tenure)
    bucket = F.when(tenure < REPORT_BUCKETS[0][0], REPORT_BUCKETS[0][1])
    for upper, label in REPORT_BUCKETS[1:]:
        bucket = bucket.when(tenure < upper, label)
    y = _label(df, roles)
    return (
        df.groupBy(bucket.otherwise(REPORT_LAST).alias("tenure_bucket"))
        .agg(
            F.count("*").alias("customers"),
            percent(F.count_if(y == 1), F.count("*")).alias("rate_pct"),
        )
        .orderBy("tenure_bucket")
    )


def rate_by_bins(
    df: DataFrame, roles: ColumnRoles, column: str, edges: Sequence[float] = RATE_BINS
) -> DataFrame:
    """Mean label per right-closed bin; values outside all bins are left out, empty bins kept."""
    value = name(column)
    pairs = list(zip(edges, edges[1:], strict=False))
    number = F.lit(None).cast("int")
    for i, (low, high) in enumerate(pairs):
        number = F.when((value > low) & (value <= high), i).otherwise(number)
    rates = (
        df.select(number.alias("bin"), _label(df, roles).alias("y"))
        .filter("bin IS NOT NULL")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("y").alias("rate"))
    )
    bins = local_frame(
        df.sparkSession,
        [(i, f"({low}, {high}]") for i, (low, high) in enumerate(pairs)],
        "bin int, label string",
    )
    return (
        bins.join(rates, "bin", "left")
        .select("bin", "label", F.coalesce("n", F.lit(0)).alias("n"), "rate")
        .orderBy("bin")
    )


def blank_count(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is blank (NULL is not), and all rows."""
    return df.agg(
        F.count_if(is_blank(name(column))).alias("blank_rows"), F.count("*").alias("total_rows")
    )


def numeric_summary(df: DataFrame, roles: ColumnRoles, column: str) -> DataFrame:
    """Mean, minimum and maximum by label, rounded to 2 digits."""
    c = name(column)
    return df.groupBy(name(roles.label).alias("label")).agg(
        F.round(F.avg(c), 2).alias("avg_value"),
        F.round(F.min(c), 2).alias("min_value"),
        F.round(F.max(c), 2).alias("max_value"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max of each numeric column."""
    return describe(df, columns)


def quartiles_by_label(df: DataFrame, roles: ColumnRoles, columns: Sequence[str]) -> DataFrame:
    """Exact 25, 50 and 75 percent quantiles of each column per label."""
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75), by=roles.label)
    return quartiles.withColumnRenamed("grp", "label")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column (NULL or NaN)."""
    types = dict(df.dtypes)
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(known(name(c), types[c]).isNull()).alias(c) for c in columns])
    return counts.unpivot([], [name(c) for c in columns], "column", "nulls")


def levels(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(name(column).alias("level")).distinct()


def rule_check(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Does "tenure 0" hold exactly where the amount is missing? Four counts, three verdicts."""
    zero = F.coalesce(name(roles.tenure) == 0, F.lit(False))
    missing = to_number(name(roles.amount), dict(df.dtypes)[roles.amount]).isNull()
    counts = df.agg(
        F.count_if(zero).alias("zero_tenure"),
        F.count_if(zero & missing).alias("zero_and_missing"),
        F.count_if(missing).alias("missing_amount"),
    )
    return counts.select(
        "zero_tenure",
        F.col("zero_and_missing").alias("zero_tenure_missing"),
        "missing_amount",
        F.col("zero_and_missing").alias("missing_zero_tenure"),
        (F.col("zero_and_missing") == F.col("zero_tenure")).alias("every_zero_is_missing"),
        (F.col("zero_and_missing") == F.col("missing_amount")).alias("every_missing_is_zero"),
        (
            (F.col("zero_and_missing") == F.col("zero_tenure"))
            & (F.col("zero_and_missing") == F.col("missing_amount"))
        ).alias("one_to_one"),
    )


def class_histogram(df: DataFrame, roles: ColumnRoles, column: str, bins: int = 30) -> DataFrame:
    """Equal-width counts per class; the positive class alone sets the edges.

    Values of the negative class outside the edges are left out; the last bin includes
    its upper edge. Empty bins are kept.
    """
    value = to_number(name(column), dict(df.dtypes)[column])
    long = df.select(_label(df, roles).alias("y"), value.alias("v")).filter(
        "y IS NOT NULL AND v IS NOT NULL"
    )
    span = long.filter("y = 1").agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    low, high = (0.0, 1.0) if span["low"] is None else (span["low"], span["high"])
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    edges = [low + i * step for i in range(bins)] + [high]
    guess = F.least(F.floor((F.col("v") - low) * (bins / (high - low))), F.lit(bins - 1))
    # The division may land one bin off at an edge; compare with the edges themselves.
    lower = F.lit(low) + guess * F.lit(step)
    upper = F.lit(low) + (guess + 1) * F.lit(step)
    number = (
        F.when((guess > 0) & (F.col("v") < lower), guess - 1)
        .when((guess < bins - 1) & (F.col("v") >= upper), guess + 1)
        .otherwise(guess)
    )
    counts = (
        long.filter(F.col("v").between(low, high))
        .groupBy(number.cast("int").alias("bin"), "y")
        .agg(F.count("*").alias("n"))
    )
    frame = local_frame(
        df.sparkSession,
        [(i, y, edges[i], edges[i + 1]) for i in range(bins) for y in (0, 1)],
        "bin int, y int, low double, high double",
    )
    return frame.join(counts, ["bin", "y"], "left").select(
        "bin", "y", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


def with_charge_drift(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Average charge so far and its gap to the current charge, where both are defined."""
    amount = to_number(name(roles.amount), dict(df.dtypes)[roles.amount])
    average = F.when(name(roles.tenure) > 0, amount / name(roles.tenure))
    return (
        df.withColumn("avg_charge", average)
        .withColumn("charge_diff", name(roles.monthly) - F.col("avg_charge"))
        .filter("avg_charge IS NOT NULL")
    )


def charge_drift(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Describe the current charge, the average charge and their gap."""
    return describe(with_charge_drift(df, roles), [roles.monthly, "avg_charge", "charge_diff"])


def charge_drift_fit(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Mean absolute gap and correlation of the current with the average charge."""
    return with_charge_drift(df, roles).agg(
        F.round(F.avg(F.abs("charge_diff")), 2).alias("mean_abs_diff"),
        F.round(pearson(roles.monthly, "avg_charge"), 3).alias("corr"),
    )


def charge_drift_rate(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Positive rate by whether the current charge is above the average so far."""
    y = _label(df, roles)
    return (
        with_charge_drift(df, roles)
        .groupBy((F.col("charge_diff") > 0).alias("charge_increased"))
        .agg(F.round(F.avg(y) * 100, 1).alias("rate_pct"))
    )
