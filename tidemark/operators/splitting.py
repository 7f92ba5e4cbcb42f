"""Stratified train / validation / test split and folds, repeatable by hash order.

Quotas per class come from class counts; :func:`hash_cuts` turns them into cut points of
the hash order, and the assignment is one expression per row on the cuts of its class:
as long as the cuts of all classes are broadcast, the wide rows are not shuffled, and they
are never sorted. Quotas and cuts are frames, for any number of classes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.operators.ranking import HASH, before_cut, hash_cuts, positions, with_hash

TRAIN, VALIDATION, TEST = "train", "validation", "test"
VAL_SIZE = TEST_SIZE = 0.15
FOLDS = 5
# The cuts of a row's class while rows are assigned.
CUTS = "_cuts"


def proportional(sizes: DataFrame, of: str, everything: int, total: int, share: str) -> DataFrame:
    """Add ``share``: ``total`` shared among the classes by ``of``, which sums to ``everything``.

    The largest fractions get the rest, of equal ones the first class by its text. Products are
    decimals, so that they don't overflow.
    """
    everything = max(everything, 1)
    product = F.col(of).cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)")
    whole = F.lit(everything).cast("decimal(19,0)")
    shared = sizes.withColumns({share: F.call_function("div", product, whole), "_left": product % whole})
    rest = total - (shared.agg(F.sum(share)).first()[0] or 0)
    if rest:
        text = F.coalesce(F.col("stratum").cast("string"), F.lit("None"))
        # A null class and one whose text is that of null are told apart by the last key.
        order = [F.desc("_left"), text, F.col("stratum").isNull()]
        shared = positions(shared, order, "_place")
        shared = shared.withColumn(share, F.col(share) + (F.col("_place") <= rest).cast("long"))
    return shared.drop("_left", "_place")


def split_quotas(sizes: DataFrame, val_size: float = VAL_SIZE, test_size: float = TEST_SIZE) -> DataFrame:
    """Add ``test`` and ``validation`` rows to (stratum, n); held-out parts are rounded up overall."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_dev = total - math.ceil(test_size * total)
    n_train = n_dev - math.ceil(val_size / (1.0 - test_size) * n_dev)
    dev = proportional(sizes, "n", total, n_dev, "dev")
    train = proportional(dev, "dev", n_dev, n_train, "train")
    parts = {"test": F.col("n") - F.col("dev"), "validation": F.col("dev") - F.col("train")}
    return train.select("stratum", "n", *[v.alias(k) for k, v in parts.items()])


def stratified_split(
    df: DataFrame,
    id_col: str,
    label: str,
    *,
    keys: DataFrame | None = None,
    val_size: float = VAL_SIZE,
    test_size: float = TEST_SIZE,
    salt: str = "split:",
) -> DataFrame:
    """Add ``split``: train, validation or test, with the class proportions kept.

    The cuts are worked out on ``keys``, a table of the same ids and labels (default: the
    rows themselves, of which only these two columns are read). A label that ``keys`` lacks
    gives null.
    """

    def upto(sizes: DataFrame) -> DataFrame:
        quotas = split_quotas(sizes, val_size, test_size)
        return quotas.withColumn("wanted", F.array("test", F.col("test") + F.col("validation")))

    cuts = hash_cuts(_or(keys, df), id_col, upto, strata=label, salt=salt)
    part = F.when(before_cut(F.col(CUTS)[0]), TEST).when(before_cut(F.col(CUTS)[1]), VALIDATION).otherwise(TRAIN)
    return _assigned(df, id_col, label, cuts, salt, "split", part)


def stratified_folds(
    df: DataFrame,
    id_col: str,
    label: str,
    *,
    keys: DataFrame | None = None,
    folds: int = FOLDS,
    salt: str = "fold:",
) -> DataFrame:
    """Add ``fold`` 0..folds-1; the folds of a class differ by one row at most."""

    def upto(sizes: DataFrame) -> DataFrame:
        ends = [F.expr(f"{k} * (n div {folds}) + least({k}, n % {folds})") for k in range(1, folds)]
        return sizes.withColumn("wanted", F.array(*ends).cast("array<bigint>"))

    cuts = hash_cuts(_or(keys, df), id_col, upto, strata=label, salt=salt)
    passed = [(~before_cut(F.col(CUTS)[k])).cast("int") for k in range(folds - 1)]
    return _assigned(df, id_col, label, cuts, salt, "fold", sum(passed, F.lit(0)))


def _assigned(
    df: DataFrame, id_col: str, label: str, cuts: DataFrame, salt: str, column: str, value: Column
) -> DataFrame:
    """Add a column worked out from a row's hash and the cuts of its class.

    The cuts are a written table: of few classes it is broadcast, by its size on disk.
    """
    cuts = cuts.withColumnsRenamed({"stratum": "_stratum", "cuts": CUTS})
    same = name(label).eqNullSafe(F.col("_stratum"))
    rows = with_hash(df, id_col, salt).join(cuts, same, "left")
    known = F.when(F.col(CUTS).isNotNull(), value)
    return rows.withColumn(column, known).drop(HASH, "_stratum", CUTS)


def _or(keys: DataFrame | None, df: DataFrame) -> DataFrame:
    return df if keys is None else keys


WEIGHT_MODES = ("full", "sqrt", "none")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Class counts and the positive-class weight of each mode, in one row."""
    y = name(label)
    odds = F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))
    return df.agg(F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives")).select(
        "positives",
        "negatives",
        odds.alias("full"),
        F.sqrt(odds).alias("sqrt"),
        F.lit(1.0).alias("none"),
    )


def positive_weight(df: DataFrame, label: str, mode: str = "sqrt") -> float:
    if mode not in WEIGHT_MODES:
        raise ValueError(f"pos_weight mode must be one of {WEIGHT_MODES}, got {mode!r}")
    return float(class_weights(df, label).first()[mode])


def with_weight(df: DataFrame, label: str, weight: float, column: str = "weight") -> DataFrame:
    """The per-row weight: ``weight`` for positives, 1 otherwise."""
    return df.withColumn(column, F.when(name(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))
