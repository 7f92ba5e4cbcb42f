"""Scalar expressions whose semantics differ from a plain Spark cast or operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text accepted as a number, and the text level of a missing category.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
MISSING_LEVEL = "<NA>"

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def name(column: str) -> Column:
    """Reference a top-level column whose name may hold dots, blanks or brackets."""
    return F.col(quoted(column))


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC_TYPES or dtype.startswith("decimal(")


def to_number(column: Column, dtype: str) -> Column:
    """Read a column as double; text that is no number, and NaN, become NULL.

    A plain ``try_cast`` would accept ``'1d'`` and keep ``'nan'``, so text is matched first.
    """
    if dtype == "string":
        return F.when(column.rlike(NUMBER_PATTERN), column.try_cast("double"))
    number = column.cast("double")
    return F.when(~F.isnan(number), number) if dtype in ("float", "double") else number


def known(column: Column, dtype: str) -> Column:
    """The column with NaN turned to NULL."""
    return F.when(~F.isnan(column), column) if dtype in ("float", "double") else column


def is_blank(column: Column) -> Column:
    """True for text of blanks only; NULL is not blank."""
    return F.coalesce(F.trim(column) == F.lit(""), F.lit(False))


def as_level(column: Column, dtype: str) -> Column:
    """A categorical value as text: booleans as True/False, NULL as its own level."""
    text = F.initcap(column.cast("string")) if dtype == "boolean" else column.cast("string")
    return F.coalesce(text, F.lit(MISSING_LEVEL))


def binary_label(column: Column, dtype: str, positive: str = "Yes", negative: str = "No") -> Column:
    """0/1 from a boolean, a 0/1 number or two configured texts; anything else is NULL."""
    if dtype == "boolean":
        return column.cast("int")
    if is_numeric(dtype):
        return F.when(column == 1, F.lit(1)).when(column == 0, F.lit(0))
    return F.when(column == positive, F.lit(1)).when(column == negative, F.lit(0))


def hash_key(column: Column, salt: str) -> Column:
    """A repeatable pseudo-random order key: md5 of salt and id. A NULL id fails the job."""
    missing = F.raise_error(F.lit("An id is NULL: rows are split and sampled by their ids"))
    return F.coalesce(F.md5(F.concat(F.lit(salt), column.cast("string"))), missing)


def ratio(numerator: Column, denominator: Column, empty: float | None = None) -> Column:
    """Quotient of two counts; ``empty`` (default NULL) where the denominator is 0."""
    return F.when(
        denominator != 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(F.lit(empty).cast("double"))


def percent(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    return F.round(100.0 * numerator.cast("double") / denominator.cast("double"), digits)


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    """F-beta of two ratios, 0 where both are 0."""
    weight = F.lit(float(beta) ** 2)
    bottom = weight * precision + recall
    return F.when(bottom > 0, (1 + weight) * precision * recall / bottom).otherwise(F.lit(0.0))


def pearson(a: str, b: str) -> Column:
    """Pearson correlation of two columns, by name, over the rows where both are known.

    NULL if either is constant there; the built-in ``corr`` would divide by zero.
    """
    x, y = quoted(a), quoted(b)
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    varies = " AND ".join(f"min({c}) {both} < max({c}) {both}" for c in (x, y))
    spread = f"stddev_pop({x}) {both} * stddev_pop({y}) {both}"
    return F.expr(f"CASE WHEN {varies} THEN covar_pop({x}, {y}) / ({spread}) END")


def required(column: str) -> Column:
    """The column itself; the job fails on the first NULL."""
    message = F.lit(f"Column {column} must not be NULL")
    return F.coalesce(name(column), F.raise_error(message)).alias(column)
