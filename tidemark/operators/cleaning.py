"""Cleaning of a raw customer table, with the dropped rows kept in quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_level, name, to_number
from tidemark.roles import BASELINE, ColumnRoles
from tidemark.operators.features import engineer_features


def _amount(df: DataFrame, roles: ColumnRoles) -> Column:
    """The amount as double; missing means 0 for a new customer (tenure 0)."""
    amount = to_number(name(roles.amount), dict(df.dtypes)[roles.amount])
    return F.when(name(roles.tenure) == 0, F.coalesce(amount, F.lit(0.0))).otherwise(amount)


def clean(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Apply the cleaning rules; one pass, no shuffle.

    Text amounts become numbers; a missing amount is 0 at tenure 0, otherwise the row is
    dropped (see :func:`quarantine`). Numerics become double, categories text.
    """
    types = dict(df.dtypes)
    numbers = {
        c: to_number(name(c), types[c]) for c in roles.numeric if c != roles.amount
    }
    levels = {c: as_level(name(c), types[c]) for c in roles.categorical}
    kept = df.withColumn(roles.amount, _amount(df, roles)).filter(name(roles.amount).isNotNull())
    return kept.withColumns({**numbers, **levels})


def quarantine(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """The raw rows :func:`clean` drops, with the reason."""
    text = F.trim(name(roles.amount).cast("string"))
    blank = F.coalesce(text, F.lit("")) == ""
    reason = F.when(blank, "missing amount").otherwise("unreadable amount")
    return df.filter(_amount(df, roles).isNull()).withColumn("reason", reason)


def quarantine_summary(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Number of dropped rows by reason."""
    return quarantine(df, roles).groupBy("reason").agg(F.count("*").alias("n"))


def select_features(df: DataFrame, roles: ColumnRoles, feature_set: str = BASELINE) -> DataFrame:
    return df.select(*[name(c) for c in roles.feature_columns(feature_set)])


def split_roles(
    cleaned: DataFrame, roles: ColumnRoles, feature_set: str = BASELINE, keep: Sequence[str] = ()
) -> DataFrame:
    """Id, 0/1 label and features of a cleaned table, in one frame; ``keep`` adds others."""
    frame = engineer_features(cleaned, roles) if feature_set != BASELINE else cleaned
    label = roles.label_column(dict(cleaned.dtypes)[roles.label]).alias("y")
    features = [name(c) for c in roles.feature_columns(feature_set)]
    return frame.select(name(roles.id), label, *features, *[name(c) for c in keep])


def make_dataset(df: DataFrame, roles: ColumnRoles, feature_set: str = BASELINE) -> DataFrame:
    """Clean a raw table and select id, label and features."""
    return split_roles(clean(df, roles), roles, feature_set)


def unknown_labels(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """How many rows have a label of neither class."""
    label = roles.label_column(dict(df.dtypes)[roles.label])
    return df.agg(F.count_if(label.isNull()).alias("unknown"), F.count("*").alias("total"))


def scoring_features(df: DataFrame, roles: ColumnRoles, keep: Sequence[str] = ()) -> DataFrame:
    """Id and baseline features of a table that needs no label; ``keep`` passes others on."""
    features = [name(c) for c in roles.feature_columns()]
    return clean(df, roles).select(name(roles.id), *features, *[name(c) for c in keep])


def demographics(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Id and protected columns, for audits after scoring."""
    return df.select(name(roles.id), *[name(c) for c in roles.protected])


def validate_schema(df: DataFrame, columns: Sequence[str], *, exact: bool = True) -> DataFrame:
    """Return ``df`` if it has the feature columns; ``exact`` also refuses others."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing feature columns: {missing}")
    extra = sorted(set(df.columns) - set(columns))
    if exact and extra:
        raise ValueError(f"Unexpected columns: {extra}")
    return df
