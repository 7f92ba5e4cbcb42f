"""Which vectors take part in a search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Neither null nor empty nor holding a null, NaN or infinite component."""
    regular = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, regular)


def dimensions(df: DataFrame, vector: str) -> list[int]:
    """The dimensions that vectors have, ascending. Each is searched among its own."""
    return sorted(r["d"] for r in df.select(F.size(vector).alias("d")).distinct().collect())
