"""Engineered features on a cleaned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.roles import ColumnRoles

# Upper ends (inclusive) and names of the tenure buckets.
TENURE_BUCKETS = ((12, "0-12"), (24, "13-24"), (48, "25-48"))
TENURE_LAST = "49+"


def tenure_bucket(column: Column) -> Column:
    """Right-closed bucket of a tenure; outside all bins is the text `nan`."""
    bucket = F.when(column.isNull() | (column <= -1), "nan")
    for upper, label in TENURE_BUCKETS:
        bucket = bucket.when(column <= upper, label)
    return bucket.otherwise(TENURE_LAST)


def engineer_features(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Average charge per month, tenure bucket, add-on count, monthly-by-check flag."""
    tenure = name(roles.tenure)
    # greatest() skips NULL, so a missing tenure is kept missing by hand.
    months = F.when(tenure.isNotNull(), F.greatest(tenure, F.lit(1.0)))
    addons = [F.when(name(c) == "Yes", 1.0).otherwise(0.0) for c in roles.addons]
    both = (name(roles.contract) == "Month-to-month") & (name(roles.payment) == "Electronic check")
    return df.withColumns(
        {
            "avg_monthly_charge": name(roles.amount) / months,
            "tenure_bucket": tenure_bucket(tenure),
            "addon_count": sum(addons, F.lit(0.0)),
            "month_to_month_electronic": F.when(both, 1.0).otherwise(0.0),
        }
    )
