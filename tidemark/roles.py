"""Column roles: which column of a customer table plays which part.

Every operator takes the names from here, so no column name is fixed in the library.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import binary_label

BASELINE, ENGINEERED = "baseline", "engineered"
FEATURE_SETS = (BASELINE, ENGINEERED)

# Names of the engineered columns.
ENGINEERED_NUMERIC = ("avg_monthly_charge", "addon_count", "month_to_month_electronic")
ENGINEERED_CATEGORICAL = ("tenure_bucket",)


@dataclass(frozen=True)
class ColumnRoles:
    """Names of the id, label, protected and feature columns of one table."""

    id: str
    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    protected: tuple[str, ...] = ()
    addons: tuple[str, ...] = ()
    tenure: str = "tenure"
    monthly: str = "monthly"
    amount: str = "total"
    contract: str = "contract"
    payment: str = "payment"
    positive: str = "Yes"
    negative: str = "No"
    redundant_markers: tuple[str, ...] = ("No internet service", "No phone service")

    def __post_init__(self) -> None:
        features = (*self.numeric, *self.categorical)
        leaked = {self.id, self.label, *self.protected} & set(features)
        if leaked:
            raise ValueError(f"Not allowed as features: {sorted(leaked)}")
        if len(set(features)) != len(features):
            raise ValueError("A column is listed twice among the features")

    def numeric_columns(self, feature_set: str = BASELINE) -> list[str]:
        _check_feature_set(feature_set)
        extra = ENGINEERED_NUMERIC if feature_set == ENGINEERED else ()
        return [*self.numeric, *extra]

    def categorical_columns(self, feature_set: str = BASELINE) -> list[str]:
        _check_feature_set(feature_set)
        extra = ENGINEERED_CATEGORICAL if feature_set == ENGINEERED else ()
        return [*self.categorical, *extra]

    def feature_columns(self, feature_set: str = BASELINE) -> list[str]:
        return self.numeric_columns(feature_set) + self.categorical_columns(feature_set)

    def label_column(self, dtype: str) -> Column:
        """The label as 0/1; a value that is neither class becomes NULL."""
        return binary_label(F.col(self.label), dtype, self.positive, self.negative)


def _check_feature_set(feature_set: str) -> None:
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"feature_set must be one of {FEATURE_SETS}, got {feature_set!r}")


# The telecom customer table of FIXTURES.md part A.
TELCO = ColumnRoles(
    id="customerID",
    label="Churn",
    numeric=("tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen"),
    categorical=(
        "Partner",
        "Dependents",
        "PhoneService",
        "MultipleLines",
        "InternetService",
        "OnlineSecurity",
        "OnlineBackup",
        "DeviceProtection",
        "TechSupport",
        "StreamingTV",
        "StreamingMovies",
        "Contract",
        "PaperlessBilling",
        "PaymentMethod",
    ),
    protected=("gender",),
    addons=(
        "MultipleLines",
        "OnlineSecurity",
        "OnlineBackup",
        "DeviceProtection",
        "TechSupport",
        "StreamingTV",
        "StreamingMovies",
    ),
    tenure="tenure",
    monthly="MonthlyCharges",
    amount="TotalCharges",
    contract="Contract",
    payment="PaymentMethod",
)

# Roles of the `accounts` view of FIXTURES.md part B.
ACCOUNTS = ColumnRoles(
    id="account_id",
    label="label",
    numeric=("tenure", "monthly", "total_text", "in_debt"),
    categorical=("partner", "internet", "security", "backup", "contract", "payment"),
    protected=("segment",),
    addons=("security", "backup"),
    tenure="tenure",
    monthly="monthly",
    amount="total_text",
    contract="contract",
    payment="payment",
)
