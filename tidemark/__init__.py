"""Tidemark: DataFrame operators for tabular propensity pipelines on Spark."""

from tidemark.roles import ColumnRoles

__all__ = ["ColumnRoles"]
