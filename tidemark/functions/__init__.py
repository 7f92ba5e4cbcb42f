"""Column expressions shared by the operators. All of them stay inside the JVM."""

from tidemark.functions.columns import (
    as_level,
    binary_label,
    f_beta,
    hash_key,
    is_blank,
    known,
    name,
    pearson,
    percent,
    ratio,
    required,
    to_number,
)

__all__ = [
    "as_level",
    "binary_label",
    "f_beta",
    "hash_key",
    "is_blank",
    "known",
    "name",
    "pearson",
    "percent",
    "ratio",
    "required",
    "to_number",
]
