"""Tables: CSV load, scans, the scoring population and key lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import name
from tidemark.operators.sampling import sample_fixed

# A text no field holds: an empty field of a text column is empty text, not NULL.
NO_VALUE = "\u0000"


def load_csv(
    spark: SparkSession, source: str, target: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Replace the table at ``target`` by a CSV file with header.

    Give the schema in production; without one it is inferred, at the price of a second
    scan. Blank and empty text stays text, so a numeric column with blanks is a string.
    """
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    reader = reader.option("nullValue", NO_VALUE).option("emptyValue", "")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    rows = reader.csv(source)
    text = [c for c, t in rows.dtypes if t == "string"]
    rows.fillna("", text).write.mode("overwrite").parquet(target)
    return load_table(spark, target)


def load_table(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Scan a table, all of it or ``limit`` rows in no particular order."""
    df = spark.read.parquet(path)
    return df if limit is None else df.limit(limit)


def load_scoring(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Scan the scoring population; an empty one is an error."""
    df = load_table(spark, path, limit)
    if df.isEmpty():
        raise ValueError(f"{path} is empty: seed the scoring population first")
    return df


def seed_scoring(
    customers: DataFrame,
    id_col: str,
    label: str,
    n: int = 500,
    *,
    keep_label: bool = False,
    salt: str = "seed:",
) -> DataFrame:
    """``n`` pseudo-random customers without their label, stamped with today's date."""
    sample = sample_fixed(customers, id_col, n, salt=salt)
    if not keep_label:
        sample = sample.drop(label)
    return sample.withColumn("as_of_date", F.current_date())


def peek(df: DataFrame, order_by: str | None = None, n: int = 20) -> DataFrame:
    """The first ``n`` rows, by a column if one is given."""
    return (df.orderBy(name(order_by)) if order_by else df).limit(n)


def lookup_keys(scores: DataFrame, keys: DataFrame, id_col: str) -> DataFrame:
    """Every wanted key with its score row, and ``found`` = whether there is one."""
    marked = scores.withColumn("found", F.lit(True))
    joined = keys.select(id_col).join(marked, id_col, "left")
    return joined.withColumn("found", F.coalesce("found", F.lit(False)))


def lookup_one(scores: DataFrame, id_col: str, key: str) -> DataFrame:
    """The rows of one key, by a filter the scan can prune with; a missing key is an error."""
    rows = scores.filter(name(id_col) == F.lit(key))
    if rows.isEmpty():
        raise KeyError(f"No row for {id_col}={key!r}")
    return rows


def select_keys(df: DataFrame, id_col: str, keys: Iterable[str]) -> DataFrame:
    """The rows of a short list of keys."""
    return df.filter(name(id_col).isin(list(keys)))
