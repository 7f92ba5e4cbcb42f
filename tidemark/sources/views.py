"""The three test views of FIXTURES.md part B over the generated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import load_table

CUTOFF = "TIMESTAMP_NTZ '2000-09-22 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with order history before the cutoff; label = no order after it.

    Orders are read once: history and label come from conditional aggregates of one
    grouping, whose partitioning by customer key the join reuses. Both sides grow with the
    input, so neither may be broadcast: a small file of customers can be many rows in the driver.
    """
    early = f"o_orderdate < {CUTOFF}"
    history = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.expr(f"count_if({early}) AS n_orders"),
            F.expr(f"min(o_orderdate) FILTER (WHERE {early}) AS first_dt"),
            F.expr(f"max(o_orderdate) FILTER (WHERE {early}) AS last_dt"),
            F.expr(f"sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE {early}) AS total_amt"),
            F.expr(f"count_if(NOT {early}) AS n_later"),
        )
        .filter("n_orders > 0")
    )
    customer = table(spark, sf_dir, "customer").hint("merge")
    nation = table(spark, sf_dir, "nation")
    joined = customer.join(history, F.expr("c_custkey = o_custkey")).join(
        nation, F.expr("c_nationkey = n_nationkey")
    )
    months = "(year(last_dt) - year(first_dt)) * 12 + month(last_dt) - month(first_dt)"
    base = joined.selectExpr(
        "*",
        f"CAST(CASE WHEN c_custkey % 101 = 0 THEN 0 ELSE {months} END AS INT) AS tenure",
        "CASE c_custkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'DSL' ELSE 'Fiber optic' END AS internet",
    )
    return base.selectExpr(
        "CAST(c_custkey AS STRING) AS account_id",
        "c_mktsegment AS segment",
        "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS in_debt",
        "n_regionkey % 2 = 0 AS partner",
        "tenure",
        "internet",
        "CASE WHEN internet = 'No' THEN 'No internet service'"
        " WHEN c_custkey % 5 < 2 THEN 'Yes' ELSE 'No' END AS security",
        "CASE WHEN internet = 'No' THEN 'No internet service'"
        " WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS backup",
        "CASE c_custkey % 4 WHEN 0 THEN 'One year' WHEN 1 THEN 'Two year'"
        " ELSE 'Month-to-month' END AS contract",
        "CASE c_custkey % 2 WHEN 0 THEN 'Electronic check' ELSE 'Mailed check' END AS payment",
        "CAST(total_amt AS DOUBLE) / n_orders AS monthly",
        "CASE WHEN tenure = 0 AND c_custkey % 2 = 0 THEN ' ' WHEN c_custkey % 97 = 0 THEN ''"
        " ELSE CAST(total_amt AS STRING) END AS total_text",
        "CASE WHEN n_later = 0 THEN 'Yes' ELSE 'No' END AS label",
    )


def score_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as an append-only table of predictions."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS account_id",
        "round(value / (value + 50), 6) AS probability",
        "CASE WHEN round(value / (value + 50), 6) >= 0.441D THEN 1 ELSE 0 END AS flag",
        "0.441D AS threshold",
        "event_type AS model",
        "'m/v1' AS model_version",
        "concat(event_type, '-', lpad(CAST(event_id AS STRING), 10, '0')) AS run_id",
        "'events' AS source_table",
        "ts AS scored_at",
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``score_log`` with an outcome, for evaluation at larger row counts."""
    return score_log(spark, sf_dir).selectExpr(
        "run_id",
        "account_id",
        "model",
        "CASE WHEN model IN ('error', 'click') THEN 1 ELSE 0 END AS y",
        "probability AS p",
    )


def scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score and the language as group."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").selectExpr(
        "doc_id",
        "lang AS grp",
        "quality AS y",
        "round(CAST((doc_id * 7919) % 1000 + 500 * quality AS DOUBLE) / 1500, 3) AS p",
    )
