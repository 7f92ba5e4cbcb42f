"""Connected components of a table of links."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import remove
from tidemark.session import work_path


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): long ids.

    In each round every node moves to its neighbour, or itself, that comes first in a
    random order of that round, and links between the nodes moved to are what is left.
    A constant share of the nodes of each component goes in a round, so the rounds grow
    with the logarithm of the nodes. Minima are merged on each task before the shuffle.
    """
    spark = links.sparkSession
    base = work_path(spark, "components")
    edges = links.where(F.col("a") != F.col("b")).select("a", "b").distinct()
    edges.write.parquet(f"{base}/edges-0")
    edges = spark.read.schema("a long, b long").parquet(f"{base}/edges-0")
    moves = []
    step = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        salt = F.lit(uuid.uuid5(uuid.NAMESPACE_OID, str(step)).hex)
        order = lambda node: F.struct(F.xxhash64(salt, node).alias("p"), node.alias("n"))
        first = F.least(F.min(order(F.col("b"))), order(F.col("a")))
        moved = both.groupBy("a").agg(first["n"].alias("to")).withColumnRenamed("a", "node")
        moved.write.parquet(f"{base}/moves-{step}")
        moved = spark.read.schema("node long, to long").parquet(f"{base}/moves-{step}")
        moves.append(moved)
        left = moved.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = moved.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        rest = edges.join(left, "a").join(right, "b").where(F.col("to_a") != F.col("to_b"))
        rest = rest.select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")
        ).distinct()
        rest.write.parquet(f"{base}/edges-{step + 1}")
        remove(spark, f"{base}/edges-{step}")
        step += 1
        edges = spark.read.schema("a long, b long").parquet(f"{base}/edges-{step}")
    if not moves:
        return spark.createDataFrame([], "node long, root long")
    roots = moves[0].withColumnRenamed("to", "root")
    for moved in moves[1:]:
        then = moved.withColumnRenamed("node", "root")
        roots = roots.join(then, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    roots.write.parquet(f"{base}/roots")
    for i in range(step):
        remove(spark, f"{base}/moves-{i}")
    return spark.read.schema("node long, root long").parquet(f"{base}/roots")
