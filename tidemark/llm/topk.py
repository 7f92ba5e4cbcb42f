"""Exact top-k by integer inner product, one block of documents at a time.

Components are terms, and a component's weight is floor(256 * x). Vectors in the order of
their ids are cut into blocks with a forward index (all weights of the block) and the
largest and smallest weight of each term. A query's sum of the larger products bounds its
score in a block. It visits blocks by descending bound and stops when the bound is below
the k-th score so far. Each query begins with the k-th score in a bounded sample of the
rows, which is no larger than its true k-th score, so pruning holds from the first block.

Vectors that are null or empty or hold a null or non-finite component take no part, nor do
rows with a null id; zero vectors do. Vectors of another dimension than the query's are no
candidates: each dimension is searched among its own. A query's candidates are all rows of
other ids. Of rows that repeat an id the smallest vector is the query, and all are
candidates of others. Ties go to the smaller id. Weights and scores beyond a long are set to
its largest or smallest value. Only id and vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Work
from tidemark.llm.vectors import finite, dimensions
from tidemark.session import materialise

SAMPLE = 2_048
ROWS_PER_BLOCK = 512
ROWS_PER_RANGE = 32_768
QUERIES_PER_CELL = 8_192

LOWEST = -(2**63)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, weights) of the rows that take part."""
    # The largest double below 2**63; weights beyond a long are set to it or its negative.
    edge = F.lit(math.nextafter(2.0**63, 0))
    scaled = F.transform(vector, lambda x: F.floor(F.greatest(-edge, F.least(edge, x.cast("double") * 256))))
    rows = df.where(F.col(vec_id).isNotNull() & finite(vector))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("weights"))


def _matrix(column: pd.Series | pa.Array) -> np.ndarray:
    return np.array(list(column), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of longs, set into the range of longs.

    In doubles while every partial sum is below 2**53, in Python's integers beyond.
    """
    largest = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (a, b)]
    if largest[0] * largest[1] * max(1, a.shape[1]) < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, LOWEST, -LOWEST - 1).astype(np.int64)


def block_index(rows: DataFrame, ranges: int) -> DataFrame:
    """(range, ids, weights, low, high): blocks of at most ROWS_PER_BLOCK rows in id order."""
    dealt = rows.repartitionByRange(ranges, "vec_id", F.xxhash64("weights")).sortWithinPartitions("vec_id")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BLOCK):
                part = batch.slice(start, ROWS_PER_BLOCK)
                w = _matrix(part.column(1).to_pylist())
                ids = np.array(part.column(0).to_pylist(), np.int64)
                cells = [x.tobytes() for x in (ids, w, w.min(0), w.max(0))]
                arrays = [pa.array([own], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)]
                yield pa.RecordBatch.from_arrays(arrays, names=["range", "ids", "weights", "low", "high"])

    return dealt.mapInArrow(build, "range int, ids binary, weights binary, low binary, high binary")


def _bounds(query: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest score that a row of each block can have, a little more in doubles."""
    q = query.astype(float)
    bound = np.maximum(q, 0) @ high.T.astype(float) + np.minimum(q, 0) @ low.T.astype(float)
    return np.maximum(bound + np.abs(bound) * 1e-9 + 1, LOWEST)


def best_of(
    query_id: int, query: np.ndarray, least: int, blocks: list[tuple], bounds: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows in blocks (ids, weights), those below ``least`` left out."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in np.argsort(-bounds, kind="stable"):
        if bounds[b] < least:
            break
        own_ids, weights = blocks[b]
        score = products(query[None], weights)[0]
        keep = own_ids != query_id
        ids, scores = np.r_[ids, own_ids[keep]], np.r_[scores, score[keep]]
        # Descending scores; -1 - s turns the order of longs around without overflow.
        order = np.lexsort((ids, -1 - scores))[:k]
        ids, scores = ids[order], scores[order]
        if len(scores) == k:
            least = max(least, int(scores[-1]))
    return ids, scores


def _top_of(work: Work, rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of vectors of one dimension."""
    spark = rows.sparkSession
    ranges = -(-rows.count() // ROWS_PER_RANGE)
    ranges = max(ranges, spark.sparkContext.defaultParallelism)
    blocks = work.table(block_index(rows, ranges), "blocks")
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "weights").limit(SAMPLE).collect()
    seed_ids, seed = np.array([r["vec_id"] for r in few]), _matrix([r["weights"] for r in few])

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                own, ids = _matrix(part.column(1).to_pylist()), part.column(0).to_pylist()
                least = []
                for i, scores in zip(ids, products(own, seed), strict=True):
                    others = np.sort(scores[seed_ids != i])
                    least.append(int(others[-k]) if len(others) >= k else LOWEST)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([q.tobytes() for q in own], pa.binary()), pa.array(least, pa.int64())],
                    names=["query_id", "query", "least"],
                )

    begun = work.table(queries.mapInArrow(begin, "query_id long, query binary, least long"), "queries")
    # Every query meets every range of rows, in cells of bounded size.
    own_ranges = [r["range"] for r in blocks.select("range").distinct().collect()]
    cells = -(-begun.count() // QUERIES_PER_CELL) or 1
    asked = begun.withColumns({
        "cell": F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(cells)).cast("int"),
        "range": F.explode(F.array(*map(F.lit, own_ranges))),
    })
    held = blocks.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))

    def search(block: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(block) and len(query):
            longs = lambda column: [np.frombuffer(x, np.int64) for x in column]
            low, high = np.array(longs(block["low"])), np.array(longs(block["high"]))
            dims = low.shape[1]
            kept = [(i, w.reshape(-1, dims)) for i, w in zip(longs(block["ids"]), longs(block["weights"]), strict=True)]
            for query_id, q, at_least in zip(query["query_id"], longs(query["query"]), query["least"], strict=True):
                bounds = _bounds(q, low, high)
                ids, scores = best_of(query_id, q, at_least, kept, bounds, k)
                found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ("range", "cell")
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_products(
    df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest scores."""
    spark = df.sparkSession
    with Work(spark) as work:
        rows = work.table(usable(df, vec_id, vector), "weights")
        queries = rows.where(is_query).groupBy("vec_id").agg(F.min("weights").alias("weights"))
        found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        for d in dimensions(rows, "weights"):
            own = F.size("weights") == d
            found = found.unionByName(_top_of(work, rows.where(own), queries.where(own), k))
        return materialise(found, "top")
