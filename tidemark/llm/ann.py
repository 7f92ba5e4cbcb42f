"""Nearest neighbours by inverted lists and an adaptive scan of dimensions.

Index. Centroids are fitted on a bounded sample, and every vector goes to the list of its
nearest centroid. Some vectors are left out of that fit: the share of all vectors to probe
is measured on their true neighbours in the whole table. Vectors are also kept rotated by a random orthogonal matrix, so that any
block of dimensions holds a like share of a distance.

Search. A query probes its nearest lists until they hold the share of all vectors that
reached the target recall on those left out. Inside a part of a list, candidates are
scanned one block of columns at a time: the partial distance, scaled to all dimensions,
is tested against the distance of the k-th best so far, and candidates that are farther at
the test's confidence are abandoned. The distances of those that stay are computed on the
original vectors in double precision. Lists are cut into parts and queries into blocks, so
no task holds a whole hot list or all queries.

Vectors that are null, empty or zero or hold a null or non-finite component take no part, nor
do rows with a null id. Vectors of another dimension than the query's are no candidates:
each dimension is searched among its own. A query's candidates are all rows of other ids.
Of rows that repeat an id the smallest vector is the query, and all are candidates of others. Ties go to the smaller id. A query with fewer results than k
searches all lists. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Work
from tidemark.llm.vectors import finite, dimensions
from tidemark.session import materialise

SAMPLE = 20_000
# Vectors whose neighbours the share to probe is measured on.
MEASURED = 256
MOST_LISTS = 4_096
TARGET_RECALL = 0.96
ROWS_PER_PART = 8_192
QUERIES_PER_BLOCK = 1_024
# Columns per block and the number of standard errors of the abandoning test.
BLOCK = 16
SLACK = 2.4
CHUNK = 1_024

RESULT = "query_id long, vec_id long, score double"


@dataclass
class Lists:
    """Centroids of the lists, the rotation, and the share of vectors to probe."""

    centroids: np.ndarray
    rotation: np.ndarray
    share: float


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    rows = df.where(F.col(vec_id).isNotNull() & finite(vector) & F.exists(vector, lambda x: x != 0))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)


def fit(rows: DataFrame, total: int, k: int, target: float = TARGET_RECALL, seed: int = 7) -> Lists:
    """Fit on at most SAMPLE vectors, chosen by a hash of the id."""
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).collect()
    sample = np.array([r["vector"] for r in few], float)
    whole = total <= len(sample)
    if not whole:
        aside = min(MEASURED, len(sample) // 4)
        ids, queries, sample = np.array([r["vec_id"] for r in few[:aside]]), sample[:aside], sample[aside:]
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))
    lists = min(MOST_LISTS, max(1, round(total**0.5)), max(1, len(sample) // 8))
    # Distinct starts; copies of a vector would leave lists empty.
    starts = np.unique(sample, axis=0)
    centroids = starts[rng.permutation(len(starts))[:lists]].copy()
    for _ in range(8):
        nearest = _squared(sample, centroids).argmin(1)
        for j in np.unique(nearest):
            centroids[j] = sample[nearest == j].mean(0)
    if whole or not len(queries):
        return Lists(centroids, rotation, _needed_share(sample, centroids, k, target))
    return Lists(centroids, rotation, _share_by_all(rows, ids, queries, centroids, k, target))


def _needed_share(sample: np.ndarray, centroids: np.ndarray, k: int, target: float) -> float:
    """The share of vectors in the lists nearest to a query that holds ``target`` of its neighbours."""
    queries = sample[: min(len(sample), 256)]
    own = _squared(sample, centroids).argmin(1)
    sizes = np.bincount(own, minlength=len(centroids))
    distance = _squared(queries, sample)
    distance[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    neighbours = distance.argsort(1)[:, : min(k, len(sample) - 1)]
    if not neighbours.size:
        return 1.0
    order = _squared(queries, centroids).argsort(1)
    reached = np.empty(order.shape)
    np.put_along_axis(reached, order, sizes[order].cumsum(1) / len(sample), 1)
    # A neighbour is found once the lists up to its own are probed.
    return float(np.quantile(np.take_along_axis(reached, own[neighbours], 1), target))


def _share_by_all(
    rows: DataFrame, ids: np.ndarray, queries: np.ndarray, centroids: np.ndarray, k: int, target: float
) -> float:
    """The share as in _needed_share, by the neighbours of the queries among all rows."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(len(centroids), np.int64)
        best, held = np.full((len(queries), k), np.inf), np.zeros((len(queries), k), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                x = np.array(part.column(1).to_pylist(), float)
                own = _squared(x, centroids).argmin(1)
                sizes += np.bincount(own, minlength=len(centroids))
                distance = _squared(queries, x)
                distance[ids[:, None] == np.array(part.column(0))] = np.inf
                distance = np.concatenate([best, distance], 1)
                lists = np.concatenate([held, np.broadcast_to(own, (len(queries), len(own)))], 1)
                take = distance.argpartition(k - 1, 1)[:, :k]
                best, held = np.take_along_axis(distance, take, 1), np.take_along_axis(lists, take, 1)
        query, place = np.nonzero(np.isfinite(best))
        filled = np.flatnonzero(sizes)
        columns = [
            np.concatenate([query, np.full(len(filled), -1)]),
            np.concatenate([held[query, place], filled]),
            np.concatenate([best[query, place], sizes[filled]]).astype(float),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "list", "value"])

    found = rows.mapInArrow(nearest, "query long, list long, value double")
    # Rows of query -1 are sizes of lists, of any other its nearest rows on each task.
    order = Window.partitionBy("query", F.when(F.col("query") < 0, F.col("list"))).orderBy("value", "list")
    found = found.withColumn("place", F.row_number().over(order)).where((F.col("query") < 0) | (F.col("place") <= k))
    found = found.groupBy("query", "list").agg(F.sum("value").alias("size"), F.count("*").alias("n")).collect()
    sizes = np.zeros(len(centroids))
    for r in found:
        if r["query"] < 0:
            sizes[r["list"]] = r["size"]
    order = _squared(queries, centroids).argsort(1)
    reached = np.empty(order.shape)
    np.put_along_axis(reached, order, sizes[order].cumsum(1) / sizes.sum(), 1)
    shares = [reached[r["query"], r["list"]] for r in found if r["query"] >= 0 for _ in range(r["n"])]
    return float(np.quantile(shares, target)) if shares else 1.0


def _hash(column: str) -> Column:
    return F.xxhash64(column, F.lit(1))


def index(rows: DataFrame, lists: Lists) -> DataFrame:
    """(list, vec_id, vector, rotated): every vector in its list, as bytes of doubles."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                x = np.array(part.column(1).to_pylist(), float)
                nearest = _squared(x, lists.centroids).argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nearest, pa.int32()),
                        part.column(0),
                        pa.array([v.tobytes() for v in x], pa.binary()),
                        pa.array([v.tobytes() for v in x @ lists.rotation], pa.binary()),
                    ],
                    names=["list", "vec_id", "vector", "rotated"],
                )

    return rows.mapInArrow(assign, "list int, vec_id long, vector binary, rotated binary")


def _probes(queries: DataFrame, lists: Lists, sizes: np.ndarray, share: float) -> DataFrame:
    """(list, query_id, vector, rotated) for each list that a query probes."""
    need = min(1.0, share) * sizes.sum()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                x = np.array(part.column(1).to_pylist(), float)
                order = _squared(x, lists.centroids).argsort(1)
                before = sizes[order].cumsum(1) - sizes[order]
                row, column = np.nonzero((before < need) & (sizes[order] > 0))
                own = [v.tobytes() for v in x]
                turned = [v.tobytes() for v in x @ lists.rotation]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(order[row, column], pa.int32()),
                        part.column(0).take(pa.array(row)),
                        pa.array([own[i] for i in row], pa.binary()),
                        pa.array([turned[i] for i in row], pa.binary()),
                    ],
                    names=["list", "query_id", "vector", "rotated"],
                )

    return queries.mapInArrow(choose, "list int, query_id long, vector binary, rotated binary")


def scan(
    query: np.ndarray, turned: np.ndarray, ids: np.ndarray, vectors: np.ndarray, rotated: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest, by abandoning candidates block by block."""
    dims = rotated.shape[1]
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    for start in range(0, len(ids), CHUNK):
        alive = np.arange(start, min(start + CHUNK, len(ids)))
        if len(best) == k:
            limit, partial = best[-1] ** 2, np.zeros(len(alive))
            for at in range(0, dims, BLOCK):
                difference = rotated[alive, at : at + BLOCK] - turned[at : at + BLOCK]
                partial += np.einsum("ij,ij->i", difference, difference)
                seen = min(at + BLOCK, dims)
                # With all dimensions seen only rounding is allowed for.
                slack = (1 + SLACK / seen**0.5) ** 2 if seen < dims else 1 + 1e-9
                stay = partial * dims / seen <= limit * slack + 1e-12
                alive, partial = alive[stay], partial[stay]
        distance = np.sqrt(((vectors[alive] - query) ** 2).sum(1))
        best_ids, best = np.r_[best_ids, ids[alive]], np.r_[best, distance]
        order = np.lexsort((best_ids, best))[:k]
        best_ids, best = best_ids[order], best[order]
    return best_ids, best


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), float).reshape(len(column), -1)


def _searched(placed: DataFrame, probes: DataFrame, parts: np.ndarray, k: int) -> DataFrame:
    """The k nearest of each query in each part of the lists that it probes."""
    spark = placed.sparkSession
    asked = np.zeros(len(parts), int)
    for r in probes.groupBy("list").count().collect():
        asked[r["list"]] = r["count"]
    blocks = np.maximum(1, -(-asked // QUERIES_PER_BLOCK))
    # One row per list, at most MOST_LISTS.
    cuts = spark.createDataFrame(
        [(i, int(p), int(b)) for i, (p, b) in enumerate(zip(parts, blocks, strict=True))],
        "list int, parts int, blocks int",
    )
    cuts = F.broadcast(cuts)
    left = placed.join(cuts, "list").select(
        "list", F.pmod(F.xxhash64("vec_id", "vector"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "vector", "rotated",
    )
    right = probes.join(cuts, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(_hash("query_id"), "blocks").cast("int").alias("block"), "query_id", "vector", "rotated",
    )

    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(queries):
            ids = candidates["vec_id"].to_numpy()
            vectors, rotated = _matrix(candidates["vector"]), _matrix(candidates["rotated"])
            for query_id, own, turned in zip(
                queries["query_id"], _matrix(queries["vector"]), _matrix(queries["rotated"]), strict=True
            ):
                others = ids != query_id
                if others.all():
                    near, distance = scan(own, turned, ids, vectors, rotated, k)
                else:
                    near, distance = scan(own, turned, ids[others], vectors[others], rotated[others], k)
                found.append(pd.DataFrame({"query_id": query_id, "vec_id": near, "score": distance}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ("list", "part", "block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, RESULT)


def _nearest_of(work: Work, rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of vectors of one dimension."""
    total = rows.count()
    lists = fit(rows, total, k)
    placed = work.table(index(rows, lists), "index")
    sizes = np.zeros(len(lists.centroids), int)
    for r in placed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    parts = np.maximum(1, -(-sizes // ROWS_PER_PART))
    probes = work.table(_probes(queries, lists, sizes, lists.share), "probes")
    found = work.table(_searched(placed, probes, parts, k), "found")
    if lists.share < 1:
        # Queries whose lists hold fewer than k others: all lists.
        enough = found.groupBy("query_id").count().where(F.col("count") >= k)
        short = queries.join(enough, queries["vec_id"] == enough["query_id"], "left_anti")
        short = work.table(short, "short")
        if not short.isEmpty():
            again = _searched(placed, work.table(_probes(short, lists, sizes, 1.0), "probes"), parts, k)
            found = found.join(short, found["query_id"] == short["vec_id"], "left_anti").unionByName(again)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(
    df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's k nearest."""
    spark = df.sparkSession
    with Work(spark) as work:
        rows = work.table(usable(df, vec_id, vector), "vectors")
        queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
        found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        for d in dimensions(rows, "vector"):
            own = F.size("vector") == d
            found = found.unionByName(_nearest_of(work, rows.where(own), queries.where(own), k))
        return materialise(found, "nearest")
