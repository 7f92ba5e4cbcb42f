"""Exact ranked lexical search: ball trees over sparse document vectors.

Terms are runs of letters, digits and characters beyond ASCII, with A to Z in lower case. N
documents have terms, L is the number of all their terms, and a term in df documents has the
weight w = floor(1000 * ln((2N + 2) / (2df + 1))). A document of n terms has m = 75 + 25nN
div L, and holds a term tf times with the value w * (10^9 tf div (1000 tf + 12 m)). Its score
is the inner product of these values with the counts of a query's terms, in whole numbers.

Vectors keep the terms of the queries only, which changes no score. Documents are led to
cells by splits fitted on a bounded sample, cells are cut into trees of at most
ROWS_PER_TREE rows, and a tree halves its rows along the line between two far ones. A
node knows its centroid, its radius and the radius along each term. A query's product with
the centroid and its length times the radius bound its score in the node, and so does the sum
over its terms of centroid and radius; both are rounded up. A query opens the node of the
highest bound first and ends a tree when no bound reaches its k-th score so far, which it
keeps from tree to tree and begins with that of the sample. Leaves are scored exactly.

Queries are searched together, as far as they have ENTRIES different terms in all; beyond
that in several passes. Equal queries are searched once. All rows are documents, those that
repeat an id or have a null id (last among equal scores) too. Null and empty texts have no
terms: such a document is never found, such a query finds none. Rows of equal score and id
take ranks in any order. Empty tables give no rows. Only ids and texts are read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Work
from tidemark.session import materialise

ROWS_PER_TREE = 4_096
ROWS_PER_LEAF = 16
# Entries of one tree; a chunk of long documents ends there.
ENTRIES_PER_TREE = 4_000_000
# Different terms of the queries that are searched in one pass.
ENTRIES = 1_000_000
# Rows and entries of the sample that cells and first thresholds come from.
SAMPLE, SAMPLE_ENTRIES = 2_048, 2_000_000
CELLS = 256

_TERM = [c for c in range(256) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128]
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c in _TERM else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a whole text, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Rows:
    """Sparse rows: row i has terms ``idx[at[i]:at[i+1]]``, ascending, and positive whole values."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, idx: np.ndarray, val: np.ndarray):
        self.ids, self.sizes, self.idx, self.val = ids, sizes, idx, val
        self.at = np.r_[0, np.cumsum(sizes)]

    def __len__(self) -> int:
        return len(self.sizes)

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.sizes[rows]
        # Places of all entries of the rows: starts repeated, and steps within each row.
        place = np.repeat(self.at[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        return Rows(self.ids[rows], sizes, self.idx[place], self.val[place])

    def products(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of each row with a dense vector; no row is empty."""
        return np.add.reduceat(self.val * dense[self.idx], self.at[:-1])

    def one(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.at[row], self.at[row + 1])
        return self.idx[span], self.val[span]


def _columns(rows: Rows) -> tuple[np.ndarray, Rows]:
    """The terms of a node, ascending, and its rows over the numbers of these terms."""
    terms, own = np.unique(rows.idx, return_inverse=True)
    return terms, Rows(rows.ids, rows.sizes, own, rows.val.astype(float))


def _distances(rows: Rows, centre: np.ndarray) -> np.ndarray:
    squares = np.add.reduceat(rows.val * rows.val, rows.at[:-1])
    return np.sqrt(np.maximum(squares - 2 * rows.products(centre) + centre @ centre, 0))


def far_pair(own: Rows, away: np.ndarray, n_terms: int) -> tuple[int, int]:
    """Two rows far from each other: the farthest from the centroid, and the farthest from that."""
    a = int(away.argmax())
    point = np.zeros(n_terms)
    idx, val = own.one(a)
    point[idx] = val
    return a, int(_distances(own, point).argmax())


def halves(own: Rows, pair: tuple[int, int], n_terms: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Rows on both sides of the middle of their projections on the line between two of them."""
    line = np.zeros(n_terms)
    for row, sign in zip(pair, (1, -1), strict=True):
        idx, val = own.one(row)
        line[idx] += sign * val
    along = own.products(line)
    order = np.argsort(along, kind="stable")
    half = len(own) // 2
    return order[:half], order[half:], float(along[order[half]])


class Node:
    """Centroid, radius and radius along each term, and either rows or two children."""

    def __init__(self, rows: Rows):
        self.terms, own = _columns(rows)
        n = len(self.terms)
        self.centre = np.bincount(own.idx, own.val, n) / len(rows)
        away = _distances(own, self.centre)
        # Larger than the true distance by far more than what doubles lose.
        scale = math.sqrt(float(own.val @ own.val)) + 1
        self.radius = float(away.max()) + scale * 1e-6
        largest = np.zeros(n)
        np.maximum.at(largest, own.idx, own.val)
        self.reach = largest - self.centre
        self.rows, self.children = None, ()
        if len(rows) <= ROWS_PER_LEAF or not away.max() > scale * 1e-6:
            self.rows = rows
            return
        low, high, _ = halves(own, far_pair(own, away, n), n)
        del own
        self.children = (Node(rows.take(low)), Node(rows.take(high)))

    def bound(self, terms: np.ndarray, counts: np.ndarray) -> float:
        """No row of the node scores higher for a query of ascending terms."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        met = self.terms[at] == terms
        at, counts = at[met], counts[met]
        centre = float(self.centre[at] @ counts)
        ball = centre + math.sqrt(float(counts @ counts)) * self.radius
        axes = centre + float(self.reach[at] @ counts)
        return min(ball, axes) * (1 + 1e-9) + 1


class Best:
    """The k best rows of one query so far."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, k: int, least: int = 1):
        self.terms, self.counts, self.k, self.least = terms, counts.astype(float), k, least
        self.whole = counts.astype(np.int64)
        self.ids: list = []
        self.scores = np.zeros(0, np.int64)
        self.opened = self.scored = 0

    def search(self, root: Node, dense: np.ndarray) -> None:
        """Visit a tree, nodes of the highest bound first; ``dense`` is zero before and after."""
        dense[self.terms] = self.whole
        waiting = [(-root.bound(self.terms, self.counts), 0, root)]
        while waiting and -waiting[0][0] >= self.least:
            node = heapq.heappop(waiting)[2]
            self.opened += 1
            if node.rows is not None:
                self.scored += len(node.rows)
                self._add(node.rows.ids, node.rows.products(dense))
            for child in node.children:
                bound = child.bound(self.terms, self.counts)
                if bound >= self.least:
                    heapq.heappush(waiting, (-bound, id(child), child))
        dense[self.terms] = 0

    def _add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        kept = np.flatnonzero(scores >= self.least)
        if not len(kept):
            return
        self.ids = self.ids + [ids[i] for i in kept]
        self.scores = np.r_[self.scores, scores[kept]]
        order = sorted(range(len(self.ids)), key=lambda i: (-self.scores[i], self.ids[i] is None, self.ids[i] or 0))[: self.k]
        self.ids, self.scores = [self.ids[i] for i in order], self.scores[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


class Values:
    """What turns counts into values: weights of the terms and the two sums over all documents."""

    def __init__(self, weights: np.ndarray, documents: int, total: int):
        self.weights, self.documents, self.total = weights, documents, total

    def of(self, n: int, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = 75 + 25 * n * self.documents // self.total
        tf = counts.astype(np.int64)
        value = self.weights[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
        return terms[value > 0], value[value > 0]


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Cells:
    """A tree of splits, each by two sampled rows and a threshold, that leads rows to cells."""

    def __init__(self, rows: Rows, depth: int):
        self.split = None
        if depth and len(rows) >= 2:
            terms, own = _columns(rows)
            n = len(terms)
            away = _distances(own, np.bincount(own.idx, own.val, n) / len(rows))
            pair = far_pair(own, away, n)
            low, high, middle = halves(own, pair, n)
            self.split = (rows.one(pair[0]), rows.one(pair[1]), middle)
            self.sides = (Cells(rows.take(low), depth - 1), Cells(rows.take(high), depth - 1))

    def of(self, rows: Rows, dense: np.ndarray) -> np.ndarray:
        """The cell of each row; ``dense`` is zero before and after."""
        cells = np.zeros(len(rows), np.int64)
        if self.split is None or not len(rows):
            return cells
        (a, x), (b, y), middle = self.split
        dense[a] += x
        dense[b] -= y
        above = rows.products(dense) >= middle
        dense[a] = dense[b] = 0
        for side, own in zip(self.sides, (~above, above), strict=True):
            at = np.flatnonzero(own)
            cells[at] = side.of(rows.take(at), dense) * 2 + (side is self.sides[1])
        return cells


def _joined(parts: list[tuple]) -> Rows:
    """Rows of (id, terms, values)."""
    ids = np.array([p[0] for p in parts], object)
    sizes = np.array([len(p[1]) for p in parts], np.int64)
    return Rows(ids, sizes, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]))


def _forward(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): length of a text, and its terms that have a number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                found = Counter(w for w in words if w in number)
                pairs = sorted((number[w], c) for w, c in found.items())
                sizes.append(len(words))
                terms.append([p[0] for p in pairs])
                counts.append([p[1] for p in pairs])
            arrays = [batch.column(0), pa.array(sizes, pa.int64())]
            arrays += [pa.array(x, pa.list_(pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<int>")


def _queries(queries: DataFrame) -> DataFrame:
    """(item_id, query, terms, counts): query is a digest of terms and counts."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(Counter(terms_of(t)).items()) for t in batch.column(1).to_pylist()]
            terms = pa.array([[w for w, _ in f] for f in found], pa.list_(pa.binary()))
            counts = pa.array([[c for _, c in f] for f in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), terms, counts], names=["item_id", "terms", "counts"])

    of_id = queries.schema[0].dataType.simpleString()
    parsed = queries.mapInArrow(parse, f"item_id {of_id}, terms array<binary>, counts array<bigint>")
    spelled = F.concat_ws(",", F.transform("terms", F.hex), F.transform("counts", lambda c: c.cast("string")))
    return parsed.withColumn("query", F.md5(spelled))


def _search(work: Work, docs: DataFrame, asked: list, k: int) -> DataFrame | None:
    """(query, doc_id, score): each query's best rows of every task."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted({bytes(t) for r in asked for t in r["terms"]}))}
    forward = work.table(_forward(docs, number), "forward")
    sums = forward.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("total")).first()
    if not sums["documents"]:
        return None
    weights = np.zeros(len(number), np.int64)
    for r in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weights[r["t"]] = weight(sums["documents"], r["count"])
    values = Values(weights, sums["documents"], sums["total"])
    terms_in, size = np.int32, len(number)

    # Cells and first thresholds from a sample.
    some = forward.where(F.size("terms") > 0).orderBy(F.xxhash64("doc_id", "n", "terms"), "doc_id").limit(SAMPLE)
    sample, entries = [], 0
    for r in some.toLocalIterator():
        terms, val = values.of(r["n"], np.array(r["terms"], terms_in), np.array(r["counts"]))
        entries += len(terms)
        if entries > SAMPLE_ENTRIES:
            break
        if len(terms):
            sample.append((r["doc_id"], terms, val))
    begun = [
        Best(np.array([number[bytes(t)] for t in r["terms"]], terms_in), np.array(r["counts"], np.int64), k) for r in asked
    ]
    cells = None
    if sample:
        rows = _joined(sample)
        found = forward.where(F.size("terms") > 0).count()
        depth = max(0, min(CELLS, -(-found // ROWS_PER_TREE)) - 1).bit_length()
        cells = Cells(rows, depth)
        root, dense = Node(rows), np.zeros(size, np.int64)
        for best in begun:
            best.search(root, dense)
    least = [b.least for b in begun]
    wanted = [(r["query"], b.terms, b.whole) for r, b in zip(asked, begun, strict=True)]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(size)
        for batch in batches:
            kept, parts = [], []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for i, (doc, n, terms, counts) in enumerate(zip(*columns, strict=True)):
                own, val = values.of(n, np.array(terms, terms_in), np.array(counts))
                if len(own):
                    kept.append(i)
                    parts.append((doc, own, val))
            cell = cells.of(_joined(parts), dense) if parts and cells else np.zeros(len(parts), np.int64)
            arrays = [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(cell.astype(np.int32))]
            arrays += [pa.array([p[i].tobytes() for p in parts], pa.binary()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "cell", "terms", "vals"])

    led = forward.where(F.size("terms") > 0).mapInArrow(lead, "doc_id long, cell int, terms binary, vals binary")
    led = work.table(led.withColumn("salt", F.monotonically_increasing_id()), "cells")
    sizes = {r["cell"]: r["count"] for r in led.groupBy("cell").count().collect()}
    if not sizes:
        return None
    trees = {cell: -(-n // ROWS_PER_TREE) for cell, n in sizes.items()}
    n_trees = F.element_at(F.create_map(*[F.lit(x) for pair in trees.items() for x in pair]), F.col("cell"))
    cut = led.withColumn("tree", F.pmod(F.xxhash64("salt"), n_trees))
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(trees.values()) // 8))
    dealt = cut.repartition(tasks, "cell", "tree").sortWithinPartitions("cell", "tree")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(size, np.int64)
        best = [Best(t, c, k, at_least) for (_, t, c), at_least in zip(wanted, least, strict=True)]
        for rows in _chunks(batches):
            root = Node(rows)
            for own in best:
                own.search(root, dense)
        names = [w[0] for w, b in zip(wanted, best, strict=True) for _ in b.ids]
        ids = pa.array([i for b in best for i in b.ids], pa.int64())
        scores = pa.array([int(s) for b in best for s in b.scores], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), ids, scores], names=["query", "doc_id", "score"])

    return dealt.mapInArrow(search, "query string, doc_id long, score long")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    """The rows of one tree at a time, of bounded number and entries."""
    parts, current, entries = [], None, 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("cell", "tree", "doc_id", "terms", "vals"))
        for cell, tree, doc, terms, vals in zip(*columns, strict=True):
            if parts and ((cell, tree) != current or len(parts) >= 2 * ROWS_PER_TREE or entries > ENTRIES_PER_TREE):
                yield _joined(parts)
                parts, entries = [], 0
            current = (cell, tree)
            parts.append((doc, np.frombuffer(terms, np.int32), np.frombuffer(vals, np.int64)))
            entries += len(parts[-1][1])
    if parts:
        yield _joined(parts)


def rank(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of each query's k highest scores above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with Work(spark) as work:
        items = work.table(_queries(queries.select(F.col(item_id).alias("item_id"), F.col(query_text).alias("text"))), "items")
        distinct = items.where(F.size("terms") > 0).groupBy("query").agg(*[F.first(c).alias(c) for c in ("terms", "counts")])
        distinct = work.table(distinct, "queries")
        entries = distinct.agg(F.sum(F.size("terms"))).first()[0] or 0
        passes = -(-entries // ENTRIES)
        found = spark.createDataFrame([], "query string, doc_id long, score long")
        for i in range(passes):
            # A digest is random, so its first digits deal the queries out evenly.
            share = F.conv(F.substring("query", 1, 8), 16, 10).cast("long") % passes == i
            asked = distinct.where(share).collect()
            own = _search(work, texts, asked, k) if asked else None
            if own is not None:
                found = found.unionByName(own)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = work.table(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        ranked = items.select("item_id", "query").join(best, "query")
        return materialise(ranked.select("item_id", "rank", "doc_id", "score"), "ranked")
