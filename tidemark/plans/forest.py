"""Random forests whose rows and trees stay on the executors.

Rows are binned once and written in blocks. A table that fits into a task is sent to as many tasks
as keep the cores busy, and each draws and grows its share of the trees. Of a larger one, nodes
with many rows are split from sums that all blocks add to; a node whose rows fit into a task gets
its rows sent, and its whole subtree is grown there. Either way a task goes level by level over
all its nodes at once, on rows whose bins are bits of few words. Trees are rows of a table below the
shared folder. Scores and Shapley values come from blocks of rows meeting parts of that table, so
neither the rows nor the trees are ever whole in the driver or in one task.

The method is MLlib's: rows drawn with replacement per tree, features drawn per node, Gini gain of
weighted rows, at most ``maxBins`` bins by quantile, and sister leaves that predict the same class
merged. Bags hang on the block, so a forest depends on how its rows were cut into blocks.
"""

from __future__ import annotations

import json
import math
import pickle
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.ml import Model
from pyspark.ml import classification as mllib
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.plans.boosting import Layout, _entries, _remove, layouts_of
from tidemark.session import materialise, work_path

# Rows of a block of the training table, and of a table that is scored.
BLOCK_ROWS = 16_384
# Rows times features of a node that a task grows on its own; larger nodes are split from sums.
LOCAL_CELLS = 8_000_000
# Rows times features of a table that tasks hold whole, each for its share of the trees.
WHOLE_CELLS = 100_000_000
# Cells of the sums that a task holds at once.
CELLS = 1_000_000
# Rows times drawn features that are looked up at once.
LOOKED_UP = 65_536
# What a row of class 1 counts besides itself; sums of rows below it are exact.
POSITIVE = 2.0**26
# Bytes of trees that a task holds while rows pass by.
CHUNK_BYTES = 32_000_000
# A gain below this is none.
LEAST_GAIN = 1e-12
TREES = "tree int, nodes bigint, size bigint, importance array<double>, data binary"


@dataclass(frozen=True)
class Growing:
    """What the trees of a forest are grown by."""

    trees: int
    depth: int
    columns: int
    least_rows: int
    least_gain: float
    rate: float
    drawn: bool
    seed: int


@dataclass
class Nodes:
    """Nodes of a tree, parents first; a leaf has feature -1. ``value`` is the share of class 1."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    # Gain times weight of a split; not kept with the model.
    gain: np.ndarray


@dataclass
class Rows:
    """Some rows: bins by feature and row, label, weight, and how often each was drawn."""

    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    n: np.ndarray


def columns_drawn(strategy: str, size: int, trees: int) -> int:
    """Features tried per node, by MLlib's names."""
    known = {
        "all": size, "sqrt": math.ceil(math.sqrt(size)), "log2": max(1, math.ceil(math.log2(max(size, 1)))),
        "onethird": math.ceil(size / 3),
    }
    known["auto"] = known["all"] if trees == 1 else known["sqrt"]
    if strategy in known:
        return max(1, min(known[strategy], size))
    number = float(strategy)
    return max(1, min(size, int(number) if "." not in strategy else math.ceil(number * size)))


def draw(settings: Growing, tree: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the bag of a tree."""
    rng = np.random.default_rng([settings.seed & 0xFFFFFFFF, tree, block, 1])
    if settings.drawn:
        return rng.poisson(settings.rate, rows)
    return (rng.random(rows) < settings.rate).astype(np.int64)


def columns_of(settings: Growing, tree: int, node: int, level: int, nodes: int, size: int) -> np.ndarray:
    """The features tried at each node of a level, a row per node."""
    rng = np.random.default_rng([settings.seed & 0xFFFFFFFF, tree, node, level, 2])
    m = settings.columns
    if m >= size:
        return np.tile(np.arange(size), (nodes, 1))
    return np.argpartition(rng.random((nodes, size), np.float32), m - 1, axis=1)[:, :m]


def _score(w: np.ndarray, p: np.ndarray) -> np.ndarray:
    return (p * p + (w - p) * (w - p)) / np.maximum(w, 1e-300)


def best_bins(sums: np.ndarray, least_rows: int, least_gain: float) -> tuple[np.ndarray, np.ndarray]:
    """(gain times weight, bin) of the best split of sums (node, bin, [weight, positive, rows])."""
    run = np.cumsum(sums, axis=1)
    total = run[:, -1:]
    left = run[:, :-1]
    if not left.shape[1]:
        return np.full(len(sums), -np.inf), np.zeros(len(sums), np.int64)
    right = total - left
    gain = _score(left[..., 0], left[..., 1]) + _score(right[..., 0], right[..., 1]) - _score(total[..., 0], total[..., 1])
    least = max(1, least_rows) - 0.5
    allowed = (left[..., 2] > least) & (right[..., 2] > least) & (left[..., 0] > 0) & (right[..., 0] > 0)
    floor = np.maximum(LEAST_GAIN, least_gain) * total[..., 0]
    gain = np.where(allowed & (gain > LEAST_GAIN * total[..., 0]) & (gain >= floor), gain, -np.inf)
    best = gain.argmax(axis=1)
    return gain[np.arange(len(gain)), best], best


class Fields:
    """Where the bins of each feature lie among the bits of a row's words."""

    def __init__(self, bins: np.ndarray):
        self.bins = np.maximum(np.asarray(bins, np.int64), 1)
        bits = np.array([int(b - 1).bit_length() for b in self.bins], np.int64)
        self.kind = np.uint32 if bits.sum() <= 32 else np.uint64
        self.word, shift, used, word = np.zeros(len(bits), np.int64), np.zeros(len(bits), np.int64), 0, 0
        for f, b in enumerate(bits):
            if used + b > 64:
                word, used = word + 1, 0
            self.word[f], shift[f] = word, used
            used += int(b)
        self.words = word + 1
        self.shift, self.mask = shift.astype(self.kind), ((1 << bits) - 1).astype(self.kind)

    def packed(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((self.words, bins.shape[1]), self.kind)
        for f, own in enumerate(bins):
            out[self.word[f]] |= own.astype(self.kind) << self.shift[f]
        return out

    def of(self, words: np.ndarray, feature: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bins of rows that lie by node, of one feature per node (last axis)."""
        spread = lambda x: x[feature] if len(sizes) == 1 else np.repeat(x[feature], sizes, axis=-1)
        own = words[0] if self.words == 1 else words[spread(self.word), np.arange(words.shape[1])]
        return ((own >> spread(self.shift)) & spread(self.mask)).astype(np.int64)


def weights_by_label(y: np.ndarray, w: np.ndarray) -> tuple[float, float] | None:
    """The weight of each class, if all rows of a class weigh the same."""
    found = []
    for own in (w[y == 0], w[y != 0]):
        if len(own) and own.min() != own.max():
            return None
        found.append(float(own[0]) if len(own) else 1.0)
    return found[0], found[1]


def grow(rows: Rows, width: int, settings: Growing, tree: int, node: int, depth: int) -> Nodes:
    """The subtree below a node that starts at ``depth``, from its rows."""
    weights = weights_by_label(rows.y, rows.w)
    if weights is None or rows.n.sum() >= POSITIVE:
        return grow_weighted(rows, width, settings, tree, node, depth)
    fields = Fields(rows.bins.max(axis=1, initial=0).astype(np.int64) + 1)
    return grow_counted(fields, fields.packed(rows.bins), counted(rows.y, rows.n), weights, settings, tree, node, depth)


def counted(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows and rows of class 1 as one number each."""
    return n * np.where(y != 0, POSITIVE + 1, 1.0)


def grow_counted(
    fields: Fields, words: np.ndarray, counts: np.ndarray, weights: tuple[float, float], settings: Growing, tree: int, node: int, depth: int
) -> Nodes:
    """The subtree of rows whose weight hangs on the class: sums are whole numbers, so one sum serves both classes.

    Only rows of nodes that may be split are kept. They lie by node, and each level lays them out
    anew: left children of all nodes, then the right ones. A child's sum is known from the split.
    """
    least, number, widest = max(1, settings.least_rows), 0, int(fields.bins.max(initial=1))
    parts: list[tuple] = []

    def weighed(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(weight, weight of class 1, rows) of sums."""
        positive = np.floor(sums / POSITIVE)
        rows = sums - positive * POSITIVE
        share = weights[1] * positive
        return weights[0] * (rows - positive) + share, share, rows

    def is_open(sums: np.ndarray, level: int) -> np.ndarray:
        total, share, rows = weighed(sums)
        return (level < settings.depth) & (share > 0) & (share < total) & (rows >= 2 * least)

    def best(at: slice, sizes: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, ...]:
        """(gain times weight, bin, sum of the left side) of features (draw, node) on the rows ``at`` of nodes of ``sizes``."""
        width = fields.bins[feature]
        start = (np.cumsum(width) - width.ravel()).reshape(width.shape)
        cell = fields.of(words[:, at], feature, sizes)
        cell += start if len(sizes) == 1 else np.repeat(start, sizes, axis=1)
        own = counts[at] if len(feature) == 1 else np.tile(counts[at], len(feature))
        sums = np.bincount(cell.ravel(), own, int(width.sum()))
        start, width = start.ravel(), width.ravel()
        run = np.cumsum(sums)
        before = np.r_[0.0, run][start]
        left = run - np.repeat(before, width)
        total = run[start + width - 1] - before
        right = np.repeat(total, width) - left
        whole = weighed(total)
        (lw, lp, ln), (rw, rp, rn) = weighed(left), weighed(right)
        gain = _score(lw, lp) + _score(rw, rp) - np.repeat(_score(*whole[:2]), width)
        floor = np.repeat(np.maximum(LEAST_GAIN, settings.least_gain) * whole[0], width)
        allowed = (ln >= least) & (rn >= least) & (lw > 0) & (rw > 0) & (gain >= floor)
        gain = np.where(allowed & (gain > LEAST_GAIN * np.repeat(whole[0], width)), gain, -np.inf)
        most = np.maximum.reduceat(gain, start)
        among = np.flatnonzero(gain == np.repeat(most, width))
        first = among[np.searchsorted(among, start)]
        return tuple(x.reshape(feature.shape) for x in (most, first - start, left[first]))

    sums = np.array([counts.sum()])
    live = np.flatnonzero(is_open(sums, depth))
    sizes = np.array([len(counts)])[live]
    for level in range(depth, settings.depth + 1):
        k = len(sums)
        total, share, _ = weighed(sums)
        feature, bins, gains, low = np.full(k, -1), np.zeros(k, np.int64), np.full(k, -np.inf), np.zeros(k)
        ends = np.cumsum(sizes)
        if len(live):
            drawn = columns_of(settings, tree, node, level, k, len(fields.bins))[live].T
        a = 0
        while a < len(live):
            first = int(ends[a] - sizes[a])
            b = max(a + 1, min(int(np.searchsorted(ends, first + LOOKED_UP, "right")), a + CELLS // widest))
            at = slice(first, int(ends[b - 1]))
            draws = max(1, min(len(drawn), LOOKED_UP // (at.stop - first), CELLS // ((b - a) * widest)))
            for j in range(0, len(drawn), draws):
                tried = drawn[j : j + draws, a:b]
                for f, gain, end, left in zip(tried, *best(at, sizes[a:b], tried), strict=True):
                    better = gain > gains[live[a:b]]
                    into = live[a:b][better]
                    gains[into], bins[into], low[into], feature[into] = gain[better], end[better], left[better], f[better]
            a = b
        split = feature >= 0
        made = int(split.sum())
        left, right = np.full(k, -1), np.full(k, -1)
        left[split] = number + k + np.arange(made)
        right[split] = left[split] + made
        parts.append((feature, bins, left, right, share / np.maximum(total, 1e-300), np.where(split, gains, 0.0)))
        number += k
        if not made:
            break
        sums = np.r_[low[split], sums[split] - low[split]]
        opened = is_open(sums, level + 1)
        # Which children of the nodes at hand are open; a node that was not split has none.
        to_left, to_right = np.zeros(k, bool), np.zeros(k, bool)
        to_left[split], to_right[split] = opened[:made], opened[made:]
        to_left, to_right = to_left[live], to_right[live]
        side = fields.of(words, np.maximum(feature[live], 0), sizes) > np.repeat(bins[live], sizes)
        after = np.add.reduceat(side, ends - sizes, dtype=np.int64)
        kept = np.concatenate([
            np.flatnonzero(np.repeat(to_left, sizes) & ~side), np.flatnonzero(np.repeat(to_right, sizes) & side)
        ])
        words, counts = words.take(kept, axis=1), counts.take(kept)
        sizes = np.r_[(sizes - after)[to_left], after[to_right]]
        live = np.flatnonzero(opened)
    return Nodes(*(np.concatenate(c) for c in zip(*parts, strict=True)))


def grow_weighted(rows: Rows, width: int, settings: Growing, tree: int, node: int, depth: int) -> Nodes:
    """The subtree of rows of any weights."""
    d, n = rows.bins.shape
    flat = np.ascontiguousarray(rows.bins).ravel()
    weight = rows.w * rows.n
    positive = weight * rows.y
    counts = rows.n.astype(float)
    # Rows in the order of their nodes; the rows of node k of the level are start[k] to start[k + 1].
    order, start = np.arange(n), np.array([0, n])
    parts: list[tuple] = []
    number = 0
    for level in range(depth, settings.depth + 1):
        k = len(start) - 1
        total = _summed(weight[order], start)
        share = _summed(positive[order], start)
        feature, bins, gains = np.full(k, -1), np.zeros(k, np.int64), np.full(k, -np.inf)
        open_nodes = np.zeros(k, bool)
        if level < settings.depth:
            open_nodes = (share > 0) & (share < total) & (_summed(counts[order], start) >= 2 * max(1, settings.least_rows))
            labels = _summed(rows.y[order].astype(float), start)
            open_nodes &= (labels > 0) & (labels < np.diff(start))
        if open_nodes.any():
            drawn = columns_of(settings, tree, node, level, k, d)
            live = np.flatnonzero(open_nodes)
            for own in np.array_split(live, max(1, -(-len(live) * width // CELLS))):
                sizes = np.diff(start)[own]
                slot = np.repeat(np.arange(len(own)), sizes)
                at = order[np.repeat(start[own] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())]
                w, p, c = weight[at], positive[at], counts[at]
                for j in range(drawn.shape[1]):
                    f = drawn[own, j]
                    cell = slot * width + flat[f[slot] * n + at]
                    sums = np.stack([np.bincount(cell, x, len(own) * width) for x in (w, p, c)], -1)
                    gain, best = best_bins(sums.reshape(len(own), width, 3), settings.least_rows, settings.least_gain)
                    better = gain > gains[own]
                    at_own = own[better]
                    gains[at_own], bins[at_own], feature[at_own] = gain[better], best[better], f[better]
        split = feature >= 0
        left = np.full(k, -1)
        left[split] = number + k + 2 * np.arange(split.sum())
        right = np.where(split, left + 1, -1)
        parts.append((feature, bins, left, right, share / np.maximum(total, 1e-300), np.where(split, gains, 0.0)))
        number += k
        if not split.any():
            break
        sizes = np.diff(start)
        slot = np.repeat(np.arange(k), sizes)
        kept = split[slot]
        slot, order = slot[kept], order[kept]
        side = flat[feature[slot] * n + order] > bins[slot]
        child = 2 * (np.cumsum(split) - 1)[slot] + side
        made = np.bincount(child, minlength=2 * int(split.sum()))
        start = np.r_[0, np.cumsum(made)]
        # Rows lie by node, so within a node a running count gives each row its place in its child.
        ones = np.cumsum(side)
        node_start = start[:-1:2]
        pair = child // 2
        before = np.r_[0, ones][node_start][pair]
        rank_right = ones - before - 1
        rank_left = np.arange(len(order)) - node_start[pair] - (ones - before)
        place = start[child] + np.where(side, rank_right, rank_left)
        moved = np.empty_like(order)
        moved[place] = order
        order = moved
    return Nodes(*(np.concatenate(c) for c in zip(*parts, strict=True)))


def _summed(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of the stretches between starts, none of which is empty."""
    return np.add.reduceat(values, start[:-1]) if len(values) else np.zeros(len(start) - 1)


def ends_of(feature: np.ndarray, left: np.ndarray, right: np.ndarray, kind: np.ndarray, depth: int) -> np.ndarray:
    """Which nodes end a tree cut at a depth, sister leaves of the same class merged."""
    ends = feature < 0
    levels, at = [], np.array([0])
    while len(at):
        if len(levels) == depth:
            ends[at] = True
            break
        levels.append(at)
        inner = at[feature[at] >= 0]
        at = np.concatenate([left[inner], right[inner]])
    for at in levels[::-1]:
        inner = at[~ends[at]]
        a, b = left[inner], right[inner]
        ends[inner] = ends[a] & ends[b] & (kind[a] == kind[b])
    return ends


def ends_until(nodes: Nodes) -> np.ndarray:
    """The largest depth to which a tree may be cut so that each node ends it, as by :func:`ends_of`; a leaf ends any."""
    until = np.full(len(nodes.feature), np.iinfo(np.int32).max)
    kind = nodes.value > 0.5
    levels, at = [], np.array([0])
    while len(at):
        inner = at[nodes.feature[at] >= 0]
        levels.append(inner)
        at = np.concatenate([nodes.left[inner], nodes.right[inner]])
    for depth in range(len(levels) - 1, -1, -1):
        inner = levels[depth]
        a, b = nodes.left[inner], nodes.right[inner]
        merged = np.where(kind[a] == kind[b], np.minimum(until[a], until[b]), -1)
        until[inner] = np.maximum(depth, merged)
    return until


def descended(nodes: Nodes) -> tuple[np.ndarray, ...]:
    """Feature, bin, both children side by side, the depth that each node ends, and value."""
    child = np.stack([nodes.left, nodes.right], 1).ravel()
    return np.maximum(nodes.feature, 0), nodes.bin, child, ends_until(nodes), nodes.value


def assembled(top: Nodes | None, below: dict[int, Nodes], depth: int) -> Nodes:
    """A tree of its top and the subtrees below some of the top's leaves, merged and renumbered."""
    if top is None:
        whole = below[0]
    else:
        columns = [[c] for c in vars(top).values()]
        first = [c.copy() for c in vars(top).values()]
        offset = len(top.feature)
        for i, own in sorted(below.items()):
            # The root of a subtree takes the place of the top's leaf, the others follow behind.
            moved = lambda x, o=offset: np.where(x >= 0, x + o - 1, x)
            values = [own.feature, own.bin, moved(own.left), moved(own.right), own.value, own.gain]
            for c, v, rest in zip(first, values, columns, strict=True):
                c[i] = v[0]
                rest.append(v[1:])
            offset += len(own.feature) - 1
        for c, rest in zip(first, columns, strict=True):
            rest[0] = c
        whole = Nodes(*(np.concatenate(c) for c in columns))
    ends = ends_of(whole.feature, whole.left, whole.right, whole.value > 0.5, depth)
    kept = np.zeros(len(ends), bool)
    at = np.array([0])
    order = []
    while len(at):
        kept[at] = True
        order.append(at)
        inner = at[~ends[at]]
        at = np.stack([whole.left[inner], whole.right[inner]], 1).ravel()
    order = np.concatenate(order)
    place = np.full(len(ends), -1)
    place[order] = np.arange(len(order))
    inner = ~ends[order]
    pick = lambda column, none: np.where(inner, column[order], none)
    left, right = (np.where(inner, place[np.maximum(c[order], 0)], -1) for c in (whole.left, whole.right))
    return Nodes(pick(whole.feature, -1), pick(whole.bin, 0), left, right, whole.value[order], pick(whole.gain, 0.0))


def places(nodes: Nodes, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at = np.zeros(bins.shape[1], np.int64)
    every = np.arange(bins.shape[1])
    while True:
        f = nodes.feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        low = bins[np.maximum(f, 0), every] <= nodes.bin[at]
        at = np.where(inner, np.where(low, nodes.left[at], nodes.right[at]), at)


def binned(layout: Layout, index: np.ndarray, value: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Bins by feature and row, from the entries that are not zero."""
    small = np.uint8 if max((len(e) for e in layout.ends), default=0) < 256 else np.uint32
    out = np.repeat(layout.zero.astype(small)[:, None], rows, axis=1)
    known = index < layout.size
    index, row = index[known], row[known]
    out[index, row] = layout.cells_of(index, value[known]) - layout.start[index]
    return out


def _batch_entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    index = batch.column("_i")
    lengths = index.value_lengths().to_numpy()
    row = np.repeat(np.arange(batch.num_rows), lengths)
    return index.flatten().to_numpy().astype(np.int64), batch.column("_x").flatten().to_numpy(), row


def _sent(rows: Rows) -> bytes:
    """Rows as bytes: the columns of two bins as bits, few distinct weights as numbers."""
    two = rows.bins.max(axis=1, initial=0) <= 1
    levels, codes = np.unique(rows.w, return_inverse=True)
    weights = (levels, codes.astype(np.uint8)) if len(levels) <= 256 else (None, rows.w)
    parts = (two, np.packbits(rows.bins[two].astype(bool), axis=1), rows.bins[~two], rows.bins.shape[1])
    return pickle.dumps((*parts, np.packbits(rows.y.astype(bool)), weights, rows.n.astype(np.uint16)), protocol=5)


def _received(data: bytes) -> Rows:
    two, bits, others, n, y, (levels, w), counts = pickle.loads(data)
    bins = np.empty((len(two), n), others.dtype)
    bins[two] = np.unpackbits(bits, axis=1, count=n)
    bins[~two] = others
    weights = w if levels is None else levels[w]
    return Rows(bins, np.unpackbits(y, count=n).astype(np.int8), weights, counts.astype(np.int64))


def _joined(parts: Sequence[Rows]) -> Rows:
    return Rows(
        np.concatenate([p.bins for p in parts], axis=1), *(np.concatenate([getattr(p, c) for p in parts]) for c in ("y", "w", "n"))
    )


def _blocks(rows: DataFrame, label: str, weight: str, layout: Layout) -> RDD:
    """(number, rows) of training blocks."""
    columns = rows.select(
        F.col(label).cast("double").alias("_y"), F.col(weight).cast("double").alias("_w"),
        F.col("_entries.i").alias("_i"), F.col("_entries.x").alias("_x"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                own = batch.slice(at, BLOCK_ROWS)
                y, w = (np.array(own.column(c).to_numpy(zero_copy_only=False)) for c in ("_y", "_w"))
                index, value, row = _batch_entries(own)
                block = Rows(binned(layout, index, value, row, own.num_rows), y.astype(np.int8), w, np.ones(len(y), np.int64))
                data = pa.array([_sent(block)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([task * 1_000_003 + made]), data], names=["block", "data"])
                made += 1

    return columns.mapInArrow(cut, "block bigint, data binary").rdd.map(lambda r: (r[0], bytes(r[1])))


def _bag(block: tuple[int, bytes], settings: Growing, tree: int, rows: Rows | None = None) -> Rows:
    rows = rows or _received(block[1])
    n = draw(settings, tree, block[0], len(rows.y))
    held = np.flatnonzero(n)
    return Rows(rows.bins[:, held], rows.y[held], rows.w[held], n[held])


class _Top:
    """The nodes of a tree that are split from sums: those above the nodes with few rows."""

    def __init__(self, tree: int):
        self.tree, self.depth, self.open = tree, [0], [0]
        self.columns: list[list] = [[-1], [0], [-1], [-1], [0.5], [0.0]]

    def nodes(self) -> Nodes:
        return Nodes(*(np.array(c) for c in self.columns))

    def split(self, found: dict[int, tuple], local: int, limit: int) -> None:
        """Take the best splits of the open nodes; children with more than ``local`` rows are open."""
        asked, self.open = self.open, []
        feature, bins, left, right, value, gains = self.columns
        for i in asked:
            share, gain, f, b, sides = found[i]
            value[i] = share
            if f < 0:
                continue
            feature[i], bins[i], gains[i] = f, b, gain
            left[i], right[i] = len(feature), len(feature) + 1
            for rows in sides:
                for column, x in zip(self.columns, (-1, 0, -1, -1, 0.5, 0.0), strict=True):
                    column.append(x)
                self.depth.append(self.depth[i] + 1)
                if rows > local and self.depth[-1] < limit:
                    self.open.append(len(feature) - 1)


def _split_tops(blocks: RDD, tops: list[_Top], settings: Growing, layout: Layout, width: int, local: int) -> None:
    """Split all nodes with many rows, a level of all trees per pass."""
    context, d = blocks.context, layout.size
    while any(t.open for t in tops):
        # Bounded sums per pass: trees whose sums do not fit wait for the next one.
        orders, room = [], 16 * CELLS
        for t in tops:
            cost = len(t.open) * settings.columns * width
            if t.open and (not orders or cost <= room):
                room -= cost
                orders.append((t.tree, t.nodes(), list(t.open), list(t.depth)))

        def columns(tree: int, nodes: list[int], depth: list[int]) -> np.ndarray:
            return np.concatenate([columns_of(settings, tree, i + 1, depth[i], 1, d) for i in nodes])

        def sums(own: Iterator, orders=orders, columns=columns) -> Iterator[tuple]:
            out: dict[int, np.ndarray] = {}
            for block in own:
                rows = _received(block[1])
                for tree, nodes, asked, depth in orders:
                    bag = _bag(block, settings, tree, rows)
                    slots = np.full(len(nodes.feature), -1)
                    slots[asked] = np.arange(len(asked))
                    slot = slots[places(nodes, bag.bins)]
                    held = np.flatnonzero(slot >= 0)
                    slot = slot[held]
                    drawn = columns(tree, asked, depth)
                    w = (bag.w * bag.n)[held]
                    parts = (w, w * bag.y[held], bag.n[held].astype(float))
                    found = []
                    for j in range(drawn.shape[1]):
                        cell = slot * width + bag.bins[drawn[slot, j], held]
                        found.append(np.stack([np.bincount(cell, x, len(asked) * width) for x in parts], -1))
                    whole = np.stack(found).reshape(drawn.shape[1], len(asked), width, 3)
                    out[tree] = out[tree] + whole if tree in out else whole
            yield from out.items()

        wanted = {o[0]: o for o in orders}

        def choose(tree: int, whole: np.ndarray, wanted=wanted, columns=columns) -> dict[int, tuple]:
            _, _, asked, depth = wanted[tree]
            drawn = columns(tree, asked, depth)
            found = [best_bins(s, settings.least_rows, settings.least_gain) for s in whole]
            out = {}
            for k, i in enumerate(asked):
                j = max(range(len(found)), key=lambda j: found[j][0][k])
                gain, b = float(found[j][0][k]), int(found[j][1][k])
                total = whole[j, k].sum(axis=0)
                share = float(total[1] / total[0]) if total[0] > 0 else 0.5
                if not np.isfinite(gain):
                    out[i] = (share, 0.0, -1, 0, (0, 0))
                    continue
                low = whole[j, k, : b + 1, 2].sum()
                out[i] = (share, gain, int(drawn[k, j]), b, (float(low), float(total[2] - low)))
            return out

        parts = min(len(orders), 2 * context.defaultParallelism)
        found = blocks.mapPartitions(sums).reduceByKey(np.add, parts).map(lambda x, choose=choose: (x[0], choose(*x))).collectAsMap()
        for t in tops:
            if t.tree in found:
                t.split(found[t.tree], local, settings.depth)


def _finished(tree: int, made: Nodes, size: int) -> tuple:
    """A row of the table of trees."""
    importance = np.bincount(made.feature[made.feature >= 0], made.gain[made.feature >= 0], size).astype(float)
    total = importance.sum()
    data = pickle.dumps(_packed(made), protocol=5)
    return tree, len(made.feature), len(data), (importance / total if total > 0 else importance).tolist(), data


def _grown_whole(blocks: RDD, settings: Growing, layout: Layout) -> RDD:
    """All trees of a table that a task can hold: each task is sent all blocks and grows its share."""
    tasks = min(settings.trees, 2 * blocks.context.defaultParallelism)
    width = max((len(e) + 1 for e in layout.ends), default=1)

    def share(sent: Iterator) -> Iterator[tuple]:
        task, numbers, ys, ws, parts = -1, [], [], [], []
        fields = Fields(np.array([len(e) + 1 for e in layout.ends]))
        for task, (number, data) in sent:
            rows = _received(data)
            numbers.append(number)
            ys.append(rows.y)
            ws.append(rows.w)
            parts.append(fields.packed(rows.bins))
        if task < 0:
            return
        # Draws hang on the block, sums must not hang on which block came first.
        order = sorted(range(len(numbers)), key=lambda i: numbers[i])
        words = np.concatenate([parts[i] for i in order], axis=1)
        y, w = (np.concatenate([x[i] for i in order]) for x in (ys, ws))
        blocks = [(numbers[i], len(ys[i])) for i in order]
        parts.clear()
        ys.clear()
        ws.clear()
        weights = weights_by_label(y, w)
        for tree in range(task, settings.trees, tasks):
            n = np.concatenate([draw(settings, tree, number, rows) for number, rows in blocks])
            held = np.flatnonzero(n)
            if not len(held):
                # The tree of an empty bag is one leaf that knows nothing.
                own = _Top(tree).nodes()
            elif weights is None or n.sum() >= POSITIVE:
                every = np.arange(layout.size)
                bins = np.stack([fields.of(words[:, held], np.array([f]), np.array([len(held)])) for f in every])
                own = grow_weighted(Rows(bins.astype(np.uint32), y[held], w[held], n[held]), width, settings, tree, 0, 0)
            else:
                own = grow_counted(fields, words[:, held], counted(y[held], n[held]), weights, settings, tree, 0, 0)
            yield _finished(tree, assembled(None, {0: own}, settings.depth), layout.size)

    return blocks.flatMap(lambda b: [(t, b) for t in range(tasks)]).partitionBy(tasks, int).mapPartitions(share)


def _grown(blocks: RDD, settings: Growing, layout: Layout, rows: int) -> RDD:
    """(tree, nodes, bytes, importance, data) of all trees."""
    context, d = blocks.context, layout.size
    if rows * d <= WHOLE_CELLS:
        return _grown_whole(blocks, settings, layout)
    width = max((len(e) + 1 for e in layout.ends), default=1)
    local = max(1, LOCAL_CELLS // max(1, d))
    tops = [_Top(t) for t in range(settings.trees)]
    if rows > local and settings.depth > 0:
        _split_tops(blocks, tops, settings, layout, width, local)
    nodes = {t.tree: (t.nodes(), list(t.depth)) for t in tops}
    known = context.broadcast(nodes)
    split = {t.tree for t in tops if len(t.depth) > 1}

    def send(own: Iterator) -> Iterator[tuple]:
        for block in own:
            rows = _received(block[1])
            for tree in range(settings.trees):
                bag = _bag(block, settings, tree, rows)
                if tree not in split:
                    yield (tree, 0), _sent(bag)
                    continue
                at = places(known.value[tree][0], bag.bins)
                for leaf in np.unique(at):
                    here = np.flatnonzero(at == leaf)
                    yield (tree, int(leaf)), _sent(Rows(bag.bins[:, here], bag.y[here], bag.w[here], bag.n[here]))

    def below(item: tuple) -> tuple:
        (tree, leaf), parts = item
        depth = known.value[tree][1][leaf]
        rows = _joined([_received(p) for p in parts])
        # The tree of an empty bag is one leaf that knows nothing.
        own = grow(rows, width, settings, tree, leaf, depth) if len(rows.y) else _Top(tree).nodes()
        return tree, (leaf, own)

    def whole(item: tuple) -> tuple:
        tree, parts = item
        return _finished(tree, assembled(known.value[tree][0] if tree in split else None, dict(parts), settings.depth), d)

    leaves = sum((np.array(t.columns[0]) < 0).sum() for t in tops)
    parts = max(1, min(int(leaves), 4 * context.defaultParallelism))
    # A subtree per group: rows of a node that fit into a task.
    grown = blocks.mapPartitions(send).groupByKey(parts, lambda key: key[0] * 31 + key[1]).map(below)
    if split:
        grown = grown.groupByKey(parts)
    else:
        grown = grown.map(lambda item: (item[0], [item[1]]))
    return grown.map(whole)


def _packed(nodes: Nodes) -> tuple:
    small = np.int16 if nodes.feature.max(initial=0) < 32_000 else np.int32
    bins = np.uint8 if nodes.bin.max(initial=0) < 256 else np.uint32
    return nodes.feature.astype(small), nodes.bin.astype(bins), nodes.left.astype(np.int32), nodes.right.astype(np.int32), nodes.value


def unpacked(data: bytes) -> Nodes:
    feature, bins, left, right, value = pickle.loads(data)
    return Nodes(*(c.astype(np.int64) for c in (feature, bins, left, right)), value, np.zeros(0))


class RandomForestClassifier(mllib.RandomForestClassifier):
    """MLlib's forest by its settings, for labels 0 and 1, grown as this module does."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__(**kwargs)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        get = self.getOrDefault
        label, weight = get("labelCol"), "_weight"
        features = get("featuresCol")
        own = name(get("weightCol")) if self.isDefined("weightCol") and get("weightCol") else F.lit(1.0)
        rows = dataset.select(F.lit(0).alias("_group"), name(label).alias("_label"), own.alias(weight), name(features).alias("_features"))
        rows = _entries(rows, "_features")
        other = rows.filter(~F.col("_label").isin(0, 1) | F.col("_label").isNull())
        layouts, total = layouts_of(rows, "_label", weight, get("maxBins"))
        if not total:
            raise ValueError("No rows to fit a forest on")
        if not other.isEmpty():
            raise ValueError("Labels of a forest are 0 and 1")
        layout = layouts[0]
        settings = Growing(
            get("numTrees"), get("maxDepth"), columns_drawn(get("featureSubsetStrategy"), layout.size, get("numTrees")),
            get("minInstancesPerNode"), get("minInfoGain"), get("subsamplingRate") if get("numTrees") > 1 else 1.0,
            get("bootstrap") and get("numTrees") > 1, get("seed"),
        )
        spark = dataset.sparkSession
        cut = _blocks(rows, "_label", weight, layout)
        written, path = work_path(spark, "forest-rows"), work_path(spark, "forest")
        cut.coalesce(max(1, min(cut.getNumPartitions(), -(-total // 1_024)))).saveAsPickleFile(written)
        blocks = spark.sparkContext.pickleFile(written).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees = spark.createDataFrame(_grown(blocks, settings, layout, total).map(_as_row), TREES)
            trees.write.parquet(path)
        finally:
            blocks.unpersist()
            _remove(spark, written)
        model = ForestModel()
        self._copyValues(model)
        return model.on(path, layout)


def _as_row(tree: tuple) -> tuple:
    return (*tree[:4], bytearray(tree[4]))


class ForestModel(Model, MLReadable, MLWritable):
    """Fitted :class:`RandomForestClassifier`; its trees are a table, of which the driver holds none."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probabilities of both classes", TypeConverters.toString)
    rawPredictionCol = Param(Params._dummy(), "rawPredictionCol", "votes of both classes", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "class", TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    ensemble = Param(Params._dummy(), "ensemble", "bins, importances and sizes as JSON", TypeConverters.toString)
    table = Param(Params._dummy(), "table", "where the table of trees is", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(
            featuresCol="features", probabilityCol="probability", rawPredictionCol="rawPrediction", predictionCol="prediction",
            numTrees=20, maxDepth=5,
        )

    def on(self, path: str, layout: Layout) -> ForestModel:
        """The model of a written table of trees."""
        trees = SparkSession.active().read.schema(TREES).parquet(path)
        sums = trees.agg(F.count("*").alias("trees"), F.sum("nodes").alias("nodes"), F.sum("size").alias("bytes")).first()
        means = trees.select(F.posexplode("importance").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x")).collect()
        importance = np.zeros(layout.size)
        for r in means:
            importance[r["i"]] = r["x"]
        share = importance / importance.sum() if importance.any() else importance
        state = {"ends": [e.tolist() for e in layout.ends], "importance": share.tolist(), **sums.asDict()}
        return self._set(ensemble=json.dumps(state), table=path)

    @property
    def state(self) -> dict:
        return json.loads(self.getOrDefault("ensemble"))

    @property
    def layout(self) -> Layout:
        ends = self.state["ends"]
        return Layout(len(ends), [np.array(e, float) for e in ends])

    @property
    def getNumTrees(self) -> int:
        return self.state["trees"]

    @property
    def numFeatures(self) -> int:
        return len(self.state["ends"])

    @property
    def featureImportances(self) -> DenseVector:
        """Gini gain by feature, as a share of all gain, mean over the trees."""
        return Vectors.dense(self.state["importance"])

    @property
    def toDebugString(self) -> str:
        state = self.state
        return f"ForestModel: {state['trees']} trees, {state['nodes']} nodes, importances {state['importance']}"

    def trees(self) -> DataFrame:
        return SparkSession.active().read.schema(TREES).parquet(self.getOrDefault("table"))

    def discard(self) -> None:
        """Delete the table of trees."""
        _remove(SparkSession.active(), self.getOrDefault("table"))

    def against(
        self, blocks: RDD, number: int, part: Callable[[list, object], np.ndarray], ready: Callable[[Nodes], object] | None = None
    ) -> RDD:
        """(block, sum over all trees) for (block, what ``part`` takes next to a list of trees).

        Blocks are dealt to groups and trees to chunks; each pair of a group and a chunk is a
        task, which holds the chunk's trees, each made ``ready`` once, while the blocks pass by.
        """
        context, state = blocks.context, self.state
        wanted = 2 * context.defaultParallelism
        chunks = min(state["trees"], max(-(-state["bytes"] // CHUNK_BYTES), -(-wanted // max(1, number))))
        groups = max(1, min(number, -(-wanted // chunks)))
        sent = blocks.flatMap(lambda b: [((b[0] % groups * chunks + c, 1), b) for c in range(chunks)])
        trees = self.trees().select("tree", "data").rdd.map(lambda r: (r[0], bytes(r[1])))
        trees = trees.flatMap(lambda t: [((g * chunks + t[0] % chunks, 0), t) for g in range(groups)])

        def meet(items: Iterator) -> Iterator[tuple]:
            held, task = [], None
            for (key, kind), item in items:
                if key != task:
                    held, task = [], key
                if kind == 0:
                    nodes = unpacked(item[1])
                    held.append((item[0], ready(nodes) if ready else nodes))
                else:
                    yield item[0], part(held, item[1])

        tasks = groups * chunks
        met = trees.union(sent).repartitionAndSortWithinPartitions(tasks, lambda key: key[0]).mapPartitions(meet)
        return met.reduceByKey(np.add, max(1, min(number, context.defaultParallelism)))

    def scores(self, rows: DataFrame, shapes: Sequence[tuple[int, int]], column: str) -> DataFrame:
        """Adds the array of the probabilities of class 1 for each (number of trees, depth).

        The first trees of a forest are a smaller forest. A tree that was grown deeper and is
        cut has the splits that a shallower one would have drawn.
        """
        spark, layout = rows.sparkSession, self.layout
        depths = sorted({d for _, d in shapes})
        parts = _entries(rows.withColumn("_features", name(self.getOrDefault("featuresCol"))), "_features")
        parts = parts.select(*[name(c) for c in rows.columns], F.col("_entries.i").alias("_i"), F.col("_entries.x").alias("_x"))
        kept = len(rows.columns)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, made = TaskContext.get().partitionId(), 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                index, value, row = _batch_entries(batch)
                bins = binned(layout, index, value, row, batch.num_rows)
                sink = pa.BufferOutputStream()
                own = batch.select(list(range(kept)))
                with pa.ipc.new_stream(sink, own.schema) as stream:
                    stream.write_batch(own)
                values = ([task * 1_000_003 + made], [pickle.dumps(bins, protocol=5)], [sink.getvalue().to_pybytes()])
                made += 1
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["block", "bins", "held"])

        written = materialise(parts.mapInArrow(cut, "block bigint, bins binary, held binary"), "to-score")

        sizes = sorted({size for size, _ in shapes})

        def part(held: list, data: bytes) -> np.ndarray:
            bins = pickle.loads(data)
            flat, n = bins.ravel(), bins.shape[1]
            # Sums of the trees between two sizes, by depth.
            sums = np.zeros((len(sizes), len(depths), n))
            for tree, (feature, end, child, until, value) in held:
                size = bisect_right(sizes, tree)
                if size == len(sizes):
                    continue
                first = feature * n
                at = np.zeros(n, np.int64)
                for k, d in enumerate(depths):
                    live = np.flatnonzero(until[at] < d)
                    while len(live):
                        here = at[live]
                        here = child[2 * here + (flat[first[here] + live] > end[here])]
                        at[live] = here
                        live = live[until[here] < d]
                    sums[size, k] += value[at]
            return np.stack([sums[: sizes.index(n) + 1, depths.index(d)].sum(axis=0) / n for n, d in shapes])

        number = written.count()
        if not number:
            return rows.withColumn(column, F.array().cast("array<double>"))
        blocks = written.select("block", "bins").rdd.map(lambda r: (r[0], bytes(r[1])))
        sums = self.against(blocks, number, part, descended).map(lambda r: (r[0], bytearray(np.ascontiguousarray(r[1].T).tobytes())))
        scored = written.select("block", "held").join(spark.createDataFrame(sums, "block bigint, sums binary"), "block")
        width = len(shapes)

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for held, data in zip(batch.column("held"), batch.column("sums"), strict=True):
                    (own,) = pa.ipc.open_stream(held.as_buffer()).read_all().combine_chunks().to_batches()
                    flat = pa.array(np.frombuffer(data.as_buffer()))
                    starts = pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32))
                    yield own.append_column(column, pa.ListArray.from_arrays(starts, flat))

        schema = rows.withColumn(column, F.lit(None).cast("array<double>")).schema
        return scored.select("held", "sums").mapInArrow(unpack, schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        count = self.getNumTrees
        own = f"{self.uid}_p"
        scored = self.scores(dataset, [(count, self.getOrDefault("maxDepth"))], own)
        p = F.col(own)[0]
        return scored.withColumns({
            self.getOrDefault("rawPredictionCol"): array_to_vector(F.array(count * (1 - p), count * p)),
            self.getOrDefault("probabilityCol"): array_to_vector(F.array(1 - p, p)),
            self.getOrDefault("predictionCol"): (p > 0.5).cast("double"),
        }).drop(own)

    def write(self) -> _ForestWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> _ForestReader:
        return _ForestReader(cls)


class _ForestWriter(DefaultParamsWriter):
    def __init__(self, instance: ForestModel):
        super().__init__(instance)
        self.forest = instance

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.forest.trees().write.parquet(f"{path}/trees")


class _ForestReader(DefaultParamsReader):
    def load(self, path: str) -> ForestModel:
        return super().load(path)._set(table=f"{path}/trees")
