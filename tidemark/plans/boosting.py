"""Boosted trees of second order, grown by level or by leaf, many models in one pass.

A tree step needs sums of gradients and curvatures per leaf, feature and bin. Every task sums
its own rows, the sums are added up, and the driver, which holds no rows, chooses the splits.
A leaf's value is -G / (H + l2) times the step size, and a split's gain the rise of
G^2 / (H + l2) over both sides. Of two sister leaves only the one with fewer rows is summed, the
other is their parent's rest. ``level`` growth splits every leaf that gains, down to the
depth; ``leaf`` growth takes the leaf of the largest gain first, up to ``maxLeaves``.

A model whose rows fit into a task is grown there from its first tree to its last: its task is
sent the binned rows once, and the rows of each node are kept by place, so a leaf costs its own
rows only. Models of a search are as many tasks. Larger tables are summed by all tasks instead, a
pass per level.

In passes models advance together: a pass serves the open leaves of all of them, whichever tree each is
at. So the folds and parameter maps of a search cost the passes of one fit. Rows are binned
once and written. Every ADVANCE passes the margins reached are kept in memory; every PASSES
passes they are written, which keeps lineage short and survives lost executors.

Weights multiply gradient and curvature. Rows and columns are drawn once per tree, rows by
block, so a model depends on how its rows were cut into blocks. Vectors may be sparse: only
entries that are not zero are held and summed, and the zeros of a feature are the leaf's rest.
Without rows, or without a gain, a model is its base margin.
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, keyword_only
from pyspark.core.broadcast import Broadcast
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import name
from tidemark.session import path_exists, work_path

LEVEL, LEAF = "level", "leaf"

# Rows of a block; a task holds one at a time.
BLOCK_ROWS = 16_384
# Rows that are worth a task of their own, and rows that a task should not exceed.
TASK_ROWS, MOST_TASK_ROWS = 1_024, 1_000_000
# Places per row and feature that an entry by cell is worth.
DENSE = 8
# Features of two bins that are one number.
CODED = 9
# Passes between two advances of the margins, which are kept in memory.
ADVANCE = 4
# Passes between two writes of the margins.
PASSES = 48
# Sums of one pass: leaves times cells, over all models; more leaves wait for the next pass.
CELLS_PER_PASS = 2_000_000
# Tasks whose sums the driver adds itself; more are added up in between.
TASKS_ADDED = 64

# Rows times features of a group that a task holds whole, and passes that are not worth sending it.
WHOLE_CELLS, FEW_PASSES = 100_000_000, 64
# Rows of a leaf that are summed at once.
SUMMED_AT_ONCE = 131_072

# A gain below this is none.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    """What a model is grown by."""

    steps: int = 300
    depth: int = 4
    step_size: float = 0.1
    row_rate: float = 0.9
    column_rate: float = 0.9
    l2: float = 1.0
    least_curvature: float = 1.0
    least_rows: int = 1
    bins: int = 256
    leaves: int = 0
    from_mean: bool = False
    seed: int = 42


@dataclass
class Layout:
    """Where the bins of a group's features lie among its cells."""

    size: int
    # Upper ends of the bins of each feature but the last, ascending.
    ends: list[np.ndarray]
    base: float = 0.0
    # Rows of the group, and their entries that are not zero.
    rows: int = 0
    entries: int = 0

    def __post_init__(self) -> None:
        self.start = np.r_[0, np.cumsum([len(e) + 1 for e in self.ends])].astype(np.int64)
        self.zero = np.array([np.searchsorted(e, 0.0) for e in self.ends], np.int64)
        self.feature = np.repeat(np.arange(self.size), np.diff(self.start))
        self.last = np.zeros(self.cells, bool)
        self.last[self.start[1:] - 1] = True
        # Features of two bins, and of more; where each lies among its kind; the cells off the zero's bin of the former.
        self.bins = np.diff(self.start)
        self.two, self.more = np.flatnonzero(self.bins == 2), np.flatnonzero(self.bins > 2)
        self.row = np.zeros(self.size, np.int64)
        self.row[self.two], self.row[self.more] = np.arange(len(self.two)), np.arange(len(self.more))
        self.off = self.start[self.two] + 1 - self.zero[self.two]

    @property
    def cells(self) -> int:
        return int(self.start[-1])

    def cells_of(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        cells = np.empty(len(index), np.int32)
        order = np.argsort(index, kind="stable")
        cuts = np.flatnonzero(np.diff(index[order])) + 1
        for at in np.split(order, cuts) if len(index) else ():
            f = int(index[at[0]])
            cells[at] = self.start[f] + np.searchsorted(self.ends[f], value[at])
        return cells


@dataclass
class Leaf:
    """A node of the tree under growth."""

    depth: int
    total: np.ndarray
    sums: np.ndarray | None = None
    gain: float = 0.0
    cell: int = -1
    sides: tuple[np.ndarray, np.ndarray] | None = None
    children: tuple[int, int] | None = None
    asked: bool = False
    tried: bool = False


@dataclass
class Tree:
    """Nodes in order, parents first; a leaf has no feature (-1)."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)

    def add(self, value: float, rows: float) -> int:
        for column, x in zip(vars(self).values(), (-1, -1, -1, -1, value, 0.0, rows), strict=True):
            column.append(x)
        return len(self.feature) - 1


class Growth:
    """One model: its finished trees and the tree under growth."""

    def __init__(self, group: int, settings: Settings, layout: Layout):
        self.group, self.settings, self.layout = group, settings, layout
        self.trees: list[Tree] = []
        self.written = 0
        self.done = not layout.size
        self.begin()

    def begin(self) -> None:
        """Open the next tree with its root and its columns."""
        s = self.settings
        if len(self.trees) >= s.steps:
            self.done = True
            return
        chosen = np.random.default_rng([s.seed, len(self.trees)]).permutation(self.layout.size)
        self.columns = np.zeros(self.layout.size, bool)
        self.columns[chosen[: max(1, math.ceil(s.column_rate * self.layout.size))]] = True
        self.nodes = [Leaf(0, np.zeros(3))]
        self.asked = [0]

    def _split(self, leaf: Leaf) -> None:
        """The best split of a leaf whose sums are known, the first among equals."""
        layout, s = self.layout, self.settings
        sums = leaf.sums.copy()
        held = np.add.reduceat(sums, layout.start[:-1])
        sums[layout.start[:-1] + layout.zero] += leaf.total - held
        run = np.cumsum(sums, axis=0)
        before = np.r_[np.zeros((1, 3)), run][layout.start[:-1]]
        left = run - before[layout.feature]
        right = leaf.total - left
        score = lambda x: x[..., 0] ** 2 / np.maximum(x[..., 1] + s.l2, 1e-16)
        gain = score(left) + score(right) - score(leaf.total)
        allowed = ~layout.last & self.columns[layout.feature]
        for side in (left, right):
            # Counts are whole, but sums of curvatures come from subtractions.
            allowed &= (side[:, 1] >= s.least_curvature - 1e-9) & (side[:, 2] >= max(1, s.least_rows) - 0.5)
        gain = np.where(allowed, gain, -np.inf)
        # Equal gains differ in their last digits, by the order of the sums.
        best = int(np.argmax(gain >= gain.max() * (1 - 1e-9)))
        if gain[best] > LEAST_GAIN:
            leaf.gain, leaf.cell, leaf.sides = float(gain[best]), best, (left[best], right[best])

    def _plan(self) -> tuple[list[int], list[int]]:
        """The splits to make as far as known, by largest gain, and the leaves to be summed next."""
        limit = self.settings.leaves or 2**self.settings.depth
        splits, waiting, unknown = [], [], []

        def offer(i: int) -> None:
            leaf = self.nodes[i]
            if leaf.depth >= self.settings.depth:
                return
            if leaf.sums is None:
                unknown.append(i)
            elif leaf.cell >= 0:
                heapq.heappush(waiting, (-leaf.gain, i))

        offer(0)
        while waiting and len(splits) + 1 < limit:
            i = heapq.heappop(waiting)[1]
            leaf = self.nodes[i]
            splits.append(i)
            if leaf.children is None:
                leaf.children = (len(self.nodes), len(self.nodes) + 1)
                self.nodes += [Leaf(leaf.depth + 1, side) for side in leaf.sides]
            # The children of the last split stay leaves; sums that are missing before it could change it.
            if len(splits) + 1 < limit:
                for child in leaf.children:
                    offer(child)
        return splits, unknown

    def receive(self, sums: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Take the sums of the asked leaves, and go on to the next leaves or the next tree."""
        for i, (cells, total) in sums.items():
            self.nodes[i].sums = cells
            if i == 0:
                self.nodes[0].total = total
        for leaf in list(self.nodes):
            if leaf.children and leaf.sums is not None:
                a, b = (self.nodes[c] for c in leaf.children)
                for own, other in ((a, b), (b, a)):
                    if own.sums is None and other.sums is not None and own.asked:
                        own.sums = leaf.sums - other.sums
        for leaf in self.nodes:
            if leaf.sums is not None and not leaf.tried and leaf.depth < self.settings.depth:
                leaf.tried = True
                self._split(leaf)
        splits, unknown = self._plan()
        if not unknown:
            self.splits = splits
            self.trees.append(self._finished(splits))
            self.begin()
            return
        # Of two sisters the smaller is asked for, the other follows.
        self.asked = []
        for i in unknown:
            self.nodes[i].asked = True
        for leaf in self.nodes:
            if leaf.children and any(c in unknown for c in leaf.children):
                self.asked.append(min(leaf.children, key=lambda c: self.nodes[c].total[2]))

    def value(self, total: np.ndarray) -> float:
        s = self.settings
        return float(-total[0] / (total[1] + s.l2) * s.step_size) if total[1] + s.l2 > 0 else 0.0

    def _finished(self, splits: Sequence[int]) -> Tree:
        tree, made = Tree(), set(splits)

        def copy(i: int) -> int:
            leaf = self.nodes[i]
            own = tree.add(self.value(leaf.total), float(leaf.total[2]))
            if i in made:
                f = int(self.layout.feature[leaf.cell])
                tree.feature[own], tree.bin[own] = f, int(leaf.cell - self.layout.start[f])
                tree.gain[own] = leaf.gain
                tree.left[own], tree.right[own] = (copy(c) for c in leaf.children)
            return own

        copy(0)
        return tree

    def partial(self) -> Tree:
        """The tree under growth, with the node numbers of ``nodes``."""
        tree = Tree()
        for leaf in self.nodes:
            tree.add(0.0, 0.0)
        for i, leaf in enumerate(self.nodes):
            if leaf.children:
                f = int(self.layout.feature[leaf.cell])
                tree.feature[i], tree.bin[i] = f, int(leaf.cell - self.layout.start[f])
                tree.left[i], tree.right[i] = leaf.children
        return tree

    def ensemble(self) -> dict:
        """The model as plain lists, with the upper end of the left bin as threshold."""
        ends = self.layout.ends
        trees = [
            {
                "feature": t.feature,
                "threshold": [float(ends[f][b]) if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin, strict=True)],
                "left": t.left, "right": t.right, "value": t.value, "gain": t.gain, "rows": t.rows,
            }
            for t in self.trees
        ]
        return {"base": self.layout.base if self.settings.from_mean else 0.0, "size": self.layout.size, "trees": trees}


def drawn_rows(settings: Settings, tree: int, block: int, rows: int) -> np.ndarray:
    """Which rows of a block a tree learns from."""
    if settings.row_rate >= 1:
        return np.ones(rows, bool)
    return np.random.default_rng([settings.seed, tree, block, 1]).random(rows) < settings.row_rate


class Block:
    """Some rows of one group: label, weight, bins, margins by model.

    Where most features are zero in most rows, only the entries that are not zero are held, by
    cell. Elsewhere every row has its bin of each feature. Of a feature of two bins it has a bit,
    set off the zero's bin, and CODED bits are one number: rows are summed by that number,
    and the few sums by bit.
    """

    def __init__(self, layout: Layout, group: int, number: int, y: np.ndarray, w: np.ndarray, rows: np.ndarray, cells: np.ndarray):
        self.group, self.number, self.y, self.w = group, number, y, w
        self.margins: dict[int, np.ndarray] = {}
        self.dense = layout.size * len(y) <= DENSE * len(cells)
        order = np.argsort(cells, kind="stable")
        self.rows, self.cells = rows[order], cells[order]
        if self.dense:
            self.codes, self.many = self._by_row(layout)
            self.rows = self.cells = None

    def _by_row(self, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        codes = np.zeros((-(-len(layout.two) // CODED), len(self.y)), np.uint16)
        many = np.empty((len(layout.more), len(self.y)), np.uint16 if layout.cells < 65_536 else np.int32)
        for k, f in enumerate(layout.two):
            bit = (self._sparse_bins(layout, f) != layout.zero[f]).astype(np.uint16)
            codes[k // CODED] |= bit << np.uint16(k % CODED)
        for k, f in enumerate(layout.more):
            many[k] = self._sparse_bins(layout, f)
        return codes, many

    def columns(self, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the features of two bins, and the bins of the others, by row."""
        return (self.codes, self.many) if self.dense else self._by_row(layout)

    def _sparse_bins(self, layout: Layout, f: int) -> np.ndarray:
        own = np.full(len(self.y), layout.zero[f])
        first, last = np.searchsorted(self.cells, layout.start[f : f + 2])
        own[self.rows[first:last]] = self.cells[first:last] - layout.start[f]
        return own

    def below(self, layout: Layout, f: int, end: int, known: dict[int, np.ndarray]) -> np.ndarray:
        """Which rows lie in a bin of a feature, or left of it."""
        if not self.dense:
            if f not in known:
                known[f] = self._sparse_bins(layout, f)
            return known[f] <= end
        k = layout.row[f]
        if layout.bins[f] > 2:
            return self.many[k] <= end
        # A split lies between the two bins, one of which is the zero's.
        bit = self.codes[k // CODED] & np.uint16(1 << (k % CODED))
        return bit != 0 if layout.zero[f] else bit == 0

    def chosen(self, layout: Layout, tree: Tree, values: Sequence, known: dict[int, np.ndarray]) -> np.ndarray:
        """The value of each row's leaf, of one value per node."""
        found: dict[int, object] = {}
        reached, at = [], [0]
        while at:
            i = at.pop()
            reached.append(i)
            if tree.feature[i] >= 0:
                at += (tree.left[i], tree.right[i])
        # Parents come before their children, so children are known first.
        for i in reached[::-1]:
            if tree.feature[i] < 0:
                found[i] = values[i]
                continue
            left, right = found.pop(tree.left[i]), found.pop(tree.right[i])
            if np.isscalar(left) and np.isscalar(right) and left == right:
                found[i] = left
            else:
                found[i] = np.where(self.below(layout, tree.feature[i], tree.bin[i], known), left, right)
        return np.broadcast_to(found[0], len(self.y))

    def margin(self, model: int, base: float, layout: Layout, trees: Sequence[Tree], known: dict) -> np.ndarray:
        margin = self.margins.get(model)
        margin = np.full(len(self.y), base) if margin is None else margin
        for tree in trees:
            margin = margin + self.chosen(layout, tree, tree.value, known)
        return margin

    def drawn(self, settings: Settings, tree: int) -> np.ndarray:
        return drawn_rows(settings, tree, self.number, len(self.y))

    def sums(
        self, layout: Layout, slot: np.ndarray, slots: int, gradient: np.ndarray, curvature: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradient, curvature and rows by slot and cell, and by slot; slot -1 is left out."""
        held = np.flatnonzero(slot >= 0)
        own = slot[held]
        parts = (gradient[held], curvature[held], None)

        def summed_by(cell: np.ndarray, width: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
            found = [np.bincount(cell, x if x is None else x[at], slots * width) for x in parts]
            return np.stack(found, -1).reshape(slots, width, 3)

        out = np.zeros((slots, layout.cells, 3))
        if self.dense:
            for k, f in enumerate(layout.more):
                width = int(layout.bins[f])
                out[:, layout.start[f] : layout.start[f + 1]] = summed_by(own * width + self.many[k][held], width)
            for k, code in enumerate(self.codes):
                off = layout.off[k * CODED : (k + 1) * CODED]
                width = 1 << len(off)
                found = summed_by(own * width + code[held], width)
                for bit, cell in enumerate(off):
                    out[:, cell] = found.reshape(slots, -1, 2, 1 << bit, 3)[:, :, 1].sum(axis=(1, 2))
        else:
            place = np.full(len(slot), -1)
            place[held] = np.arange(len(held))
            entry = place[self.rows]
            at = np.flatnonzero(entry >= 0)
            entry = entry[at]
            out = summed_by(own[entry] * layout.cells + self.cells[at], layout.cells, entry)
        return out, summed_by(own, 1)[:, 0]


class Table:
    """All rows of a group in one task, and the growth of a model on them."""

    def __init__(self, layout: Layout, blocks: list[Block]):
        # Draws hang on the block, sums must not hang on which block came first.
        blocks.sort(key=lambda b: b.number)
        self.layout = layout
        self.numbers = [(b.number, len(b.y)) for b in blocks]
        self.y, self.w = (np.concatenate([getattr(b, c) for b in blocks]) for c in ("y", "w"))
        columns = [b.columns(layout) for b in blocks]
        blocks.clear()
        self.codes, self.many = (np.concatenate(c, axis=1) for c in zip(*columns, strict=True))
        # Which numbers have a bit.
        self.bits = (np.arange(1 << CODED) >> np.arange(CODED)[:, None] & 1).astype(float)

    def sums(self, at: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradient, curvature and rows by cell, and of all, of the rows ``at``."""
        layout = self.layout
        out, total = np.zeros((layout.cells, 3)), np.zeros(3)
        coded = [np.zeros((1 << len(layout.off[k * CODED : (k + 1) * CODED]), 3)) for k in range(len(self.codes))]
        for first in range(0, len(at), SUMMED_AT_ONCE):
            own = at[first : first + SUMMED_AT_ONCE]
            g, h = gradient[own], curvature[own]
            total += (g.sum(), h.sum(), len(own))
            for k, f in enumerate(layout.more):
                self._add(out[layout.start[f] : layout.start[f + 1]], self.many[k][own], g, h)
            for k, code in enumerate(self.codes):
                self._add(coded[k], code[own], g, h)
        for k, found in enumerate(coded):
            off = layout.off[k * CODED : (k + 1) * CODED]
            out[off] = self.bits[: len(off), : len(found)] @ found
        return out, total

    @staticmethod
    def _add(into: np.ndarray, cell: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        cell = cell.astype(np.intp)
        for column, x in enumerate((g, h, None)):
            into[:, column] += np.bincount(cell, x, len(into))

    def below(self, cell: int, at: np.ndarray) -> np.ndarray:
        """Which of the rows ``at`` lie in a cell's bin, or left of it."""
        layout = self.layout
        f = int(layout.feature[cell])
        k = layout.row[f]
        if layout.bins[f] > 2:
            return self.many[k][at] <= cell - layout.start[f]
        bit = self.codes[k // CODED][at] & np.uint16(1 << (k % CODED))
        return bit != 0 if layout.zero[f] else bit == 0

    def drawn(self, settings: Settings, tree: int) -> np.ndarray:
        return np.concatenate([drawn_rows(settings, tree, number, rows) for number, rows in self.numbers])

    def grow(self, model: Growth, base: float) -> None:
        """Grow a model to its end."""
        margin = np.full(len(self.y), base)
        while not model.done:
            p = 1 / (1 + np.exp(-margin))
            gradient, curvature = self.w * (p - self.y), self.w * p * (1 - p)
            drawn = self.drawn(model.settings, len(model.trees))
            # The tree's nodes, and the places of their rows by node, parents first.
            nodes, made = model.nodes, len(model.trees)
            places = {0: np.flatnonzero(drawn).astype(np.int32)}
            while len(model.trees) == made:
                for i, leaf in enumerate(nodes):
                    if leaf.children and leaf.children[0] not in places:
                        places.update(self._sides(leaf, places[i]))
                model.receive({i: self.sums(places[i], gradient, curvature) for i in model.asked})
            splits = set(model.splits)
            # Rows that were not drawn are led down; the others wait in their nodes.
            reached = [(0, np.flatnonzero(~drawn).astype(np.int32))]
            while reached:
                i, at = reached.pop()
                leaf = nodes[i]
                if i not in splits:
                    for own in (at, places[i]):
                        margin[own] += model.value(leaf.total)
                    continue
                if leaf.children[0] not in places:
                    places.update(self._sides(leaf, places[i]))
                reached += self._sides(leaf, at).items()

    def _sides(self, leaf: Leaf, at: np.ndarray) -> dict[int, np.ndarray]:
        """The rows of a split node by child."""
        low = self.below(leaf.cell, at)
        return {c: at[np.flatnonzero(side)] for c, side in zip(leaf.children, (low, ~low), strict=True)}


@dataclass
class Order:
    """What a pass asks of one model: sums of some leaves of its tree under growth."""

    model: int
    group: int
    settings: Settings
    base: float
    trees: list[Tree]
    tree: Tree
    number: int
    asked: list[int]


def summed(blocks: Iterator[Block], orders: Sequence[Order], layouts: Mapping[int, Layout]) -> dict[int, tuple]:
    """Per model (sums by leaf and cell, totals by leaf) of gradient, curvature and rows."""
    out: dict[int, tuple] = {}
    for block in blocks:
        layout, known = layouts[block.group], {}
        for o in orders:
            if o.group != block.group:
                continue
            margin = block.margin(o.model, o.base, layout, o.trees, known)
            p = 1 / (1 + np.exp(-margin))
            slot_of = [-1] * len(o.tree.feature)
            for j, i in enumerate(o.asked):
                slot_of[i] = j
            slot = np.where(block.drawn(o.settings, o.number), block.chosen(layout, o.tree, slot_of, known), -1)
            sums, totals = block.sums(layout, slot, len(o.asked), block.w * (p - block.y), block.w * p * (1 - p))
            if o.model in out:
                sums, totals = out[o.model][0] + sums, out[o.model][1] + totals
            out[o.model] = (sums, totals)
    return out


def added(parts: Iterator[dict[int, tuple]]) -> dict[int, tuple]:
    out: dict[int, tuple] = {}
    for part in parts:
        for model, (sums, totals) in part.items():
            if model in out:
                sums, totals = out[model][0] + sums, out[model][1] + totals
            out[model] = (sums, totals)
    return out


def fits_task(layout: Layout) -> bool:
    """Whether a task can hold a group's rows, by row and not by entry."""
    cells = layout.rows * layout.size
    return cells <= WHOLE_CELLS and cells <= DENSE * layout.entries


def _grown_whole(held: RDD, models: Sequence[Growth], base: Sequence[float], shared: Broadcast) -> None:
    """Grow each model in a task of its own, which is sent the rows of its group."""
    growing = [i for i, m in enumerate(models) if not m.done]
    # The longest begin first.
    growing.sort(key=lambda i: -models[i].settings.steps * models[i].settings.depth)
    asked = [(models[i].group, models[i].settings, base[i]) for i in growing]

    def grow(task: int, sent: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, list[Tree]]]:
        group, settings, start = asked[task]
        layout = shared.value[group]
        model = Growth(group, settings, layout)
        Table(layout, [block for _, block in sent]).grow(model, start)
        yield growing[task], model.trees

    sent = held.flatMap(lambda block: [(t, block) for t, (group, _, _) in enumerate(asked) if group == block.group])
    for i, trees in sent.partitionBy(max(1, len(growing)), int).mapPartitionsWithIndex(grow).collect():
        models[i].trees, models[i].done = trees, True


def _entries(rows: DataFrame, features: str) -> DataFrame:
    """Adds size, index and value of the vector's entries; zeros of a dense one are left out."""
    parts = rows.withColumn("_v", F.unwrap_udt(features))
    dense = F.arrays_zip(F.sequence(F.lit(0), F.size("_v.values") - 1).alias("i"), F.col("_v.values").alias("x"))
    sparse = F.arrays_zip(F.col("_v.indices").alias("i"), F.col("_v.values").alias("x"))
    pairs = F.when(F.size("_v.values") == 0, F.array().cast("array<struct<i:int,x:double>>"))
    pairs = pairs.when(F.col("_v.type") == 0, sparse).otherwise(dense)
    size = F.coalesce("_v.size", F.size("_v.values"))
    entries = F.filter(pairs, lambda e: e["x"] != 0)
    return parts.withColumns({"_size": size, "_entries": entries}).drop("_v")


def layouts_of(rows: DataFrame, label: str, weight: str, bins: int) -> tuple[dict[int, Layout], int]:
    """Bins of each group's features, from quantiles of the entries, and the number of rows."""
    totals = rows.groupBy("_group").agg(
        F.max("_size").alias("size"), F.count("*").alias("n"), F.sum(weight).alias("w"),
        F.sum(F.col(weight) * F.col(label)).alias("positive"),
    ).collect()
    probabilities = [i / bins for i in range(1, bins)]
    entry = rows.select("_group", F.explode("_entries").alias("e"))
    found = entry.groupBy("_group", F.col("e.i").alias("i")).agg(
        F.percentile_approx("e.x", probabilities, 10_000).alias("q"), F.min("e.x").alias("low"),
        F.max("e.x").alias("high"), F.count("*").alias("n"),
    )
    sizes, entries = {r["_group"]: r["n"] for r in totals}, dict.fromkeys((r["_group"] for r in totals), 0)
    ends: dict[int, dict[int, np.ndarray]] = {g: {} for g in sizes}
    # One row per group and feature, as many as the model has.
    for r in found.collect():
        entries[r["_group"]] += r["n"]
        cuts = {*r["q"], r["low"]}
        if r["n"] < sizes[r["_group"]]:
            # Zeros have a bin of their own side: at most 0 on its left, the next entry on its right.
            cuts.add(0.0)
            if r["high"] < 0:
                cuts.add(r["high"])
        high = max(r["high"], 0.0) if r["n"] < sizes[r["_group"]] else r["high"]
        ends[r["_group"]][r["i"]] = np.array(sorted(c for c in cuts if c < high))
    layouts = {}
    for r in totals:
        share = r["positive"] / r["w"] if r["w"] else 0.5
        base = math.log(share / (1 - share)) if 0 < share < 1 else 0.0
        own = [ends[r["_group"]].get(i, np.zeros(0)) for i in range(r["size"])]
        layouts[r["_group"]] = Layout(r["size"], own, base, r["n"], entries[r["_group"]])
    return layouts, sum(sizes.values())


def _blocks(rows: DataFrame, label: str, weight: str, layouts: Mapping[int, Layout]) -> DataFrame:
    """Pickled blocks, numbered by task and place."""
    columns = rows.select(
        "_group", F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"),
        F.col("_entries.i").alias("i"), F.col("_entries.x").alias("x"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            groups = batch.column("_group").to_numpy()
            for group in np.unique(groups):
                at = np.flatnonzero(groups == group)
                for start in range(0, len(at), BLOCK_ROWS):
                    own = batch.take(pa.array(at[start : start + BLOCK_ROWS]))
                    index = own.column("i")
                    lengths = index.value_lengths().to_numpy()
                    flat = index.flatten().to_numpy().astype(np.int64)
                    cells = layouts[int(group)].cells_of(flat, own.column("x").flatten().to_numpy())
                    place = np.repeat(np.arange(len(own)), lengths).astype(np.int32)
                    y, w = (own.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
                    block = Block(layouts[int(group)], int(group), task * 1_000_003 + made, np.array(y), np.array(w), place, cells)
                    made += 1
                    data = pa.array([pickle.dumps(block, protocol=5)], pa.binary())
                    yield pa.RecordBatch.from_arrays([data], names=["block"])

    return columns.mapInArrow(cut, "block binary")


def boost(
    rows: DataFrame,
    runs: Sequence[tuple[int, Settings]],
    *,
    features: str = "features",
    label: str = "y",
    weight: str = "weight",
    group: str | None = None,
) -> list[dict]:
    """Fit a model per (group, settings), together, and return them as plain lists.

    ``group`` is a whole-numbered column: a model learns from the rows of its group.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    dealt = rows.withColumn("_group", F.col(group).cast("int") if group else F.lit(0))
    # Bins are those of the finest model.
    dealt = _entries(dealt, features)
    layouts, total = layouts_of(dealt, label, weight, max((s.bins for _, s in runs), default=2))
    models = [Growth(g, s, layouts.get(g, Layout(0, []))) for g, s in runs]
    # Bins go to each executor once.
    shared = context.broadcast(layouts)
    paths = []

    def write(data):
        paths.append(work_path(spark, "blocks"))
        data.saveAsPickleFile(paths[-1])
        # Kept in memory as far as it goes; what is lost is read again.
        return context.pickleFile(paths[-1]).persist(StorageLevel.MEMORY_AND_DISK)

    cut = _blocks(dealt, label, weight, layouts).rdd.map(lambda r: pickle.loads(r[0]))
    # Each pass pays for its tasks, so there are no more than the cores need.
    tasks = max(2 * context.defaultParallelism, -(-total // MOST_TASK_ROWS))
    held = write(cut.coalesce(max(1, min(cut.getNumPartitions(), -(-total // TASK_ROWS), tasks))))
    base = [m.layout.base if m.settings.from_mean else 0.0 for m in models]
    open_groups = {m.group for m in models if not m.done}
    if max((s.steps * s.depth for _, s in runs), default=0) > FEW_PASSES and all(fits_task(layouts[g]) for g in open_groups):
        _grown_whole(held, models, base, shared)
    passes, former = 0, None
    while any(not m.done for m in models):
        orders, room = [], CELLS_PER_PASS
        for i, m in enumerate(models):
            cost = 0 if m.done else len(m.asked) * m.layout.cells
            if m.done or (orders and cost > room):
                continue
            room -= cost
            trees = m.trees[m.written :]
            orders.append(Order(i, m.group, m.settings, base[i], trees, m.partial(), len(m.trees), m.asked))
        parts = held.mapPartitions(lambda blocks, orders=orders: [summed(blocks, orders, shared.value)])
        if parts.getNumPartitions() > TASKS_ADDED:
            between = math.isqrt(parts.getNumPartitions())
            parts = parts.coalesce(between, shuffle=True).mapPartitions(lambda own: [added(own)])
        sums = added(parts.toLocalIterator() if parts.getNumPartitions() > TASKS_ADDED else parts.collect())
        for o in orders:
            cells, totals = sums.get(o.model, (np.zeros((len(o.asked), models[o.model].layout.cells, 3)), np.zeros((len(o.asked), 3))))
            models[o.model].receive({leaf: (cells[j], totals[j]) for j, leaf in enumerate(o.asked)})
        passes += 1
        if former is not None:
            former.unpersist()
            former = None
        write_now = passes % PASSES == 0
        if (write_now or passes % ADVANCE == 0) and any(not m.done for m in models):
            reached = [(i, m.group, base[i], m.trees[m.written :]) for i, m in enumerate(models) if not m.done]

            def advance(block: Block, reached=reached) -> Block:
                known: dict[int, np.ndarray] = {}
                layout = shared.value[block.group]
                block.margins = {
                    i: block.margin(i, base_i, layout, trees, known) for i, g, base_i, trees in reached if g == block.group
                }
                return block

            ahead = held.map(advance)
            if write_now:
                ahead = write(ahead)
                held.unpersist()
                _remove(spark, paths.pop(0))
                held = ahead
            else:
                # The next pass computes it from the one before.
                former, held = held, ahead.persist(StorageLevel.MEMORY_AND_DISK)
            for m in models:
                m.written = len(m.trees)
    if former is not None:
        former.unpersist()
    held.unpersist()
    shared.destroy()
    for path in paths:
        _remove(spark, path)
    return [m.ensemble() for m in models]


def _remove(spark, path: str) -> None:
    if path_exists(spark, path):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class _BoosterParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probabilities of both classes", TypeConverters.toString)
    rawPredictionCol = Param(Params._dummy(), "rawPredictionCol", "margins of both classes", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "class", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "factor of leaf values", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "rows drawn per tree", TypeConverters.toFloat)
    columnRate = Param(Params._dummy(), "columnRate", "columns drawn per tree", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "penalty of leaf values", TypeConverters.toFloat)
    minCurvature = Param(Params._dummy(), "minCurvature", "least curvature of a leaf", TypeConverters.toFloat)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a leaf", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    growth = Param(Params._dummy(), "growth", "level or leaf", TypeConverters.toString)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "leaves of a tree grown by leaf", TypeConverters.toInt)
    startFromMean = Param(Params._dummy(), "startFromMean", "begin with the log-odds of the rows", TypeConverters.toBoolean)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(
            featuresCol="features", probabilityCol="probability", rawPredictionCol="rawPrediction", predictionCol="prediction",
            maxIter=300, maxDepth=4, stepSize=0.1, subsamplingRate=0.9, columnRate=0.9, l2=1.0, minCurvature=1.0,
            minInstancesPerNode=1, maxBins=256, growth=LEVEL, maxLeaves=31, startFromMean=False, seed=42,
        )


class HistogramBooster(Estimator, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees of second order for labels 0 and 1; see the module."""

    labelCol = Param(Params._dummy(), "labelCol", "label 0 or 1", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight of a row", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, labelCol="y", weightCol="weight", maxIter=300, maxDepth=4, stepSize=0.1, subsamplingRate=0.9, columnRate=0.9,
        l2=1.0, minCurvature=1.0, minInstancesPerNode=1, maxBins=256, growth=LEVEL, maxLeaves=31, startFromMean=False, seed=42,
    ):
        super().__init__()
        self._defaults()
        self._setDefault(labelCol="y", weightCol="weight")
        self._set(**self._input_kwargs)
        if self.getOrDefault("growth") not in (LEVEL, LEAF):
            raise ValueError(f"Growth is {LEVEL} or {LEAF}, not {growth}")

    def settings(self, params: Mapping[Param, object] | None = None, steps: int | None = None) -> Settings:
        own = self.copy(dict(params or {}))
        get = own.getOrDefault
        return Settings(
            steps or get("maxIter"), get("maxDepth"), get("stepSize"), get("subsamplingRate"), get("columnRate"), get("l2"),
            get("minCurvature"), get("minInstancesPerNode"), get("maxBins"),
            get("maxLeaves") if get("growth") == LEAF else 0, get("startFromMean"), get("seed"),
        )

    def fit_groups(self, rows: DataFrame, asked: Sequence[tuple[int, Mapping]], group: str | None = None) -> list[BoostedModel]:
        """A model per (group, parameter map). Maps that differ in the number of trees share a fit.

        The first trees of a longer model are those of a shorter one.
        """
        longest: dict[tuple[int, Settings], int] = {}
        keys = []
        for g, params in asked:
            settings = self.settings(params)
            key = (g, self.settings(params, steps=1))
            longest[key] = max(longest.get(key, 0), settings.steps)
            keys.append((key, settings.steps))
        runs = [(g, self.settings_of(s, n)) for (g, s), n in longest.items()]
        options = {"label": self.getOrDefault("labelCol"), "weight": self.getOrDefault("weightCol")}
        fitted = boost(rows, runs, features=self.getOrDefault("featuresCol"), group=group, **options)
        found = dict(zip(longest, fitted, strict=True))
        models = []
        for (key, steps), (_, params) in zip(keys, asked, strict=True):
            model = BoostedModel()
            self.copy(dict(params))._copyValues(model)
            whole = found[key]
            models.append(model._set(ensemble=json.dumps({**whole, "trees": whole["trees"][:steps]})))
        return models

    @staticmethod
    def settings_of(settings: Settings, steps: int) -> Settings:
        return Settings(**{**vars(settings), "steps": steps})

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        return self.fit_groups(dataset, [(0, {})])[0]


class BoostedModel(Model, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted :class:`HistogramBooster`; its trees are one JSON text, so it saves like any stage."""

    ensemble = Param(Params._dummy(), "ensemble", "base margin and trees as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._defaults()

    @property
    def state(self) -> dict:
        return json.loads(self.getOrDefault("ensemble"))

    @property
    def featureImportances(self) -> DenseVector:
        """Gain by feature, as a share of all gain."""
        state = self.state
        gains = np.zeros(state["size"])
        for t in state["trees"]:
            for f, gain in zip(t["feature"], t["gain"], strict=True):
                if f >= 0:
                    gains[f] += gain
        return Vectors.dense(gains / gains.sum() if gains.any() else gains)

    def prefix(self, steps: int) -> BoostedModel:
        """The model of the first trees."""
        state = self.state
        return self.copy()._set(ensemble=json.dumps({**state, "trees": state["trees"][:steps]}))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.state
        used = sorted({f for t in state["trees"] for f in t["feature"] if f >= 0})
        place = {f: i for i, f in enumerate(used)}
        trees = [
            (np.array([place.get(f, -1) for f in t["feature"]]), *(np.array(t[c]) for c in ("threshold", "left", "right", "value")))
            for t in state["trees"]
        ]
        base = state["base"]
        margin = F.lit(base)
        dense, total = f"{self.uid}_dense", f"{self.uid}_margin"
        if used:
            # Only the columns that a split asks for are sent.
            wanted = F.transform(F.lit(used), lambda i: F.get(F.col(dense), i))

            @F.pandas_udf("double")
            def margins(columns: pd.Series) -> pd.Series:
                x = np.stack(columns.to_numpy()) if len(columns) else np.zeros((0, len(used)))
                return pd.Series(base + margin_of(trees, x))

            dataset = dataset.withColumn(dense, vector_to_array(name(self.getOrDefault("featuresCol"))))
            margin = margins(wanted)
        scored = dataset.withColumn(total, margin).drop(dense)
        p = 1 / (1 + F.exp(-F.col(total)))
        return scored.withColumns({
            self.getOrDefault("rawPredictionCol"): array_to_vector(F.array(-F.col(total), F.col(total))),
            self.getOrDefault("probabilityCol"): array_to_vector(F.array(1 - p, p)),
            self.getOrDefault("predictionCol"): (F.col(total) > 0).cast("double"),
        }).drop(total)


def margin_of(trees: Sequence[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    """Sum of the leaf values of each row of a dense matrix."""
    total, every = np.zeros(len(x)), np.arange(len(x))
    for feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                break
            go_left = x[every, np.maximum(feature[at], 0)] <= threshold[at]
            at = np.where(inner, np.where(go_left, left[at], right[at]), at)
        total += value[at]
    return total
