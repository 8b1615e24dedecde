"""Forests and boosted trees from histograms of rows that are binned once.

Rows become blocks of bin numbers, one code of two bytes for a pair of features.
A level of all trees is one scan: each task walks its blocks down a tree at a time
and sums its rows per node, feature and bin; Spark adds the sums up per tree and the
best split of each node reaches the driver.  Boosting keeps the sum of the earlier
trees beside the rows.

A walk looks up, per pair of features, which leaves a code leaves open, six levels
at once; the first leaf that all pairs leave open is the row's.

Rules are those of Spark ML's ensembles: 32 bins at quantiles, Poisson weights per
tree, variance or Gini gain, a first boosted tree of weight 1 on the labels, and
further ones on the negative gradient of the squared or logistic loss.
"""

from __future__ import annotations

import base64
import io
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
    HasSeed, HasWeightCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F, types as T

from tideline.session import stable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
BLOCK = 1 << 16  # rows of a block, at most
TASK_ROWS = 1 << 20  # rows of a task, about; a row takes up to 24 bytes and 6 per feature
REFRESH = 5  # boosting rounds after which the sum of the trees is written
STEPS = (6, 3)  # levels that the first and each further look at the masks takes
NAMES = ["block", "n", "codes", "y", "w", "f"]
SCHEMA = "block long, n int, codes binary, y binary, w binary, f binary"
# Poisson(1) by a draw of 16 bits
_POISSON = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(65536) + 0.5) / 65536
).astype(np.uint8)


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i + 1 and 2i + 2; feature -1 ends a path."""

    feature: np.ndarray
    cut: np.ndarray  # bins up to this one go left
    stats: np.ndarray

    @staticmethod
    def of(depth: int, width: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros((n, width)))


def _walk(feature: np.ndarray, cut: np.ndarray, cells: np.ndarray, steps: int) -> np.ndarray:
    """The node each column of ``cells`` (features x rows) ends at; nodes beyond the path stay."""
    flat, n = cells.ravel(), cells.shape[1]
    node, row = np.zeros(n, np.int64), np.arange(n)
    ends = feature < 0
    at = np.where(ends, 0, feature).astype(np.int64) * n
    # an ended path goes on to itself
    own = np.arange(len(feature))
    after = np.repeat(np.where(ends, own, 2 * own + 1), 2)
    after[1::2] += ~ends
    for _ in range(steps):
        right = flat.take(at.take(node) + row) > cut.take(node)
        node = after.take(2 * node + right)
    return node


@dataclass
class Layout:
    """Bins of each feature, and which two features share a code."""

    sizes: list[int]
    pairs: list[tuple[int, ...]]

    @staticmethod
    def of(sizes: Sequence[int]) -> Layout:
        """Features of many bins go with those of few."""
        order = sorted(range(len(sizes)), key=lambda f: sizes[f])
        pairs = []
        while len(order) > 1:
            pairs.append((order.pop(), order.pop(0)))
        return Layout(list(sizes), pairs + [(f,) for f in order])

    def width(self, pair: tuple[int, ...]) -> int:
        return math.prod(self.sizes[f] for f in pair)

    def codes(self, cells: np.ndarray) -> np.ndarray:
        """One row of codes per pair, of one row of bins per feature."""
        out = np.empty((len(self.pairs), cells.shape[1]), np.uint16)
        for row, pair in zip(out, self.pairs):
            row[:] = cells[pair[0]]
            for f in pair[1:]:
                row *= np.uint16(self.sizes[f])
                row += cells[f]
        return out

    def cells(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.sizes), codes.shape[1]), np.uint8)
        for row, pair in zip(codes, self.pairs):
            if len(pair) > 1:
                known = np.arange(self.width(pair))
                out[pair[0]] = (known // self.sizes[pair[1]]).astype(np.uint8).take(row)
                out[pair[1]] = (known % self.sizes[pair[1]]).astype(np.uint8).take(row)
            else:
                out[pair[0]] = row
        return out


class Paths:
    """Leads rows of codes to the nodes of a level of one tree.

    A row that goes right at a node cannot end left of it.  Of the leaves that no
    node rules out the first is the row's; a path that ends early goes left.
    """

    def __init__(self, feature: np.ndarray, cut: np.ndarray, level: int, layout: Layout):
        self.level, self.stages, done = level, [], 0
        while done < level:
            steps = min(STEPS[bool(done)], level - done)
            self.stages.append((steps, self._masks(feature, cut, done, steps, layout)))
            done += steps

    @staticmethod
    def _masks(feature, cut, done, steps, layout) -> list[np.ndarray]:
        """Per pair the leaves left open, by subtree of level ``done`` and code."""
        leaves, tops = 1 << steps, 1 << done
        kind = np.dtype(f"u{max(8, leaves) // 8}")
        every = kind.type((1 << leaves) - 1)
        open_ = [np.full((tops, size), every, kind) for size in layout.sizes]
        for depth in range(steps):
            first, below = (tops << depth) - 1, leaves >> (depth + 1)
            for i in range(tops << depth):
                f = feature[first + i]
                if f >= 0:
                    top, place = divmod(i, 1 << depth)
                    left = ((1 << below) - 1) << (2 * below * place)
                    open_[f][top, cut[first + i] + 1 :] &= kind.type(~left & int(every))
        out = []
        for pair in layout.pairs:
            mask = open_[pair[0]]
            for f in pair[1:]:
                mask = mask[:, :, None] & open_[f][:, None, :]
            out.append(np.ascontiguousarray(mask).reshape(tops, -1))
        return out

    def of(self, codes: Sequence[np.ndarray]) -> np.ndarray:
        """Place in the level of each row."""
        at = None
        for steps, masks in self.stages:
            left = None
            for code, mask in zip(codes, masks):
                part = mask.ravel().take(code if at is None else at * mask.shape[1] + code)
                left = part if left is None else np.bitwise_and(left, part, out=left)
            # bits below the lowest one
            leaf = np.bitwise_count(~left & (left - left.dtype.type(1))).astype(np.intp)
            at = leaf if at is None else (at << steps) + leaf
        return np.zeros(len(codes[0]), np.intp) if at is None else at

    def ends(self, feature: np.ndarray) -> np.ndarray:
        """The node at which each place's path ends."""
        place, node = np.arange(1 << self.level), np.zeros(1 << self.level, np.int64)
        for depth in range(self.level):
            right = place >> (self.level - 1 - depth) & 1
            node = np.where(feature[node] >= 0, 2 * node + 1 + right, node)
        return node


class Sums:
    """Sums of one tree's rows by slot, feature and bin; classes are columns."""

    def __init__(self, sizes: Sequence[int], slots: int, classes: int):
        self.sizes, self.slots, self.classes, self.width = sizes, slots, classes, classes or 2
        # one more slot for rows that do not count
        self.parts = [np.zeros(((slots + 1) * n, self.width)) for n in sizes]

    def add(self, cells: Sequence[np.ndarray], slot: np.ndarray, y: np.ndarray, w: np.ndarray | None) -> None:
        """Rows of a block: bins by feature, labels and, unless all are 1, weights."""
        wy = None if self.classes else y if w is None else w * y
        for part, size, bins in zip(self.parts, self.sizes, cells):
            place = slot * size + bins
            if self.classes:
                place = place * self.classes + y
                part += np.bincount(place, w, part.size).reshape(part.shape)
            else:
                part[:, 0] += np.bincount(place, w, len(part))
                part[:, 1] += np.bincount(place, wy, len(part))

    def whole(self) -> np.ndarray:
        """Sums (features, slots * BINS, columns)."""
        out = np.zeros((len(self.sizes), self.slots, BINS, self.width))
        for f, (part, size) in enumerate(zip(self.parts, self.sizes)):
            out[f, :, :size] = part[: self.slots * size].reshape(self.slots, size, self.width)
        return out.reshape(len(out), -1, self.width)


def _weight(stats: np.ndarray, classes: int) -> np.ndarray:
    return stats.sum(axis=-1) if classes else stats[..., 0]


def _score(stats: np.ndarray, classes: int) -> np.ndarray:
    square = (stats**2).sum(axis=-1) if classes else stats[..., 1] ** 2
    weight = _weight(stats, classes)
    return np.divide(square, weight, out=np.zeros_like(square), where=weight > 0)


def best_splits(sums: np.ndarray, classes: int, allowed: np.ndarray | None) -> list[tuple]:
    """Per slot: feature, cut, gain, sums left, sums right; the feature is -1 without a gain.

    ``sums`` is (slots, features, BINS, columns).
    """
    whole = sums[:, 0].sum(axis=1)
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    right = whole[:, None, None] - left
    own = _score(whole, classes)
    least = 1e-9 * _weight(whole, classes)[:, None, None]
    gain = _score(left, classes) + _score(right, classes) - own[:, None, None]
    some = (_weight(left, classes) > least) & (_weight(right, classes) > least)
    if allowed is not None:
        some &= allowed[:, :, None]
    gain = np.where(some, gain, -np.inf).reshape(len(sums), -1)
    at = gain.argmax(axis=1)
    out = []
    for s, i in enumerate(at):
        f, c = divmod(int(i), BINS - 1)
        if gain[s, i] > 1e-12 * own[s]:
            out.append((f, c, float(gain[s, i]), left[s, f, c], right[s, f, c], whole[s]))
        else:
            out.append((-1, 0, 0.0, whole[s], whole[s], whole[s]))
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks as number, codes, labels, weights, sums of the trees; the last two may be missing."""
    for batch in batches:
        for i in range(batch.num_rows):
            parts = [np.frombuffer(batch.column(j)[i].as_buffer(), np.float64) for j in (3, 4, 5)]
            codes = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint16)
            y, w, f = (p if len(p) else None for p in parts)
            yield batch.column(0)[i].as_py(), codes.reshape(-1, batch.column(1)[i].as_py()), y, w, f


def _row(names: Sequence[str], block: int, codes: np.ndarray, *columns: np.ndarray | None) -> pa.RecordBatch:
    values = [block, codes.shape[1], codes.tobytes(), *[b"" if c is None else c.tobytes() for c in columns]]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * (len(names) - 2)]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def cut_points(df: DataFrame, features: str, dims: int) -> list[np.ndarray]:
    """Up to 31 values between the quantiles of each feature, of all rows."""
    grid = [float(q) for q in np.linspace(0, 1, 1025)]
    rows = df.select(vector_to_array(F.col(features)).alias("x"))
    facts = rows.agg(*[
        F.percentile_approx(F.get("x", F.lit(i)), grid, 10_000).alias(f"q{i}") for i in range(dims)
    ]).first()
    cuts = []
    for i in range(dims):
        q = np.array(facts[f"q{i}"] or [0.0])
        values = np.unique(q)
        if len(values) > BINS:
            values = np.unique(np.quantile(q, np.arange(BINS) / (BINS - 1), method="nearest"))
        cuts.append((values[1:] + values[:-1]) / 2)
    return cuts


def binned(
    df: DataFrame, features: str, columns: Sequence[str], cuts: list[np.ndarray], layout: Layout
) -> DataFrame:
    """Blocks of rows: codes of the bins and the values of ``columns``."""
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    rows = df.select(vector_to_array(F.col(features)).alias("x"), *numbers)
    names = ["block", "n", "codes", *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            return _row(names, number, *[np.concatenate(parts, axis=-1) for parts in zip(*held)])

        for batch in batches:
            x = np.asarray(batch.column(0).flatten(), np.float64).reshape(-1, len(cuts))
            cells = np.empty(x.shape[::-1], np.uint8)
            for f, cut in enumerate(cuts):
                cells[f] = np.searchsorted(cut, x[:, f])
            held.append((layout.codes(cells), *[np.asarray(c, np.float64) for c in batch.columns[1:]]))
            n += batch.num_rows
            if n >= BLOCK:
                yield block()
                number, held, n = number + 1, [], 0
        if n:
            yield block()

    return rows.mapInArrow(run, ", ".join(["block long, n int, codes binary", *[f"`{c}` binary" for c in columns]]))


@dataclass
class Bins:
    """Rows binned once, for all fits to some labels that no row lacks."""

    cuts: list[np.ndarray]
    layout: Layout
    blocks: DataFrame
    top: dict[str, float]

    @staticmethod
    def of(df: DataFrame, features: str, labels: Sequence[str], weight: str | None = None) -> Bins:
        first = df.select(F.size(vector_to_array(F.col(features))).alias("d")).first()
        facts = df.agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in labels]).first()
        cuts = cut_points(df, features, first["d"])
        layout = Layout.of([len(c) + 1 for c in cuts])
        columns = [*labels, *([weight] if weight else [])]
        tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(facts["n"] / TASK_ROWS))
        blocks = stable(binned(df, features, columns, cuts, layout).repartition(tasks))
        return Bins(cuts, layout, blocks, {c: facts[c] for c in labels})

    def rows(self, label: str, weight: str | None) -> DataFrame:
        """Blocks of one fit, without a sum of the trees."""
        none = F.lit(b"")
        return self.blocks.select(
            "block", "n", "codes", F.col(label).alias("y"), (F.col(weight) if weight else none).alias("w"),
            none.alias("f"),
        )


class _Ensemble(HasFeaturesCol, HasSeed):
    """Shared by the estimator and its model."""

    classes = Param(Params._dummy(), "classes", "number of classes, 0 for numbers", TypeConverters.toInt)
    boosted = Param(Params._dummy(), "boosted", "boosting or a forest", TypeConverters.toBoolean)

    def setFeaturesCol(self, value: str):
        return self._set(featuresCol=value)


class HistogramTrees(Estimator, _Ensemble, HasLabelCol, HasWeightCol):
    """Random forest or gradient boosting, for numbers or classes (boosting: two)."""

    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "weight of later boosted trees", TypeConverters.toFloat)
    subset = Param(Params._dummy(), "subset", "a node looks at the root of the features", TypeConverters.toBoolean)
    classify = Param(Params._dummy(), "classify", "labels are class numbers", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, trees=100, maxDepth=5, stepSize=0.1, subset=False, classify=False,
                 boosted=False, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(trees=100, maxDepth=5, stepSize=0.1, subset=False, classify=False,
                         boosted=False, seed=42)

    bins: Bins | None = None  # the rows to fit, if they are binned already

    def setLabelCol(self, value: str):
        return self._set(labelCol=value)

    def setWeightCol(self, value: str):
        return self._set(weightCol=value)

    def _fit(self, df: DataFrame) -> TreesModel:
        of = self.getOrDefault
        features, label = self.getFeaturesCol(), self.getLabelCol()
        weight = self.getWeightCol() if self.isSet(self.weightCol) else None
        bins = self.bins if self.bins and label in self.bins.top else Bins.of(
            df.where(F.col(label).isNotNull()), features, [label], weight
        )
        classes = max(2, int(bins.top[label]) + 1) if of(self.classify) else 0
        cuts, layout, blocks = bins.cuts, bins.layout, bins.rows(label, weight)
        grow = _boost if of(self.boosted) else _forest
        grown, rates, shares = grow(
            blocks, of(self.trees), of(self.maxDepth), classes, of(self.seed), layout,
            of(self.stepSize), of(self.subset),
        )
        shared = bool(classes) and not of(self.boosted)
        told = _told(grown, rates, shares, cuts, shared)
        return TreesModel(classes=classes, boosted=of(self.boosted), told=told).setFeaturesCol(features)


def _open(tree: Tree, level: int) -> np.ndarray:
    """Nodes of a level that a path reaches."""
    nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
    return nodes if level == 0 else nodes[tree.feature[(nodes - 1) // 2] >= 0]


def _slots(nodes: np.ndarray, level: int) -> np.ndarray:
    """Slot of each place of a level; places that no path reaches share the one after the last."""
    slot = np.full(1 << level, len(nodes), np.intp)
    slot[nodes - ((1 << level) - 1)] = np.arange(len(nodes))
    return slot


def _split(tree: Tree, nodes: np.ndarray, found: Sequence[tuple], shares: np.ndarray) -> None:
    for node, (f, c, gain, left, right, whole) in zip(nodes, found):
        tree.stats[node] = whole
        if f >= 0:
            tree.feature[node], tree.cut[node] = f, c
            tree.stats[2 * node + 1], tree.stats[2 * node + 2] = left, right
            shares[f] += gain


def _subsets(seed: int, tree: int, nodes: np.ndarray, dims: int) -> np.ndarray:
    """Which features each node looks at."""
    out, size = np.zeros((len(nodes), dims), bool), math.ceil(math.sqrt(dims))
    for i, node in enumerate(nodes):
        out[i, np.random.default_rng([seed, tree, int(node)]).permutation(dims)[:size]] = True
    return out


def _drawn(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often a tree takes each row of a block."""
    words = np.random.SFC64([seed, tree, block]).random_raw(-(-rows // 4))
    return _POISSON.take(words.astype("<u8", copy=False).view("<u2")[:rows])


def _forest(blocks, count, depth, classes, seed, layout, step, subset):
    """All trees level by level: one scan and one shuffle of sums by tree a level."""
    width, dims = classes or 2, len(layout.sizes)
    trees = [Tree.of(depth, width) for _ in range(count)]
    shares = np.zeros((count, dims))
    for level in range(depth):
        nodes = {t: o for t, tree in enumerate(trees) if len(o := _open(tree, level))}
        if not nodes:
            break
        shape = [(t, trees[t].feature, trees[t].cut, _slots(o, level), len(o)) for t, o in nodes.items()]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = []
            for block, codes, y, w, _ in _read(batches):
                y = y.astype(np.intp) if classes else y
                held.append((block, codes.astype(np.intp), layout.cells(codes), y, w))
            for t, feature, cut, slot_of, slots in shape if held else ():
                paths, sums = Paths(feature, cut, level, layout), Sums(layout.sizes, slots, classes)
                for block, codes, cells, y, w in held:
                    drawn = _drawn(seed, t, block, len(y))
                    at = np.flatnonzero(drawn)
                    slot = slot_of.take(paths.of([c.take(at) for c in codes]))
                    times = drawn.take(at).astype(np.float64)
                    if w is not None:
                        times *= w.take(at)
                    sums.add([c.take(at) for c in cells], slot, y.take(at), times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), pa.array([sums.whole().tobytes()], pa.binary())], ["tree", "sums"]
                )

        def settle(key, table):
            t = key[0].as_py()
            total = sum(np.frombuffer(s.as_py(), np.float64) for s in table.column("sums"))
            sums = total.reshape(dims, -1, BINS, width).transpose(1, 0, 2, 3)
            found = best_splits(sums, classes, _subsets(seed, t, nodes[t], dims) if subset else None)
            flat = [np.concatenate([[f, c, gain], *stats]) for f, c, gain, *stats in found]
            return pa.table({"tree": pa.array([t], pa.int32()), "found": pa.array([np.concatenate(flat).tobytes()], pa.binary())})

        parts = blocks.mapInArrow(run, "tree int, sums binary")
        for r in parts.groupBy("tree").applyInArrow(settle, "tree int, found binary").collect():
            table = np.frombuffer(r.found, np.float64).reshape(-1, 3 + 3 * width)
            found = [
                (int(v[0]), int(v[1]), v[2], v[3 : 3 + width], v[3 + width : 3 + 2 * width], v[3 + 2 * width :])
                for v in table
            ]
            _split(trees[r.tree], nodes[r.tree], found, shares[r.tree])
    sizes = shares.sum(axis=1, keepdims=True)
    shares = np.divide(shares, sizes, out=np.zeros_like(shares), where=sizes > 0)
    return trees, np.full(count, 1.0 / count), shares.sum(axis=0)


def _values(tree: Tree) -> np.ndarray:
    weight = tree.stats[:, 0]
    return np.divide(tree.stats[:, 1], weight, out=np.zeros(len(weight)), where=weight > 0)


def _boost(blocks, count, depth, classes, seed, layout, step, subset):
    """Tree after tree, a scan a level; sums per node of one tree reach the driver."""
    dims = len(layout.sizes)
    trees, rates, shares = [], [], np.zeros(dims)
    recent: list[tuple] = []  # trees that the written sums lack
    # every level of a tree reads the blocks
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def so_far(codes, f, known):
        for paths, values in known:
            part = values.take(paths.of(codes))
            f = part if f is None else f + part
        return f

    for number in range(count):
        tree = Tree.of(depth, 2)
        for level in range(depth):
            nodes = _open(tree, level)
            if not len(nodes):
                break
            slot_of, slots, known = _slots(nodes, level), len(nodes), list(recent)
            paths = Paths(tree.feature, tree.cut, level, layout)

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums = Sums(layout.sizes, slots, 0)
                for _, codes, y, w, f in _read(batches):
                    goal, near = 2.0 * y - 1.0 if classes else y, codes.astype(np.intp)
                    if number:
                        f = so_far(near, f, known)
                        goal = 4.0 * goal / (1.0 + np.exp(np.minimum(2.0 * goal * f, 700.0))) if classes else 2.0 * (y - f)
                    slot = slot_of.take(paths.of(near))
                    sums.add(layout.cells(codes), slot, goal, w)
                yield pa.RecordBatch.from_arrays([pa.array([sums.whole().tobytes()], pa.binary())], ["sums"])

            # a node takes 3 kB, there are at most 2 ** depth
            parts = blocks.mapInArrow(run, "sums binary").collect()
            total = sum(np.frombuffer(r.sums, np.float64) for r in parts)
            sums = total.reshape(dims, -1, BINS, 2).transpose(1, 0, 2, 3)
            _split(tree, nodes, best_splits(sums, 0, None), shares)
        rate = step if number else 1.0
        trees.append(tree)
        rates.append(rate)
        paths = Paths(tree.feature, tree.cut, depth, layout)
        recent.append((paths, rate * _values(tree)[paths.ends(tree.feature)]))
        if len(recent) == REFRESH and number + 1 < count:
            known = list(recent)

            def update(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
                for block, codes, y, w, f in _read(batches):
                    yield _row(NAMES, block, codes, y, w, so_far(codes.astype(np.intp), f, known))

            written = stable(blocks.mapInArrow(update, SCHEMA)).persist(StorageLevel.MEMORY_AND_DISK)
            blocks.unpersist()
            blocks, recent = written, []
    blocks.unpersist()
    return trees, np.array(rates), shares


def _told(trees: Sequence[Tree], rates, shares, cuts, shared: bool) -> str:
    """The trees with thresholds in place of bins, as text; ``shared`` leaves hold shares of classes."""
    values, thresholds = [], []
    for t in trees:
        weight = t.stats.sum(axis=1, keepdims=True)
        part = np.divide(t.stats, weight, out=np.zeros_like(t.stats), where=weight > 0)
        values.append(part if shared else _values(t)[:, None])
        thresholds.append([cuts[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)])
    whole = shares.sum()
    out = io.BytesIO()
    np.savez_compressed(
        out, feature=np.stack([t.feature for t in trees]), threshold=np.array(thresholds, np.float64),
        values=np.stack(values) * np.asarray(rates)[:, None, None], shares=shares / whole if whole > 0 else shares,
    )
    return base64.b64encode(out.getvalue()).decode()


class TreesModel(Model, _Ensemble, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
                 DefaultParamsReadable, DefaultParamsWritable):
    """Adds the prediction and, for classes, the probabilities."""

    told = Param(Params._dummy(), "told", "trees as text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, classes=None, boosted=None, told=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setPredictionCol(self, value: str):
        return self._set(predictionCol=value)

    def setProbabilityCol(self, value: str):
        return self._set(probabilityCol=value)

    def setRawPredictionCol(self, value: str):
        return self._set(rawPredictionCol=value)

    def _arrays(self):
        return np.load(io.BytesIO(base64.b64decode(self.getOrDefault(self.told))))

    @property
    def numClasses(self) -> int:
        return self.getOrDefault(self.classes)

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self._arrays()["shares"])

    def _transform(self, df: DataFrame) -> DataFrame:
        arrays = self._arrays()
        feature, threshold, values, dims = (*(arrays[k] for k in ("feature", "threshold", "values")), len(arrays["shares"]))
        steps = int(math.log2(feature.shape[1] + 1)) - 1

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def score(x: pa.Array) -> pa.Array:
            cells = np.ascontiguousarray(np.asarray(x.flatten(), np.float64).reshape(-1, dims).T)
            out = np.zeros((len(x), values.shape[2]))
            for f, t, v in zip(feature, threshold, values):
                out += v[_walk(f, t, cells, steps)]
            ends = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

        scored = df.withColumn("_score", score(vector_to_array(F.col(self.getFeaturesCol()))))
        first = F.get("_score", F.lit(0))
        if not self.numClasses:
            return scored.withColumn(self.getPredictionCol(), first).drop("_score")
        if self.getOrDefault(self.boosted):
            chance = 1.0 / (1.0 + F.exp(-2.0 * first))
            raw, probs = F.array(-first, first), F.array(1.0 - chance, chance)
            guess = F.when(first > 0, 1.0).otherwise(0.0)
        else:
            raw = probs = F.col("_score")
            guess = (F.array_position("_score", F.array_max("_score")) - 1).cast("double")
        return scored.withColumns({
            self.getRawPredictionCol(): array_to_vector(raw), self.getProbabilityCol(): array_to_vector(probs),
            self.getPredictionCol(): guess,
        }).drop("_score")
