"""Hard negatives by inner product on a forest of cover trees.

The candidates are dealt evenly into blocks, and each block is one cover tree.
A vector x of a block gets one more component, sqrt(M*M - |x|*|x|) with M the
largest norm there, so that all have norm M and the inner product with a query
(whose further component is 0) falls with the distance.  The tree is grown by
farthest-first traversal: a point that was ``d`` away from those before it
belongs to the level l with R/2**l < d <= R/2**(l-1), so the points of the
levels up to l are more than R/2**l apart and cover all others within it; its
parent is the nearest point of a higher level.  A node keeps, per level, the
largest distance to anything that hangs below it from there on.

With that radius as an angle, a node's own inner product bounds those of all its
descendants from both sides.  A search goes best bound first: it opens the node
with the highest bound, scores the children exactly, and skips nodes that lie
outside every window asked for, or below the k best that a window already has.

A cell is a block of queries and a few trees, searched one after the other with
the best rows so far; a window over (query, positive) merges the cells.  The
first search finds each anchor's positives, the second the negatives in the
windows that the positives' scores give.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import stable

ROWS, TREES, QUERIES = 2048, 4, 2048
LOWEST, HIGHEST = -(2**63), 2**63 - 1
EXACT = 2**53  # integers up to here are exact in double arithmetic


class CoverTree:
    """Points in the order of their level and parent, and the groups of siblings.

    ``points`` are integers (rows x components).  Group g holds the points
    start[g] to stop[g], children of one node at one level; ``after[g]`` is that
    node's group at its next level (or -1) and ``radius[g]`` the distance from
    the node within which all lies that hangs from it from this level on.
    ``first[p]`` is the first group of point p (or -1).  Point 0 is the root.
    """

    def __init__(self, points, start, stop, after, radius, first, norm):
        self.points, self.norm = points, norm
        self.start, self.stop, self.after = start, stop, after
        self.radius, self.first = radius, first
        self.reach = float(np.abs(points).max(initial=0))
        self.floats = points.astype(np.float64)

    @staticmethod
    def grow(points: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree of ``points``, and which row each of its points is."""
        n, floats = len(points), points.astype(np.float64)
        squares = np.einsum("ij,ij->i", floats, floats)
        most = float(squares.max())
        further = np.sqrt(np.maximum(most - squares, 0))
        distance = floats @ floats.T
        distance += np.outer(further, further)
        distance *= -2
        distance += 2 * most
        np.sqrt(np.maximum(distance, 0, out=distance), out=distance)
        np.fill_diagonal(distance, 0)

        level, parent = np.zeros(n, np.int64), np.full(n, -1)
        near, owner = distance[0].copy(), np.zeros(n, np.int64)
        near[0] = -1  # -1: already in the tree
        whole, least = max(float(near.max()), 0.0), 1e-7 * most**0.5
        depth, above = 0, owner
        for _ in range(n - 1):
            at = int(near.argmax())
            away = float(near[at])
            if away <= least:  # what is left equals a point of the tree
                rest = np.flatnonzero(near >= 0)
                level[rest], parent[rest] = depth + 1, owner[rest]
                break
            own = int(np.log2(whole / away)) + 1
            if own > depth:
                depth, above = own, owner.copy()
            level[at], parent[at] = depth, above[at]
            closer = distance[at] < near
            owner[closer] = at
            np.minimum(near, distance[at], out=near)
            near[at] = -1

        # distance from each node's parent to the farthest point below the node, itself included
        cover, below, node = np.zeros(n), np.arange(n), np.arange(n)
        while True:
            up = parent[node]
            below, node, up = below[up >= 0], node[up >= 0], up[up >= 0]
            if not len(node):
                break
            np.maximum.at(cover, node, distance[below, up])
            node = up

        order = np.lexsort((parent, level))  # the root first, siblings of a level together
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        above, level, cover = np.where(parent >= 0, place[parent], -1)[order], level[order], cover[order]
        cut = np.flatnonzero(np.r_[True, (np.diff(level) != 0) | (np.diff(above) != 0)])[1:]
        stop = np.r_[cut[1:], n] if len(cut) else cut
        radius = np.maximum.reduceat(cover, cut) if len(cut) else np.zeros(0)
        after, first = np.full(len(cut), -1), np.full(n, -1)
        for g in range(len(cut) - 1, -1, -1):  # levels descend, so later groups come first
            p = above[cut[g]]
            after[g] = first[p]
            if after[g] >= 0:
                radius[g] = max(radius[g], radius[after[g]])
            first[p] = g
        return CoverTree(points[order], cut, stop, after, radius, first, most**0.5), order

    def search(self, query: np.ndarray, allowed: np.ndarray, ids: np.ndarray, windows: list[Best]) -> int:
        """Offer the allowed points to every window; returns how many points were scored."""
        windows = [w for w in windows if w.low <= w.high]
        if not windows:
            return 0
        ints = query.astype(np.int64)
        exact = max(1, len(ints)) * self.reach * float(np.abs(ints).max(initial=0)) < EXACT
        asked = ints.astype(np.float64) if exact else ints
        table = self.floats if exact else self.points
        size = float(np.linalg.norm(ints.astype(np.float64))) * self.norm
        slack = 1e-6 * size + 1e-6
        seen, top = 0, max(w.high for w in windows)

        def bounds(score, radius):
            """Least and largest inner product within ``radius`` of a node with this score."""
            if size == 0:
                return np.zeros_like(score), np.zeros_like(score)
            turn = np.arccos(np.clip(score / size, -1, 1))
            wide = 2 * np.arcsin(np.minimum(radius / (2 * self.norm), 1))
            low = size * np.cos(np.minimum(turn + wide, np.pi)) - slack
            return low, size * np.cos(np.maximum(turn - wide, 0)) + slack

        def wanted(low, high):
            out = np.zeros(len(low), bool)
            for w in windows:
                out |= (high >= w.bar()) & (low <= w.high)
            return out

        def score(a, b):
            nonlocal seen
            seen += b - a
            found = table[a:b] @ asked
            fit = allowed[a:b] & (found >= min(w.bar() for w in windows)) & (found <= top)
            at = np.flatnonzero(fit)
            if len(at):  # ordered once for all windows
                at = at[np.lexsort((ids[a:b][at], -found[at]))]
                scores, names = found[at].astype(np.int64), ids[a:b][at]
                for w in windows:
                    w.offer(scores, names)
            return found.astype(np.float64)

        heap: list[tuple[float, float, int, float]] = []

        def put(groups, scores):
            low, high = bounds(scores, self.radius[groups])
            keep = wanted(low, high)
            for g, s, lo, hi in zip(*(x[keep].tolist() for x in (groups, scores, low, high))):
                heapq.heappush(heap, (-hi, g, lo, s))

        root = score(0, 1)
        if self.first[0] >= 0:
            put(self.first[:1], root)
        while heap:
            high, g, low, own = heapq.heappop(heap)
            if not wanted(np.array([low]), np.array([-high]))[0]:
                continue
            a, b = int(self.start[g]), int(self.stop[g])
            found = score(a, b)
            if self.after[g] >= 0:
                put(self.after[g : g + 1], np.array([own]))
            inner = np.flatnonzero(self.first[a:b] >= 0)
            if len(inner):
                put(self.first[a:b][inner], found[inner])
        return seen


class Best:
    """The k largest scores from ``low`` to ``high``, smaller ids first among equals."""

    def __init__(self, k: int, low: int = LOWEST, high: int = HIGHEST):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bar(self) -> int:
        """What a score must reach to be among the best."""
        return max(self.low, int(self.scores[-1]) if len(self.scores) >= self.k else LOWEST)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows from the largest score down, smaller ids first among equals."""
        from_ = int(np.searchsorted(-scores, -self.high)) if self.high < HIGHEST else 0
        scores, ids = scores[from_ : from_ + self.k], ids[from_ : from_ + self.k]
        if not len(scores) or scores[0] < self.bar():
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))
        best = best[scores[best] >= self.low][: self.k]
        self.scores, self.ids = scores[best], ids[best]


def sound_vectors(
    vectors: DataFrame, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """(id, label, v): components as floor(scale * x); rows that take part only."""
    finite = F.forall(
        vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vectors.filter(
        F.col(id_col).isNotNull() & label.isNotNull() & F.col(vec_col).isNotNull() & finite
    ).select(
        F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"),
        F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """A partition's rows by the length of their vector, ordered by id, and the vectors."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).sort_by("id").combine_chunks()
    column = table.column("v").combine_chunks()
    ends, flat = np.asarray(column.offsets), np.asarray(column.values)
    size = np.diff(ends)
    for length in np.unique(size):
        own = np.flatnonzero(size == length)
        yield table.take(own), flat[ends[own][:, None] + np.arange(length)].astype(np.int64)


def _narrow(x: np.ndarray) -> np.ndarray:
    """The smallest integer type that holds ``x``."""
    for kind in (np.int16, np.int32):
        if not x.size or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return x.astype(kind)
    return x


PARTS = ("start", "stop", "after", "radius", "first")
INDEX = "block long, dims long, width long, norm double, points binary, ids binary, labels array<string>, " + ", ".join(
    f"{c} binary" for c in PARTS
)
ASKED = "part long, base long, dims long, width long, points binary, ids binary, labels array<string>, own array<array<long>>, scores array<array<long>>"
FOUND = "asker long, query_id long, number int, vec_id long, score long"


def _pack(table: pa.Table, points: np.ndarray) -> dict:
    points = _narrow(points)
    return {
        "dims": [points.shape[1]], "width": [points.itemsize], "points": [points.tobytes()],
        "ids": [table.column("id").to_numpy().astype(np.int64).tobytes()],
        "labels": [table.column("label").to_pylist()],
    }


def _points(row: dict) -> np.ndarray:
    ids = np.frombuffer(row["ids"], np.int64)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["width"]]
    return np.frombuffer(row["points"], kind).reshape(len(ids), row["dims"]).astype(np.int64)


def build_forest(found: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per tree; every vector is in one tree of about ``rows``."""
    blocks = max(1, -(-found.count() // rows))
    schema = pa.schema(
        [("block", pa.int64()), ("dims", pa.int64()), ("width", pa.int64()), ("norm", pa.float64()),
         ("points", pa.binary()), ("ids", pa.binary()), ("labels", pa.list_(pa.string()))]
        + [(c, pa.binary()) for c in PARTS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        for table, points in _by_length(batches):
            # a partition may hold a little more than was asked for, never less than one tree
            for a in range(0, len(points), 2 * rows):
                tree, order = CoverTree.grow(points[a : a + 2 * rows])
                packed = _pack(table.slice(a, 2 * rows).take(order), tree.points)
                parts = {c: [np.asarray(getattr(tree, c), float if c == "radius" else np.int64).tobytes()]
                         for c in PARTS}
                yield pa.RecordBatch.from_pydict(
                    {"block": [block], "norm": [tree.norm], **packed, **parts}, schema
                )

    return stable(found.repartition(blocks).mapInArrow(run, INDEX))


def query_blocks(found: DataFrame, rows: int = QUERIES) -> DataFrame:
    """Queries (id, label, v, own, scores) in blocks; own and scores are those of the positives."""
    blocks = max(1, -(-found.count() // rows))
    schema = pa.schema(
        [("part", pa.int64()), ("base", pa.int64()), ("dims", pa.int64()), ("width", pa.int64()), ("points", pa.binary()),
         ("ids", pa.binary()), ("labels", pa.list_(pa.string())),
         ("own", pa.list_(pa.list_(pa.int64()))), ("scores", pa.list_(pa.list_(pa.int64())))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, base = TaskContext.get().partitionId(), 0
        for table, points in _by_length(batches):
            packed = _pack(table, points)
            more = {c: [table.column(c).to_pylist()] for c in ("own", "scores")}
            yield pa.RecordBatch.from_pydict({"part": [part], "base": [base], **packed, **more}, schema)
            base += len(points)

    return stable(found.repartition(blocks).mapInArrow(run, ASKED))


def _search(
    forest: DataFrame, asked: DataFrame, k: int, same: bool, share: Sequence[int], trees: int
) -> DataFrame:
    """Best k per query (``same``) or per query and positive, of every cell."""
    parts, blocks = (t.agg(F.max(c)).first()[0] for t, c in ((asked, "part"), (forest, "block")))
    cells = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n)).cast("array<bigint>"))
    left = forest.withColumn("cell", F.floor(F.col("block") / trees)).withColumn(
        "part", cells(parts or 0)
    )
    right = asked.withColumn("cell", cells((blocks or 0) // trees))
    keys = ["part", "cell", "dims"]

    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        out = {c: [] for c in ("asker", "query_id", "number", "vec_id", "score")}
        state = []
        for block in queries.to_pylist():
            for number, (name, point) in enumerate(zip(np.frombuffer(block["ids"], np.int64), _points(block))):
                if same:
                    windows = [Best(k)]
                else:  # share[0] * positive <= 100 * score <= share[1] * positive
                    windows = [Best(k, -(-share[0] * s // 100), share[1] * s // 100)
                               for s in block["scores"][number]]
                asker = block["part"] << 32 | block["base"] + number
                state.append((asker, int(name), point, block["labels"][number], windows))
        for row in trees.to_pylist():
            points, ids = _points(row), np.frombuffer(row["ids"], np.int64)
            parts = (np.frombuffer(row[c], float if c == "radius" else np.int64) for c in PARTS)
            tree = CoverTree(points, *parts, row["norm"])
            labels = np.array(row["labels"], object)
            alike = {label: labels == label for label in {s[3] for s in state}}
            for _, name, point, label, windows in state:
                mine = alike[label]
                tree.search(point, (mine if same else ~mine) & (ids != name), ids, windows)
        for asker, name, _, _, windows in state:
            for number, w in enumerate(windows):
                out["asker"] += [asker] * len(w.ids)
                out["query_id"] += [name] * len(w.ids)
                out["number"] += [number] * len(w.ids)
                out["vec_id"] += w.ids.tolist()
                out["score"] += w.scores.tolist()
        kinds = [pa.int32() if c == "number" else pa.int64() for c in out]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, FOUND)
    order = Window.partitionBy("asker", "number").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 10,
    share: Sequence[int] = (30, 90), id_col: str = "vec_id", vec_col: str = "embedding",
    scale: int = 256, rows: int = ROWS, query_rows: int = QUERIES, trees: int = TREES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are integer inner products of floor(scale * x), ties go to the smaller
    id.  An anchor's positives are its first ``positives`` rows of the same label;
    for each of them, the first ``negatives`` rows of another label with
    share[0] * positive <= 100 * negative <= share[1] * positive are returned, so
    a positive with a negative score has none.  Fewer are all returned.

    Rows without id, label or vector, or with a component that is NULL, NaN or
    infinite take no part.  Only vectors of the anchor's length are compared.
    Rows with the anchor's own id are neither its positives nor its negatives; a
    row that is repeated counts as often as it stands there, and a repeated
    anchor is answered as often.  Empty tables and anchors without positives give
    no rows.  Scores must fit into a long.  Columns of other names are not looked at.

    Trees take their rows evenly, whatever ids, labels and vectors are, so equal
    ones make no tree larger than others.
    """
    found = sound_vectors(vectors, label, id_col, vec_col, scale)
    chosen = sound_vectors(vectors.filter(is_anchor), label, id_col, vec_col, scale)
    forest = build_forest(found, rows)
    none = F.array().cast("array<long>")
    anchors = query_blocks(chosen.withColumns({"own": none, "scores": none}), query_rows)
    near = _search(forest, anchors, positives, True, share, trees)
    # asker names the anchor's row in its block
    mine = near.groupBy("asker").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p")
    )
    mine = mine.select(
        F.shiftright("asker", 32).alias("part"), F.col("asker").bitwiseAND(F.lit(2**32 - 1)).alias("row"),
        F.col("p.vec_id").alias("own"), F.col("p.score").alias("scores"),
    )
    # at most `positives` scores a row, gathered into the array of their block
    known = mine.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("row", F.struct("own", "scores")))).alias("known")
    )
    size = F.size("labels")
    entry = lambda field: F.transform(
        F.sequence(F.lit(0).cast("long"), size.cast("long") - 1),
        lambda i: F.coalesce(F.col("known")[F.col("base") + i][field], none),
    )
    asked = stable(
        anchors.drop("own", "scores").join(known, "part").withColumns(
            {"own": entry("own"), "scores": entry("scores")}
        ).drop("known")
    )
    far = _search(forest, asked, negatives, False, share, trees)
    pairs = asked.select("part", "base", F.posexplode("own").alias("row", "own"), "scores").select(
        (F.shiftleft("part", 32) + F.col("base") + F.col("row")).alias("asker"),
        F.posexplode("own").alias("number", "positive_id"), F.col("scores")[F.col("row")].alias("s"),
    ).select("asker", "number", "positive_id", F.col("s")[F.col("number")].alias("positive_score"))
    return far.join(pairs, ["asker", "number"]).select(
        F.col("query_id").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
