"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Every vector of length 1 is projected on many random directions.  A projection's
list is sorted; another vector collides with a query in it if its value lies in
the window centred on the query's.  A pair is verified, by its cosine in double
precision, if it collides in at least ``count`` lists.

A window on a plain list holds a fixed share of all rows, so each list is cut
first: its guards, ``bits`` of the other projections, each say on which side of
their median a vector lies, and only vectors that agree in all guards stand in one
stretch.  ``bits`` grows with the logarithm of the rows, which keeps stretches at
a few rows.  Medians, the number of lists and the count are calibrated on a
bounded sample: its rows are paired with partners made at exactly the threshold,
and lists are added until two collisions find the wanted share of those pairs (if the most
lists do not, guards go); the count is the largest that still does.

Groups of copies would fill every stretch they stand in.  So families are taken
out first: in a few lists every long stretch names a leader, and vectors within
half the threshold's angle of a leader are linked with each other by the triangle
inequality.  A family then is one node with a radius; it stands in a stretch
once, with the range of its members' values, and a pair of nodes is linked
throughout, not at all, or, where the radii leave it open, by comparing blocks
of their members.  Links are counted, never listed, within a family.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.session import stable

SAMPLE = 1024  # rows that medians and counts are calibrated on
STRETCH = 4  # rows in a stretch that the guards aim at
POOL, MOST_LISTS = 256, 1024  # projections that lists share, and lists
FAMILY_LISTS, LONG, FAMILY = 8, 32, 16  # lists and stretch that name leaders, least family
BLOCK = 256  # members compared at once
WORD = 62  # lists noted in one long


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component, so that no square leaves the doubles."""
    return x / np.abs(x).max(axis=1, keepdims=True)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y``, in double precision."""
    x, y = scaled(x), scaled(y)
    size = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
    return np.einsum("ij,ij->i", x, y) / size


@dataclass
class Lists:
    """Which projections make which sorted list, fitted for one table."""

    threshold: float
    seed: int
    bits: int
    pool: int
    guards: np.ndarray  # lists x bits
    lines: np.ndarray  # lists
    count: int = 1
    medians: dict[int, np.ndarray] = field(default_factory=dict)  # by length of the vectors

    @property
    def window(self) -> float:
        """Half the window: twice the spread of a difference at the threshold."""
        return 2 * math.sqrt(2 * (1 - self.threshold))

    def project(self, x: np.ndarray) -> np.ndarray:
        rays = np.random.default_rng([self.seed, x.shape[1]]).normal(size=(self.pool, x.shape[1]))
        x = scaled(x)
        return (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]) @ rays.T

    def places(self, x: np.ndarray, lists: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Stretch and value of each vector in the first ``lists`` lists."""
        values = self.project(x)
        sides = (values > self.medians.get(x.shape[1], np.zeros(self.pool))).astype(np.int64)
        weights = np.int64(1) << np.arange(self.bits, dtype=np.int64)
        stretch = np.stack([sides[:, g] @ weights for g in self.guards[:lists]], axis=1)
        return stretch, values[:, self.lines[:lists]]

    def collisions(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """In how many lists each row of ``x`` collides with the same row of ``y``."""
        (a, v), (b, u) = self.places(x), self.places(y)
        return (a == b) & (np.abs(v - u) <= self.window)


def fit_lists(
    sample: list[np.ndarray], rows: int, threshold: float, recall: float, seed: int = 11
) -> Lists:
    """Lists whose collision count finds the share ``recall`` of pairs at ``threshold``."""
    bits = min(60, max(1, round(math.log2(max(rows, 2) / STRETCH))))
    by_length: dict[int, list[np.ndarray]] = {}
    for x in sample:
        by_length.setdefault(len(x), []).append(x)
    while True:
        rng = np.random.default_rng(seed)
        picks = np.stack([rng.choice(POOL, bits + 1, replace=False) for _ in range(MOST_LISTS)])
        lists = Lists(threshold, seed, bits, POOL, picks[:, :-1], picks[:, -1])
        hits = []
        for length, own in by_length.items():
            x = np.stack(own)
            lists.medians[length] = np.median(lists.project(x), axis=0)
            if length < 2:  # vectors of one component have cosine 1 or -1
                continue
            x = scaled(x)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            other = rng.normal(size=x.shape)
            other -= np.einsum("ij,ij->i", other, x)[:, None] * x
            other /= np.linalg.norm(other, axis=1, keepdims=True)
            partner = threshold * x + math.sqrt(1 - threshold**2) * other
            hits.append(lists.collisions(x, partner))
        found = np.cumsum(np.concatenate(hits), axis=1) if hits else np.ones((1, MOST_LISTS), int)
        enough = [n for n in range(FAMILY_LISTS, MOST_LISTS + 1, 4) if (found[:, n - 1] >= 2).mean() >= recall]
        if enough or bits == 1 or not hits:
            break
        bits -= 1  # longer stretches rather than fewer pairs
    n = enough[0] if enough else FAMILY_LISTS
    lists.guards, lists.lines = lists.guards[:n], lists.lines[:n]
    share = [(found[:, n - 1] >= c).mean() for c in range(1, n + 1)]
    lists.count = max([c for c, at in enumerate(share, 1) if at >= recall], default=1)
    return lists


def _by_length(table: pa.Table, column: str = "v") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors, by the length of the vectors."""
    flat = table.column(column).combine_chunks()
    ends, values = np.asarray(flat.offsets), np.asarray(flat.values)
    size = np.diff(ends)
    for length in np.unique(size):
        own = np.flatnonzero(size == length)
        yield own, values[ends[own][:, None] + np.arange(length)]


def _placed(sound: DataFrame, lists: Lists, first: int | None) -> DataFrame:
    """(rid, list, slot, value): every vector in its stretch of every list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rid = table.column("rid").to_numpy()
            for own, x in _by_length(table):
                for a in range(0, len(own), 1024):
                    some = own[a : a + 1024]
                    stretch, value = lists.places(x[a : a + 1024], first)
                    n, m = stretch.shape
                    yield pa.RecordBatch.from_pydict({
                        "rid": np.repeat(rid[some], m), "list": np.tile(np.arange(m, dtype=np.int32), n),
                        "dims": np.full(n * m, x.shape[1], np.int32), "stretch": stretch.ravel(),
                        "value": value.ravel(),
                    })

    kind = "rid long, list int, dims int, stretch long, value double"
    # equal hashes of different stretches only bring pairs that are verified all the same
    return sound.select("rid", "v").mapInArrow(run, kind).select(
        "rid", "list", F.xxhash64("dims", "list", "stretch").alias("slot"), "value"
    )


def _angles(pairs: DataFrame, lists: Lists) -> DataFrame:
    """``pairs`` (…, x, y) with their cosine and angle in place of the vectors; other lengths go."""
    keep = [c for c in pairs.columns if c not in ("x", "y")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            for own, x in _by_length(table, "x"):
                y = next(y for _, y in _by_length(table.select(["y"]).take(own), "y"))
                cos = cosines(x, y)
                out = table.select(keep).take(own).append_column("cos", pa.array(cos))
                yield from out.append_column(
                    "angle", pa.array(np.arccos(np.clip(cos, -1, 1)))
                ).combine_chunks().to_batches()

    kinds = ", ".join(f"`{c}` {t}" for c, t in pairs.drop("x", "y").dtypes)
    alike = pairs.filter(F.size("x") == F.size("y"))
    return alike.mapInArrow(run, f"{kinds}, cos double, angle double")


def _families(sound: DataFrame, lists: Lists) -> DataFrame:
    """(rid, node, angle) of the vectors that lie close to a leader, node being its rid."""
    vectors = sound.select("rid", "v")
    placed = stable(_placed(sound, lists, FAMILY_LISTS).select("rid", "slot"))
    long = placed.groupBy("slot").agg(F.min("rid").alias("node"), F.count("*").alias("n"))
    long = stable(long.filter(F.col("n") >= LONG).select("slot", "node"))
    named = placed.join(long, "slot").select("rid", "node").distinct()
    leaders = stable(
        long.select("node").distinct().join(vectors.withColumnRenamed("rid", "node"), "node")
        .withColumnRenamed("v", "y")
    )
    # cosines from here on leave no doubt that two members are linked
    half = math.acos(lists.threshold) / 2 - 1e-9

    def near(pairs: DataFrame) -> DataFrame:
        with_x = pairs.join(vectors.withColumnRenamed("v", "x"), "rid")
        return _angles(with_x.join(leaders, "node"), lists).filter(F.col("angle") <= half)

    first = stable(near(named).groupBy("rid").agg(F.min("node").alias("node")))
    # a leader's own leader gathers what the lists have split
    over = first.select(F.col("rid").alias("node"), F.col("node").alias("up"))
    higher = first.join(over, "node").select("rid", F.col("up").alias("node"))
    close = near(first.unionByName(higher).distinct())
    close = close.groupBy("rid").agg(F.min(F.struct("node", "angle")).alias("best"))
    return stable(close.select("rid", "best.node", "best.angle"))


def _meetings(entries: DataFrame, lists: Lists) -> DataFrame:
    """(a, b) of the nodes that collide in at least ``count`` lists, a < b.

    ``entries``: (node, list, slot, low, high), a node's values in a stretch.
    """
    a = entries.select(F.col("node").alias("a"), "list", "slot", "low", "high")
    b = entries.select(
        F.col("node").alias("b"), "slot", F.col("low").alias("from_"), F.col("high").alias("to_")
    )
    w = F.lit(lists.window)
    met = a.join(b.hint("merge"), "slot").filter(
        (F.col("a") < F.col("b")) & (F.col("from_") <= F.col("high") + w) & (F.col("low") <= F.col("to_") + w)
    )
    # families may meet in several stretches of a list, which counts once
    noted = [
        F.bit_or(
            F.expr(f"CASE WHEN list div {WORD} = {k} THEN shiftleft(1L, list % {WORD}) ELSE 0L END")
        ).alias(f"w{k}")
        for k in range(-(-len(lists.lines) // WORD))
    ]
    counted = met.groupBy("a", "b").agg(*noted)
    total = sum((F.bit_count(c) for c in counted.columns[2:]), F.lit(0))
    return counted.filter(total >= lists.count).select("a", "b")


def _open_pairs(pairs: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(rid, n, a, b): links of members of a with members of b, by comparing blocks of them."""
    asked = pairs.select("a", "b")
    needed = asked.select(F.col("a").alias("node")).unionByName(asked.select(F.col("b").alias("node")))
    own = members.join(needed.distinct(), "node", "left_semi")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one node, in blocks; the rows come sorted by node."""
        held: list[tuple[int, bytes]] = []
        last = None

        def block():
            return pa.RecordBatch.from_pydict({
                "node": [last], "rids": [np.array([r for r, _ in held], np.int64).tobytes()],
                "points": [b"".join(p for _, p in held)],
            })

        for batch in batches:
            for node, rid, v in zip(*(batch.column(c).to_pylist() for c in ("node", "rid", "v"))):
                if held and (node != last or len(held) == BLOCK):
                    yield block()
                    held = []
                last = node
                held.append((rid, np.array(v, np.float64).tobytes()))
        if held:
            yield block()

    blocks = stable(
        own.select("node", "rid", "v").repartitionByRange("node", "rid").sortWithinPartitions("node", "rid")
        .mapInArrow(pack, "node long, rids binary, points binary")
    )
    left = blocks.select(F.col("node").alias("a"), F.col("rids").alias("x"), F.col("points").alias("p"))
    right = blocks.select(F.col("node").alias("b"), F.col("rids").alias("y"), F.col("points").alias("q"))
    tiles = asked.join(left, "a").join(right, "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                x, y = np.frombuffer(t["x"], np.int64), np.frombuffer(t["y"], np.int64)
                p = np.frombuffer(t["p"]).reshape(len(x), -1)
                q = np.frombuffer(t["q"]).reshape(len(y), -1)
                linked = np.stack([cosines(np.broadcast_to(one, q.shape), q) >= threshold for one in p])
                rid, n = np.r_[x, y], np.r_[linked.sum(1), linked.sum(0)].astype(np.int64)
                some = n > 0
                yield pa.RecordBatch.from_pydict({
                    "rid": rid[some], "n": n[some], "a": np.full(some.sum(), t["a"]),
                    "b": np.full(some.sum(), t["b"]),
                })

    return tiles.mapInArrow(compare, "rid long, n long, a long, b long")


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98, id_col: str = "vec_id",
    vec_col: str = "embedding", seed: int = 11,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``.

    Rows whose cosine is ``threshold`` or more are linked; ``n_links`` counts the
    rows linked directly, ``component_id`` is the smallest id reachable, and the
    row with that id is kept.  No pair below the threshold is linked; of the pairs
    at it the share ``recall`` is found, of closer ones more.

    Vectors that are NULL, empty or zero, or hold a component that is NULL, NaN
    or infinite link with nothing and are a component of their own, as rows
    without an id and links are, whose component is NULL.  Vectors of different
    lengths are not linked.  Rows that repeat an id are told apart: each is a
    vector of its own, and equal ones are linked.  Of linked rows without an id
    the component is named by those that have one.  Rows with the smallest id
    are all kept, so are rows without an id.  An empty table gives no rows;
    columns of other names are not looked at.
    """
    finite = F.forall(
        F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(F.col("v"), lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = stable(rows.withColumn("sound", F.coalesce(finite, F.lit(False)))).withColumn(
        "rid", F.monotonically_increasing_id()
    )
    rows = stable(rows)
    sound = rows.filter("sound").select("rid", "v")
    sample = sound.orderBy(F.xxhash64(F.lit(seed), "rid")).limit(SAMPLE).collect()
    lists = fit_lists([np.array(r.v) for r in sample], sound.count(), threshold, recall, seed)

    close = _families(sound, lists)
    size = close.groupBy("node").agg(F.count("*").alias("n"), F.max("angle").alias("radius"))
    size = stable(size.filter(F.col("n") >= FAMILY))
    family = stable(close.select("rid", "node").join(size.select("node"), "node"))

    # every vector's node; a vector outside the families is its own
    placed = _placed(sound, lists, None).join(
        family.withColumnRenamed("node", "head"), "rid", "left"
    )
    alone = placed.filter("head IS NULL").select(
        F.col("rid").alias("node"), "list", "slot", F.col("value").alias("low"), F.col("value").alias("high")
    )
    grouped = placed.filter("head IS NOT NULL").groupBy(F.col("head").alias("node"), "list", "slot").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    met = stable(_meetings(stable(alone.unionByName(grouped)), lists))

    def side(c: str, v: str) -> DataFrame:
        named = sound.withColumnRenamed("rid", c).withColumnRenamed("v", v).join(
            size.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("radius").alias(f"r_{c}")),
            c, "left",
        )
        return named.fillna({f"n_{c}": 1, f"r_{c}": 0.0})

    judged = _angles(met.join(side("a", "x"), "a").join(side("b", "y"), "b"), lists)
    limit, reach = math.acos(threshold), F.col("r_a") + F.col("r_b")
    single = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    verdict = (
        F.when(single, F.when(F.col("cos") >= threshold, "all").otherwise("none"))
        .when(F.col("angle") + reach <= limit - 1e-9, "all")
        .when(F.col("angle") - reach > limit + 1e-9, "none")
        .otherwise("open")
    )
    judged = stable(judged.select("a", "b", "n_a", "n_b", verdict.alias("verdict")).filter("verdict <> 'none'"))
    whole = judged.filter("verdict = 'all'")
    members = sound.join(family, "rid", "left").withColumn("node", F.coalesce("node", "rid"))
    partly = stable(_open_pairs(judged.filter("verdict = 'open'"), members, threshold))

    by_node = whole.select(F.col("a").alias("node"), F.col("n_b").alias("n")).unionByName(
        whole.select(F.col("b").alias("node"), F.col("n_a").alias("n"))
    ).unionByName(size.select("node", (F.col("n") - 1).alias("n")))
    by_node = by_node.groupBy("node").agg(F.sum("n").alias("of_node"))
    by_row = partly.groupBy("rid").agg(F.sum("n").alias("of_row"))
    linked = components(whole.select("a", "b").unionByName(partly.select("a", "b").distinct()))

    ids = rows.select("rid", "id", "sound").join(family, "rid", "left")
    ids = ids.withColumn("node", F.coalesce("node", "rid"))
    ids = ids.join(linked, "node", "left").withColumn("root", F.coalesce("component", "node"))
    ids = stable(ids.select("rid", "id", "node", "root"))
    least = ids.groupBy("root").agg(F.min("id").alias("component_id"))
    out = ids.join(least, "root").join(by_node, "node", "left").join(by_row, "rid", "left")
    n_links = F.coalesce("of_node", F.lit(0)) + F.coalesce("of_row", F.lit(0))
    return out.select(
        F.col("id").alias(id_col), n_links.cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
