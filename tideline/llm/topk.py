"""Exact top-k search by inner product on a bit-sliced index.

The index holds blocks of ``ROWS`` vectors.  A block's components, less their
smallest value, are unsigned numbers; slice (d, b) is the bitmap of the rows
whose component d has bit b.  A query adds, for every set bit j of |q_d|, the
slices of component d, shifted by j, to a bit-sliced sum; a negative q_d adds
the complements, which differs by a constant.  Additions are carry-save: three
numbers become two by a few bitmap operations, and carries run through once at
the end.  The top rows are then selected from the most significant slice of the
sums downward; the rows that still tie at the last slice have equal scores, and
the smallest ids among them are taken, so the boundary is exact.

Blocks of queries meet blocks of the index in cells of a grid; every cell
returns its best k per query and a window merges them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import stable

ROWS, QUERIES = 16_384, 512


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v): components as floor(scale * x); rows that take part only."""
    sound = F.forall(
        vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids (ascending) and components of a partition's vectors, by their length."""
    tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.concat_tables(tables).combine_chunks()
    ids, column = table.column("id").to_numpy(), table.column("v").combine_chunks()
    ends, flat = np.asarray(column.offsets), np.asarray(column.values)
    size = np.diff(ends)
    for length in np.unique(size):
        own = np.flatnonzero(size == length)
        own = own[np.argsort(ids[own], kind="stable")]
        yield ids[own], flat[ends[own][:, None] + np.arange(length)]


def slices_of(x: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Smallest value, number of bits and bitmaps (components x bits x words) of a block."""
    low = int(x.min()) if x.size else 0
    bits = int(x.max() - low).bit_length() if x.size else 0
    words = -(-len(x) // 64)
    out = np.zeros((x.shape[1], bits, words * 8), np.uint8)
    shifted = (x - low).astype(np.uint64)
    for b in range(bits):
        flags = ((shifted >> np.uint64(b)) & np.uint64(1)).astype(bool)
        packed = np.packbits(flags, axis=0, bitorder="little").T
        out[:, b, : packed.shape[1]] = packed
    return low, bits, out.view(np.uint64)


class Sums:
    """Bit-sliced sum in carry-save form: the value is ``one + two``."""

    def __init__(self, width: int, words: int):
        self.one = np.zeros((width, words), np.uint64)
        self.two = np.zeros((width, words), np.uint64)
        self.half = np.empty((width, words), np.uint64)
        self.both = np.empty((width, words), np.uint64)

    def add(self, number: np.ndarray, shift: int = 0) -> None:
        """Three numbers to two: parity stays, majority carries to the next slice."""
        one, two, half, both = self.one, self.two, self.half, self.both
        np.bitwise_xor(one, two, out=half)
        np.bitwise_and(one, two, out=both)
        place = slice(shift, shift + len(number))
        np.copyto(one, half)
        one[place] ^= number
        half[place] &= number
        both[place] |= half[place]
        two[1:] = both[:-1]
        two[0] = 0

    def total(self) -> np.ndarray:
        """Plain slices, carries run through."""
        out, carry = np.empty_like(self.one), np.zeros(self.one.shape[1], np.uint64)
        for r in range(len(out)):
            a, b = self.one[r], self.two[r]
            half = a ^ b
            out[r] = half ^ carry
            carry = (a & b) | (half & carry)
        return out


def scores(slices: np.ndarray, low: int, query: np.ndarray) -> tuple[np.ndarray, int]:
    """Bit-sliced sums of a block for one query, and the constant to add to them."""
    dims, bits, words = slices.shape
    size = [abs(int(q)) for q in query]
    top = max([q.bit_length() for q in size], default=0)
    width = bits + top + max(1, dims).bit_length() + 1
    whole = Sums(width, words)
    full = (1 << bits) - 1
    constant = low * int(sum(int(q) for q in query)) - full * sum(-int(q) for q in query if q < 0)
    own = bits + max(1, dims).bit_length() + 1
    for j in range(top):
        part, used = Sums(own, words), False
        for d, q in enumerate(size):
            if q >> j & 1:
                part.add(slices[d] if query[d] > 0 else ~slices[d])
                used = True
        if used:
            whole.add(part.one[: width - j], j)
            whole.add(part.two[: width - j], j)
    return whole.total(), constant


def best(total: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """Row numbers of the k largest sums, smallest row first among equals, and the sums."""
    sure, open_, have = np.zeros_like(allowed), allowed, 0
    if int(np.bitwise_count(open_).sum()) <= k:
        sure, open_ = open_, np.zeros_like(open_)
    else:
        for r in range(len(total) - 1, -1, -1):
            upper = open_ & total[r]
            n = have + int(np.bitwise_count(upper).sum())
            if n > k:
                open_ = upper
            elif n == k:
                sure, open_, have = sure | upper, np.zeros_like(open_), n
                break
            else:
                sure, open_, have = sure | upper, open_ & ~total[r], n
    places = lambda bitmap: np.flatnonzero(
        np.unpackbits(bitmap.view(np.uint8), bitorder="little")
    )
    rows = np.concatenate([places(sure), places(open_)[: max(0, k - have)]])
    word, bit = rows >> 6, (rows & 63).astype(np.uint64)
    taken = (total[:, word] >> bit) & np.uint64(1)
    return rows, [sum(int(b) << r for r, b in enumerate(column)) for column in taken.T]


def build_index(found: DataFrame, rows: int = ROWS) -> DataFrame:
    """(block, n, dims, bits, low, ids, slices): every vector in a block of about ``rows``."""
    blocks = max(1, -(-found.count() // rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        for ids, x in _by_length(batches):
            low, bits, slices = slices_of(x)
            yield pa.RecordBatch.from_pydict(
                {"block": [block], "n": [len(ids)], "dims": [x.shape[1]], "bits": [bits],
                 "low": [low], "ids": [ids.astype(np.int64).tobytes()], "slices": [slices.tobytes()]}
            )

    return stable(found.repartition(blocks).mapInArrow(
        run, "block bigint, n bigint, dims bigint, bits bigint, low bigint, ids binary, slices binary"
    ))


def query_blocks(found: DataFrame, rows: int = QUERIES) -> DataFrame:
    """(part, dims, ids, values): the queries in blocks of about ``rows``."""
    blocks = max(1, -(-found.count() // rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for ids, x in _by_length(batches):
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "dims": [x.shape[1]], "ids": [ids.astype(np.int64).tobytes()],
                 "values": [x.astype(np.int64).tobytes()]}
            )

    return stable(found.repartition(blocks).mapInArrow(
        run, "part bigint, dims bigint, ids binary, values binary"
    ))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
    vec_col: str = "embedding", scale: int = 256, rows: int = ROWS, query_rows: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the largest integer inner product.

    Both tables have ``id_col`` and ``vec_col``; components count as
    floor(scale * x).  Ties go to the smaller id.  Rows with the query's own id
    are no candidates, and only vectors of the query's length are.  Rows without
    an id, without a vector, or with a component that is NULL, NaN or infinite
    take no part; a vector of length 0 scores 0.  A row that is repeated counts
    as often as it stands there, as candidate and as query.  Fewer than k
    candidates are all returned; empty tables give an empty result.  Scores must
    fit into a long.

    Blocks are dealt evenly whatever the ids, so equal vectors or ids make no
    block larger than others.
    """
    index = build_index(quantised(vectors, id_col, vec_col, scale), rows)
    asked = query_blocks(quantised(queries, id_col, vec_col, scale), query_rows)
    parts, blocks = (
        t.agg(F.max(c)).first()[0] for t, c in ((asked, "part"), (index, "block"))
    )
    # the grid: a copy of each index block per query block and the other way round
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts or 0)).cast("array<bigint>")))
    right = asked.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks or 0)).cast("array<bigint>"))
    ).select("block", "part", "dims", F.col("ids").alias("asked"), "values")
    cells = left.join(right.hint("merge"), ["block", "part", "dims"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                ids = np.frombuffer(cell["ids"], np.int64)
                slices = np.frombuffer(cell["slices"], np.uint64).reshape(
                    cell["dims"], cell["bits"], -(-cell["n"] // 64)
                )
                names = np.frombuffer(cell["asked"], np.int64)
                values = np.frombuffer(cell["values"], np.int64).reshape(len(names), cell["dims"])
                everyone = np.ones(-(-len(ids) // 64) * 64, bool)
                everyone[len(ids) :] = False
                out = {c: [] for c in ("asker", "query_id", "vec_id", "score")}
                for number, (name, query) in enumerate(zip(names.tolist(), values)):
                    first, last = np.searchsorted(ids, [name, name + 1])
                    everyone[first:last] = False
                    allowed = np.packbits(everyone, bitorder="little").view(np.uint64)
                    everyone[first:last] = True
                    total, constant = scores(slices, cell["low"], query)
                    picked, sums = best(total, allowed, k)
                    out["asker"] += [cell["part"] << 32 | number] * len(picked)
                    out["query_id"] += [name] * len(picked)
                    out["vec_id"] += ids[picked].tolist()
                    out["score"] += [s + constant for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.int64()) for v in out.values()], list(out)
                )

    found = cells.mapInArrow(run, "asker bigint, query_id bigint, vec_id bigint, score bigint")
    # vectors of another length have another dims, so one query row stands in one place
    order = Window.partitionBy("asker", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def divisible(vectors: DataFrame, id_col: str = "vec_id", by: int = 50) -> DataFrame:
    """The stated query set: rows whose id is divisible by ``by``."""
    return vectors.filter(F.col(id_col) % by == 0)
