"""Many k-means fits in one: every round is one scan for all starts and all k.

The centre sets of all fits travel together.  A task measures its rows against
all of them with one matrix product and returns, per set and centre, the count
and the sums of its rows, so what reaches the driver has the size of the centres.
The points of a long fit are dealt evenly and packed into blocks once.  A set whose centres stand still
leaves the rounds.  Starts are drawn by distance from a bounded sample.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tideline.session import stable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 10_000  # rows that starts are drawn from
ROWS = 4096  # rows measured at once, fewer if there are so many centres
CELLS = 1 << 18  # distances held at once
TASK_ROWS = 500_000  # rows of a task


@dataclass
class Fit:
    centres: np.ndarray
    cost: float = 0.0
    rounds: int = 0
    done: bool = False


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """The points of a task as matrices, from packed blocks or from one array a row."""
    for batch in batches:
        column = batch.column(0)
        if pa.types.is_list(column.type):
            yield np.asarray(column.flatten(), np.float64).reshape(-1, dims)
        else:
            yield from (np.frombuffer(b.as_buffer(), np.float64).reshape(-1, dims) for b in column)


def packed(points: DataFrame, rows: int) -> DataFrame:
    """The points dealt evenly and written as blocks of doubles, for many rounds.

    A small table would else lie in as few partitions as its join left, and each
    round would turn every row into a Python array anew.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = np.asarray(batch.column(0).flatten(), np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], ["block"])

    parts = max(points.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))
    return stable(points.repartition(parts).mapInArrow(run, "block binary"))


def _sums(points: DataFrame, sets: Sequence[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per set: counts and sums of the rows nearest to each centre, and the total squared distance."""
    dims, firsts = sets[0].shape[1], np.cumsum([0, *[len(c) for c in sets]])
    whole = np.concatenate(sets)
    size = (whole * whole).sum(axis=1)[:, None]
    rows = int(np.clip(CELLS // len(whole), 64, ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row per centre: sums by axis, then the count
        total, cost = np.zeros((len(whole), dims + 1)), np.zeros(len(sets))
        for block in _blocks(batches, dims):
            for a in range(0, len(block), rows):
                x = block[a : a + rows]
                # a row per centre, so that a set is compared centre by centre in whole vectors
                away, own = size - 2.0 * (whole @ x.T), (x * x).sum()
                member = np.empty(away.shape)
                for s in range(len(sets)):
                    lo, hi = firsts[s], firsts[s + 1]
                    best, near = away[lo].copy(), np.zeros(len(x), np.int32)
                    for j in range(1, hi - lo):
                        near[away[lo + j] < best] = j
                        np.minimum(best, away[lo + j], out=best)
                    cost[s] += own + best.sum()
                    for j in range(hi - lo):
                        member[lo + j] = near == j
                total += member @ np.concatenate([x, np.ones((len(x), 1))], axis=1)
        if total[:, -1].any():
            sums = pa.array([np.r_[total.ravel(), cost]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([sums], ["sums"])

    # one row of sums a task, of the size of the centres
    cells, cost = np.zeros((len(whole), dims + 1)), np.zeros(len(sets))
    for r in points.mapInArrow(run, "sums array<double>").collect():
        sums = np.array(r.sums)
        cells, cost = cells + sums[: cells.size].reshape(cells.shape), cost + sums[cells.size :]
    cut = lambda x, s: x[firsts[s] : firsts[s + 1]]
    return {
        s: (cut(cells[:, -1], s), cut(cells[:, :-1], s), max(float(cost[s]), 0.0)) for s in range(len(sets))
    }


def fit_from(
    points: DataFrame, starts: Sequence[np.ndarray], rounds: int = 300, tol: float = 1e-4
) -> list[Fit]:
    """Lloyd's rounds from each set of centres, all sets in the same scans.

    ``points`` has one array column without gaps, or is ``packed``.  A centre without rows stays
    where it is.  A set ends when no centre moved by more than ``tol`` or after
    ``rounds``; its cost belongs to the centres it ended with.  Sets end after as
    many scans as their own rounds, and one more scan gives all costs.
    """
    fits = [Fit(np.asarray(s, np.float64)) for s in starts]
    for _ in range(rounds):
        live = [f for f in fits if not f.done]
        if not live:
            break
        for s, (count, total, _) in _sums(points, [f.centres for f in live]).items():
            fit = live[s]
            moved = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], fit.centres)
            fit.done = bool(np.sqrt(((moved - fit.centres) ** 2).sum(axis=1)).max() <= tol)
            fit.centres, fit.rounds = moved, fit.rounds + 1
    for s, (_, _, cost) in _sums(points, [f.centres for f in fits]).items():
        fits[s].cost = cost
    return fits


def draw_sample(points: DataFrame, n: int, seed: int, rows: int = SAMPLE) -> np.ndarray:
    """About ``rows`` of the ``n`` points, the same ones for the same points; all if there are fewer."""
    (column,) = points.columns
    mark = F.xxhash64(F.lit(seed), column)
    # thinned before it is ordered, so that no task gets more than the sample
    kept = points.filter(F.pmod(mark, F.lit(n)) < 2 * rows) if n > 4 * rows else points
    return np.array([r[0] for r in kept.orderBy(mark, column).limit(rows).collect()], np.float64)


def spread_start(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k points of the sample, each drawn with the square of its distance to those before."""
    at = [int(rng.integers(len(sample)))]
    near = ((sample - sample[at[0]]) ** 2).sum(axis=1)
    while len(at) < k:
        whole = near.sum()
        # all points lie on a centre: repeat one
        at.append(int(rng.choice(len(sample), p=near / whole)) if whole > 0 else at[0])
        near = np.minimum(near, ((sample - sample[at[-1]]) ** 2).sum(axis=1))
    return sample[at]


def fit_all(
    points: DataFrame, ks: Sequence[int], restarts: int, seed: int, rounds: int = 300, tol: float = 1e-4
) -> dict[int, Fit]:
    """The best of ``restarts`` fits for each k, the first one on ties."""
    n = points.count()
    sample = draw_sample(points, n, seed)
    starts = [(k, spread_start(sample, k, np.random.default_rng([seed, k, i])))
              for k in ks for i in range(restarts)]
    fits = fit_from(packed(points, n), [s for _, s in starts], rounds, tol)
    best: dict[int, Fit] = {}
    for (k, _), fit in zip(starts, fits):
        if k not in best or fit.cost < best[k].cost:
            best[k] = fit
    return best
