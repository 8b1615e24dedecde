"""Exact interpolated quantiles of large columns.

The built-in ``percentile`` keeps every distinct value of a group in one task.
Here a mergeable sketch first brackets each wanted rank, two counts prove that
the bracket holds it, and only the few rows inside are counted by value.  Each
round keeps about one row in a thousand; it repeats until the rest is small.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tideline.functions.numbers import number

ACCURACY = 10_000
# rows of a bracket that are few enough to be counted by value
ROW_LIMIT = 1_000_000


@dataclass
class Target:
    """One wanted rank, the values known to enclose it, and the rows at and between them."""

    metric: str
    prob: float
    n: int
    between: int
    floor: float | None = None
    ceil: float | None = None
    below: int = 0
    at_floor: int = 0

    @property
    def position(self) -> float:
        return (self.n - 1) * self.prob

    @property
    def low(self) -> int:
        return math.floor(self.position)

    @property
    def high(self) -> int:
        return math.ceil(self.position)

    @property
    def value(self):
        return number(self.metric)

    def inside(self):
        kept = F.lit(True)
        if self.floor is not None:
            kept = kept & (self.value > self.floor)
        if self.ceil is not None:
            kept = kept & (self.value < self.ceil)
        return F.when(kept, self.value)

    def enclosed(self):
        kept = F.lit(True)
        if self.floor is not None:
            kept = kept & (self.value >= self.floor)
        if self.ceil is not None:
            kept = kept & (self.value <= self.ceil)
        return F.when(kept, self.value)


def _narrow(df: DataFrame, targets: list[Target], slack: float) -> bool:
    """Move the enclosing values of ``targets`` closer; False if none could be moved.

    Only rows strictly between the two values are looked at, so a value that
    holds many rows is passed in one step.
    """
    # targets with one bracket share a sketch
    shared: dict[tuple, list[Target]] = {}
    for t in targets:
        shared.setdefault((t.metric, t.floor, t.ceil), []).append(t)
    sketches, wanted = [], []
    for group in shared.values():
        ends = []
        for t in group:
            start = t.below + t.at_floor
            lo = (t.low - start) / t.between - slack
            hi = (t.high - start + 1) / t.between + slack
            wanted.append((t, lo >= 0 or t.floor is None, hi <= 1 or t.ceil is None))
            ends += [min(max(lo, 0.0), 1.0), min(max(hi, 0.0), 1.0)]
        sketches.append(F.percentile_approx(group[0].inside(), ends, ACCURACY))
    found = df.agg(*[s.alias(f"s{i}") for i, s in enumerate(sketches)]).first()
    ends = [float(v) for pair in found for v in pair]
    tried = [
        (t, ends[2 * i] if left else t.floor, ends[2 * i + 1] if right else t.ceil)
        for i, (t, left, right) in enumerate(wanted)
    ]
    return _enclose(df, tried)


def _enclose(df: DataFrame, tried: list[tuple[Target, float, float]]) -> bool:
    """Take over the values that counts prove to enclose their targets; False if none do."""
    counts = []
    for i, (t, lo, hi) in enumerate(tried):
        v = t.value
        counts += [
            F.count_if(v < lo).alias(f"below{i}"), F.count_if(v == lo).alias(f"floor{i}"),
            F.count_if((v > lo) & (v < hi)).alias(f"between{i}"),
            F.count_if(v == hi).alias(f"ceil{i}"),
        ]
    got = df.agg(*counts).first()
    moved = False
    for i, (t, lo, hi) in enumerate(tried):
        below, at_floor = got[f"below{i}"], got[f"floor{i}"]
        between, at_ceil = got[f"between{i}"], got[f"ceil{i}"]
        upto = below + at_floor + between + (at_ceil if hi > lo else 0)
        # a sketch may miss; the counts prove that both positions are enclosed
        if below <= t.low and t.high < upto and (lo, hi) != (t.floor, t.ceil):
            t.floor, t.ceil, t.below, t.at_floor, t.between = lo, hi, below, at_floor, between
            moved = True
    return moved


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float],
    known: Mapping[tuple[str, float], tuple[int, float, float]] | None = None,
) -> DataFrame:
    """Rows (metric, prob, value) with linear interpolation; NULL and NaN are left out.

    A column without values has no rows.  ``known`` gives, from a sketch that is
    there already, the number of values of (metric, prob) and two that should
    enclose its rank: no pass counts or sketches then, one proves the two.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    known = known or {}
    rest = [c for c in columns if any((c, p) not in known for p in probs)]
    sizes = {c: n for (c, _), (n, _, _) in known.items()}
    if rest:
        sizes.update(df.agg(*[F.count(number(c)).alias(c) for c in rest]).first().asDict())
    targets = [
        Target(c, p, sizes[c], between=sizes[c]) for c in columns for p in probs if sizes.get(c)
    ]
    if not targets:
        return df.sparkSession.createDataFrame([], "metric string, prob double, value double")
    tried = [(t, *known[t.metric, t.prob][1:]) for t in targets if (t.metric, t.prob) in known]
    if tried:
        _enclose(df, tried)
    slack = first = 3.0 / ACCURACY
    open_ = [t for t in targets if t.between > ROW_LIMIT]
    while open_:
        if _narrow(df, open_, slack):
            slack = first
        elif slack < 0.5:
            slack *= 4
        else:
            raise RuntimeError("the sketch does not enclose the wanted ranks")
        open_ = [t for t in open_ if t.between > ROW_LIMIT]

    # targets with one bracket share its rows
    brackets: dict[tuple, list[Target]] = {}
    for t in targets:
        brackets.setdefault((t.metric, t.floor, t.ceil), []).append(t)
    groups = list(brackets.values())
    cells = [
        F.struct(F.lit(i).alias("bracket"), group[0].enclosed().alias("value"))
        for i, group in enumerate(groups)
    ]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("bracket", "value")
        .agg(F.count("*").alias("cnt"))
    )
    # at most ROW_LIMIT distinct values and two ends per bracket
    upto = F.sum("cnt").over(Window.partitionBy("bracket").orderBy("value"))
    fact = lambda j, make: F.get(
        F.array(*[make(g[j]) if j < len(g) else F.lit(None) for g in groups]), F.col("bracket")
    )
    ends, picked = [], []
    for j in range(max(map(len, groups))):
        for end, at in (("a", "low"), ("b", "high")):
            rank = fact(j, lambda t: F.lit(getattr(t, at) - t.below))
            ends.append(F.min(F.when(F.col("upto") > rank, F.col("value"))).alias(f"{end}{j}"))
        low, high = F.col(f"a{j}"), F.col(f"b{j}")
        part = fact(j, lambda t: F.lit(t.position - t.low))
        value = F.when(low == high, low).otherwise(low + (high - low) * part)
        picked.append(
            F.struct(
                fact(j, lambda t: F.lit(t.metric)).alias("metric"),
                fact(j, lambda t: F.lit(t.prob)).alias("prob"), value.alias("value"),
            )
        )
    found = counts.withColumn("upto", upto).groupBy("bracket").agg(*ends)
    return found.select(F.inline(F.array(*picked))).where(F.col("metric").isNotNull())


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[tuple[str, float], float]:
    """The quantiles as numbers, for use as literals that a scan can push down."""
    rows = exact_quantiles(df, columns, probs).collect()
    return {(r.metric, r.prob): r.value for r in rows}


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """Rows (metric, prob, value) from one sketch pass; an existing value, not interpolated."""
    probs = [float(p) for p in probs]
    cells = [
        F.struct(F.lit(c).alias("metric"), F.percentile_approx(c, probs, accuracy).alias("value"))
        for c in columns
    ]
    rows = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    rows = rows.withColumn("prob", F.array(*[F.lit(p) for p in probs]))
    return rows.select("metric", F.inline(F.arrays_zip("prob", "value")))
