"""Correlations from one pass of partial sums."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.numbers import half_even
from tideline.operators.ordering import ranks_by_row


def pearson(x: Column, y: Column, where: Column | None = None) -> Column:
    """Correlation as an aggregate; NULL where either side is constant.

    The built-in ``corr`` raises on a constant column in ANSI mode.
    """
    if where is not None:
        x, y = F.when(where, x), F.when(where, y)
    flat = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y)) | (F.count(x) < 2)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(~flat, F.try_divide(F.covar_pop(x, y), spread))


def corr_matrix(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "pearson",
    deletion: str = "listwise",
    digits: int | None = 3,
    undefined: float | None = None,
) -> DataFrame:
    """Rows (a, b, r) for every ordered pair of ``columns``.

    ``deletion`` drops rows with any gap ("listwise") or per pair ("pairwise").
    A constant column gives ``undefined``.
    """
    if method not in ("pearson", "spearman") or deletion not in ("listwise", "pairwise"):
        raise ValueError("method is pearson or spearman, deletion listwise or pairwise")
    columns = list(columns)
    if method == "spearman":
        return _spearman(df, columns, deletion, digits, undefined)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if deletion == "listwise":
        data = data.na.drop()
    gaps = deletion == "pairwise"
    aggs, rows = [], []
    for i, a in enumerate(columns):
        for j in range(i, len(columns)):
            x, y = F.col(a), F.col(columns[j])
            name = f"r{i}_{j}"
            # without gaps the sums of a column are shared by all its pairs
            both = x.isNotNull() & y.isNotNull() if gaps else None
            aggs.append(pearson(x, y, both).alias(name))
            for p, q in {(i, j), (j, i)}:
                rows.append(
                    F.struct(
                        F.lit(columns[p]).alias("a"), F.lit(columns[q]).alias("b"),
                        F.col(name).alias("r"),
                    )
                )
    return _told(data.agg(*aggs).select(F.inline(F.array(*rows))), digits, undefined)


def _told(out: DataFrame, digits: int | None, undefined: float | None) -> DataFrame:
    if digits is not None:
        out = out.withColumn("r", half_even("r", digits))
    return out if undefined is None else out.na.fill(undefined, subset=["r"])


def _spearman(
    df: DataFrame, columns: list[str], deletion: str, digits: int | None, undefined: float | None
) -> DataFrame:
    """Correlation of ranks; pairwise, each pair is ranked among the rows that have both."""
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    whole = reduce(lambda a, b: a & b, [v.isNotNull() for v in value.values()])
    lists, pairs = [], []
    if deletion == "listwise":
        lists = [F.when(whole, v) for v in value.values()]
        pairs = [(i, j, i, j) for i, j in combinations_with_replacement(range(len(columns)), 2)]
    else:
        for i, j in combinations_with_replacement(range(len(columns)), 2):
            x, y = value[columns[i]], value[columns[j]]
            if i == j:
                lists.append(x)
                pairs.append((i, i, len(lists) - 1, len(lists) - 1))
            else:
                lists += [F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)]
                pairs.append((i, j, len(lists) - 2, len(lists) - 1))
    ranked = ranks_by_row(df, lists)
    aggs = [pearson(F.col(f"rank{a}"), F.col(f"rank{b}")).alias(f"r{n}") for n, (_, _, a, b) in enumerate(pairs)]
    rows = [
        F.struct(F.lit(columns[p]).alias("a"), F.lit(columns[q]).alias("b"), F.col(f"r{n}").alias("r"))
        for n, (i, j, _, _) in enumerate(pairs) for p, q in {(i, j), (j, i)}
    ]
    return _told(ranked.agg(*aggs).select(F.inline(F.array(*rows))), digits, undefined)
