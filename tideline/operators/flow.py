"""Lags, history, train/test splits and flows over time."""

from __future__ import annotations

import datetime

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tideline.functions.numbers import half_even
from tideline.operators.association import pearson
from tideline.operators.ordering import global_row_number, neighbour

SPLIT = "split"
HASH_STEPS = 1_000_000


def lag_feature(
    df: DataFrame,
    columns: Mapping[str, str],
    order: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """New columns with the previous row's value; the first row has its own."""
    out = neighbour(df, dict(columns), order, by, -1)
    return out.withColumns({new: F.coalesce(new, old) for new, old in columns.items()})


def history_features(
    df: DataFrame,
    means: Mapping[str, str],
    peaks: Mapping[str, str] = {},
    by: Sequence[str] = (),
    digits: int = 1,
) -> DataFrame:
    """Table-wide (or per-key) mean and maximum as columns."""
    aggs = [half_even(F.avg(c), digits).alias(n) for n, c in means.items()]
    aggs += [F.max(c).alias(n) for n, c in peaks.items()]
    if by:
        # rows of a hot key are split by the adaptive skew join
        return df.join(df.groupBy(*by).agg(*aggs), list(by))
    facts = df.agg(*aggs)
    one = facts.select(F.struct(*facts.columns)).scalar()
    return df.withColumns({n: one[n] for n in [*means, *peaks]})


def chrono_split(df: DataFrame, order: Sequence[str], test_size: float = 0.2) -> DataFrame:
    """Mark the first ``int(n * (1 - test_size))`` rows in ``order`` as train, the rest as test.

    When the order starts with a date or a time, rows are counted per day, and
    only the rows of the day that holds the cut are put in order.
    """
    first = df.schema[order[0]].dataType
    if isinstance(first, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _split_by_day(df, order, test_size)
    n = df.count()
    cut = int(n * (1 - test_size))
    numbered = global_row_number(df, order, "_rn")
    part = F.when(F.col("_rn") <= cut, "train").otherwise("test")
    return numbered.withColumn(SPLIT, part).drop("_rn")


def _split_by_day(df: DataFrame, order: Sequence[str], test_size: float) -> DataFrame:
    day = F.to_date(F.col(order[0]))
    # one row per calendar day; a missing day sorts first, as in the order itself
    per_day = df.groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.asc_nulls_first("day")))
    days = per_day.withColumn("upto", upto)
    cut = int((per_day.agg(F.sum("n")).first()[0] or 0) * (1 - test_size))
    holder = days.where(F.col("upto") > cut).orderBy("upto").first()
    if holder is None:
        return df.withColumn(SPLIT, F.lit("train"))
    inside = cut - (holder.upto - holder.n)
    when = F.col(order[0])
    if holder.day is None:
        same, earlier = when.isNull(), F.lit(False)
    else:
        # bounds on the column itself, so that a scan can skip other days
        start, end = (
            F.lit(d).cast(df.schema[order[0]].dataType)
            for d in (holder.day, holder.day + datetime.timedelta(days=1))
        )
        same = F.coalesce((when >= start) & (when < end), F.lit(False))
        earlier = when.isNull() | (when < start)
    rest = df.where(~same).withColumn(SPLIT, F.when(earlier, "train").otherwise("test"))
    if inside == 0:
        edge = df.where(same).withColumn(SPLIT, F.lit("test"))
    else:
        edge = global_row_number(df.where(same), order, "_rn")
        part = F.when(F.col("_rn") <= inside, "train").otherwise("test")
        edge = edge.withColumn(SPLIT, part).drop("_rn")
    return rest.unionByName(edge)


def random_split(
    df: DataFrame,
    key: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    exact: bool = False,
) -> DataFrame:
    """Mark rows by a seeded hash of ``key``: the same rows on any partitioning.

    With ``exact``, the test part has ``ceil(n * test_size)`` rows, those with
    the lowest hashes.
    """
    draw = F.xxhash64(*[F.col(c) for c in key], F.lit(seed))
    if not exact:
        low = F.pmod(draw, F.lit(HASH_STEPS)) < F.lit(int(test_size * HASH_STEPS))
        return df.withColumn(SPLIT, F.when(low, "test").otherwise("train"))
    size = -int(-(df.count() * test_size) // 1)
    numbered = global_row_number(df.withColumn("_draw", draw), ["_draw", *key], "_rn")
    part = F.when(F.col("_rn") <= size, "test").otherwise("train")
    return numbered.withColumn(SPLIT, part).drop("_rn", "_draw")


def lag_corr(
    df: DataFrame,
    a: str,
    b: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    digits: int = 3,
) -> DataFrame:
    """Correlation of ``a`` with the next row's ``b``."""
    columns = list(dict.fromkeys([*by, *order, a, b]))
    pairs = neighbour(df.select(*columns), {"_next": b}, order, by, 1)
    x, y = F.col(a).cast("double"), F.col("_next").cast("double")
    both = x.isNotNull() & y.isNotNull()
    return pairs.agg(
        half_even(pearson(x, y, both), digits).alias("lag_correlation"),
        F.count_if(both).alias("pairs"),
    )


def transition_matrix(
    df: DataFrame,
    entity: Sequence[str],
    state: str,
    order: Sequence[str],
    digits: int | None = 4,
) -> DataFrame:
    """How often each state of an entity is followed by each other, and with what share."""
    columns = list(dict.fromkeys([*entity, *order, state]))
    steps = neighbour(df.select(*columns), {"to_state": state}, order, entity, 1)
    counts = (
        steps.where(F.col("to_state").isNotNull() & F.col(state).isNotNull())
        .groupBy(F.col(state).alias("from_state"), "to_state")
        .agg(F.count("*").alias("n"))
    )
    # at most one row per pair of states
    share = F.col("n") / F.sum("n").over(Window.partitionBy("from_state"))
    return counts.withColumn("probability", share if digits is None else half_even(share, digits))
