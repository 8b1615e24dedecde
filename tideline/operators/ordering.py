"""Positions, running totals, ranks and neighbours over a total order.

A window without PARTITION BY would send all rows to one task, and a window
partitioned by a hot key would send that key's rows to one task.  Here the rows
are range-partitioned on the whole sort key, so a hot key is split as well, and
partitions are joined up through one small row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.session import stable

PART, POS = "_part", "_pos"
# monotonically_increasing_id keeps the position within the partition here
POS_MASK = (1 << 33) - 1
BROADCAST_ROWS = 200_000


def ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Range-partition and sort, with partition number and position, written once.

    Rows that are equal in ``order`` are told apart by a hash of the whole row:
    the positions are reproducible, and a hot sort key can still be split.
    """
    if not order:
        raise ValueError("an explicit order is needed")
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    keys = [*order, F.xxhash64(*hashable)]
    return stable(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(POS_MASK)))
    )


def part_offsets(df: DataFrame, total: Column, name: str) -> DataFrame:
    """Sum of ``total`` over all earlier partitions, one row per partition."""
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(PART).agg(total.alias("_sum"))
    return sums.select(PART, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias(name))


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """1-based position in ``order``, without a single-task window."""
    return sequence_features(df, order, name)


def sequence_features(
    df: DataFrame, order: Sequence[str | Column], number: str = "rn",
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """Position in ``order`` and, with ``previous`` (new name: column), the previous row's values.

    One range shuffle serves both.
    """
    rows = ranged(df, order)
    offsets = part_offsets(rows, F.count("*"), "_before")
    out = _adjacent(rows, previous, [], -1) if previous else rows
    return (
        out.join(F.broadcast(offsets), PART)
        .withColumn(number, F.col("_before") + F.col(POS) + 1)
        .drop(PART, POS, "_before")
    )


def running_total(
    df: DataFrame, order: Sequence[str | Column], weight: str, name: str = "total"
) -> DataFrame:
    """Sum of ``weight`` over all rows up to and including this one."""
    rows = ranged(df, order)
    offsets = part_offsets(rows, F.sum(weight), "_before")
    so_far = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_here", F.sum(weight).over(so_far))
        .join(F.broadcast(offsets), PART)
        .withColumn(name, F.col("_before") + F.col("_here"))
        .drop(PART, POS, "_before", "_here")
    )


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (metric, value) for the non-NULL numbers of ``columns``."""
    cells = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def average_rank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank of each distinct value per column, ties sharing their mean rank.

    Gives (metric, value, cnt, rank).  Equal values are counted before anything
    is ordered, so a hot value is one row.
    """
    counts = long_form(df, columns).groupBy("metric", "value").agg(F.count("*").alias("cnt"))
    totals = running_total(counts, ["metric", "value"], "cnt", "upto")
    # one row per column: where its values start in the running total
    starts = totals.groupBy("metric").agg(F.min(F.col("upto") - F.col("cnt")).alias("_start"))
    before = F.col("upto") - F.col("cnt") - F.col("_start")
    return totals.join(F.broadcast(starts), "metric").select(
        "metric", "value", "cnt", (before + (F.col("cnt") + 1) / 2).alias("rank")
    )


def with_ranks(
    df: DataFrame, columns: Sequence[str], suffix: str = "_rank", limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Attach the average rank of each column.

    The ranks of a column with at most ``limit`` distinct values are broadcast.
    Of a larger one, only values that hold more than a thousandth of the rows
    are (there are fewer than a thousand); their rows get a spread key in the
    shuffle join for the other values.
    """
    ranks = stable(average_rank(df, columns))
    sizes = {r.metric: r["count"] for r in ranks.groupBy("metric").count().collect()}
    n = ranks.groupBy("metric").agg(F.sum("cnt").alias("_n"))
    ranks = ranks.join(F.broadcast(n), "metric").withColumn(
        "_is_hot", F.col("cnt") * 1000 > F.col("_n")
    )
    names = df.columns
    out = df
    for c in columns:
        mine = ranks.where(F.col("metric") == c)
        if sizes.get(c, 0) <= limit:
            few = mine.select(F.col("value").alias("_key"), F.col("rank").alias(c + suffix))
            out = out.join(
                F.broadcast(few), F.col(c).cast("double") == F.col("_key"), "left"
            ).drop("_key")
            continue
        hot = mine.where("_is_hot").select(
            F.col("value").alias("_hot_value"), F.col("rank").alias("_hot_rank")
        )
        cold = mine.where("NOT _is_hot").select(
            F.col("value").alias("_key"), F.lit(0).alias("_salt"), F.col("rank").alias("_cold_rank")
        )
        value = F.col(c).cast("double")
        spread = F.pmod(F.xxhash64(*[F.col(x) for x in names]), F.lit(4096)).cast("int")
        settled = F.col("_hot_rank").isNotNull() | value.isNull()
        out = (
            out.join(F.broadcast(hot), value == F.col("_hot_value"), "left")
            .withColumn("_key", F.when(~settled, value))
            .withColumn("_salt", F.when(settled, spread).otherwise(F.lit(0)))
            .join(cold, ["_key", "_salt"], "left")
            .withColumn(c + suffix, F.coalesce("_hot_rank", "_cold_rank"))
            .drop("_hot_value", "_hot_rank", "_cold_rank", "_key", "_salt")
        )
    return out


HOT_SHARE, HOT_SPREAD = 200, 64  # a value with more than a 200th of the rows goes to 64 places
FEW_SHARE = 1000  # a list whose values hold as many rows each on average is ranked by its values


def _ordered_bits(df: DataFrame) -> DataFrame:
    """All columns, doubles, as longs in the same order; zero and minus zero are one.

    Windows normalise doubles in their keys, which would undo a range shuffle.
    """
    # a step of its own, so that every value is converted once; the method takes no NULL
    bits = lambda c: F.reflect(
        F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(c, F.lit(0.0)) + F.lit(0.0)
    ).cast("long")
    raw = df.select(*df.columns, *[bits(F.col(c)).alias(f"{c}_bits") for c in df.columns])
    ordered = lambda b: F.when(b >= 0, b).otherwise(b.bitwiseXOR(F.lit(2**63 - 1)))
    return raw.select(
        *[F.when(F.col(c).isNotNull(), ordered(F.col(f"{c}_bits"))).alias(c) for c in df.columns]
    )


def _counted_ranks(base: DataFrame, few: Sequence[int]) -> DataFrame:
    """``base`` with ``rank`` columns of the lists ``few``, whose counted values are broadcast."""
    cells = [F.struct(F.lit(i).alias("list"), F.col(f"v{i}").alias("value")) for i in few]
    counts = base.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    # one row per list and value
    upto = Window.partitionBy("list").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranks = stable(
        counts.groupBy("list", "value").agg(F.count("*").alias("cnt")).select(
            "list", "value", (F.sum("cnt").over(upto) - (F.col("cnt") - 1) / 2).alias("rank")
        )
    )
    for i in few:
        mine = ranks.where(F.col("list") == i).select(F.col("value").alias(f"v{i}"), F.col("rank").alias(f"rank{i}"))
        base = base.join(F.broadcast(mine), f"v{i}", "left")
    return base


def ranks_by_row(df: DataFrame, lists: Sequence[Column]) -> DataFrame:
    """``rank0``, ``rank1`` and so on: each row's rank in each list; rows that are in no list are left out.

    Each expression is a list of its own, ties share their mean rank, and rows
    where it is NULL or NaN are not in it.  Lists of few values are ranked by
    counting these.  All others are ranked by one range
    shuffle of (list, value, row), which carries the ranks known by then, and are
    brought together by one shuffle on the row, however many there are; a single
    one needs none.  Values that hold many rows are named by a sketch and
    spread over places; what a place holds is counted where it lies.
    """
    cells = [F.when(~F.isnan(c.cast("double")), c.cast("double")) for c in lists]
    values = df.select(*[c.alias(f"v{i}") for i, c in enumerate(cells)])
    base = stable(_ordered_bits(values).withColumn("row", F.monotonically_increasing_id()))
    tops = base.agg(
        F.count("*").alias("n"), *[F.expr(f"approx_top_k(v{i}, {HOT_SHARE})").alias(f"t{i}") for i in range(len(cells))],
        *[F.approx_count_distinct(f"v{i}").alias(f"d{i}") for i in range(len(cells))],
    ).first()
    few = [i for i in range(len(cells)) if tops[f"d{i}"] * FEW_SHARE <= tops.n and tops[f"d{i}"] <= BROADCAST_ROWS]
    wide = [i for i in range(len(cells)) if i not in few]
    base = _counted_ranks(base, few) if few else base
    known, names = [f"rank{i}" for i in few], [f"rank{i}" for i in range(len(cells))]
    ranked_anywhere = F.coalesce(*known).isNotNull() if known else F.lit(False)
    if not wide:
        return base.where(ranked_anywhere).select(*names)
    entries = []
    for i in wide:
        v = F.col(f"v{i}")
        hot = [t["item"] for t in tops[f"t{i}"] or [] if t["item"] is not None and t["count"] * HOT_SHARE > tops.n]
        is_hot = v.isin(hot) if hot else F.lit(False)
        place = F.when(is_hot, F.pmod(F.xxhash64("row"), F.lit(HOT_SPREAD)).cast("int")).otherwise(F.lit(-1))
        entries.append(F.when(v.isNotNull(), F.struct(
            F.lit(i).alias("list"), v.alias("value"), place.alias("place")
        )))
    long = base.select("row", *known, F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    keys = ["list", "value", "place"]
    group = Window.partitionBy(*keys)
    # the range shuffle already brings a group together, so the window moves nothing
    placed = stable(
        long.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(POS_MASK)))
        .withColumns({"_first": F.min(POS).over(group), "_n": F.count("*").over(group)})
        .drop(POS)
    )
    # one row per partition and list in it
    earlier = Window.partitionBy("list").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("list", PART).agg(F.min("_first").alias("_base"), F.count("*").alias("_rows"))
    offsets = offsets.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    started = placed.join(F.broadcast(offsets.drop("_rows")), ["list", PART]).withColumn(
        "_start", F.col("_before") + F.col("_first") - F.col("_base")
    )
    # the places of a value lie next to each other; fewer than HOT_SHARE values a list have any
    spread = started.where("place >= 0").groupBy("list", "value").agg(
        F.min("_start").alias("_from"), F.count("*").alias("_all")
    )
    rank = F.coalesce(F.col("_from"), F.col("_start")) + (F.coalesce(F.col("_all"), F.col("_n")) + 1) / 2
    ranked = started.join(F.broadcast(spread), ["list", "value"], "left").select(
        "row", *known, "list", rank.alias("rank")
    )
    if len(wide) == 1:
        out = ranked.withColumnRenamed("rank", f"rank{wide[0]}").select(*names)
    else:
        # moved narrow, then set side by side; a row has one entry a list
        beside = [F.max(F.when(F.col("list") == i, F.col("rank"))).alias(f"rank{i}") for i in wide]
        out = ranked.repartition("row").groupBy("row").agg(*[F.max(c).alias(c) for c in known], *beside).select(*names)
    if not few:
        return out
    # rows that are in lists of few values only
    rest = base.where(F.coalesce(*[F.col(f"v{i}") for i in wide]).isNull() & ranked_anywhere)
    gaps = [F.lit(None).cast("double").alias(c) if c not in known else F.col(c) for c in names]
    return out.unionByName(rest.select(*gaps))


def neighbour(
    df: DataFrame,
    columns: dict[str, str],
    order: Sequence[str],
    by: Sequence[str] = (),
    step: int = -1,
) -> DataFrame:
    """Values of the previous (``step=-1``) or next (``step=1``) row in ``order``.

    ``columns`` maps new names to source columns; rows at the edge of their
    group get NULL.  Rows are range-partitioned on group and order, so a hot
    group is split; rows equal in both follow a hash of the whole row.
    """
    if step not in (-1, 1):
        raise ValueError("step is -1 or 1")
    by = list(by)
    return _adjacent(ranged(df, [*by, *order]), columns, by, step).drop(PART, POS)


def _adjacent(rows: DataFrame, columns: dict[str, str], by: list[str], step: int) -> DataFrame:
    """Neighbours within range partitions, joined up at their edges."""
    fetch = F.lag if step < 0 else F.lead
    rows = rows.withColumn(
        "_row", F.struct(*[F.col(c) for c in by], *[F.col(c).alias(n) for n, c in columns.items()])
    )
    inside = fetch("_row").over(Window.partitionBy(PART).orderBy(POS))
    # one row per partition: the row that faces the neighbouring partition
    facing = F.max_by if step < 0 else F.min_by
    edges = rows.groupBy(PART).agg(facing("_row", POS).alias("_edge"))
    edges = edges.select(PART, fetch("_edge").over(Window.orderBy(PART)).alias("_edge"))
    joined = rows.withColumn("_near", inside).join(F.broadcast(edges), PART)
    near = F.coalesce("_near", "_edge")
    same = F.lit(True)
    for c in by:
        same = same & near[c].eqNullSafe(F.col(c))
    return joined.withColumns({n: F.when(same, near[n]) for n in columns}).drop(
        "_row", "_near", "_edge"
    )
