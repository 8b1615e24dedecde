"""Descriptive statistics, trends, outliers, densities and group profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline import presets as P
from tideline.functions.numbers import half_even, ratio
from tideline.operators.quantiles import approx_quantiles, exact_quantiles, quantile_values

QUARTILES = (0.25, 0.5, 0.75)
Quantiles = Mapping[tuple[str, float], float]


def _rounded(df: DataFrame, columns: Sequence[str], digits: int | None) -> DataFrame:
    if digits is None:
        return df
    return df.withColumns({c: half_even(c, digits) for c in columns})


def quartiles(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row per column: q25, median, q75."""
    find = approx_quantiles if approximate else exact_quantiles
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    return (
        find(df, columns, QUARTILES)
        .groupBy("metric")
        .agg(at(0.25).alias("q25"), at(0.5).alias("median"), at(0.75).alias("q75"))
    )


def describe_stats(
    df: DataFrame,
    columns: Sequence[str] = P.DESCRIBE_COLUMNS,
    digits: int | None = 2,
    approximate: bool = False,
    known: Quantiles | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, quartiles, range and bias-corrected skewness.

    Columns that ``df`` lacks are skipped; NULLs are left out per column.
    ``known`` are quartiles found before, as ``quantile_values`` gives them.
    """
    have = [c for c in columns if c in df.columns]
    aggs = []
    for i, c in enumerate(have):
        v = F.col(c).cast("double")
        n = F.count(v)
        unbias = F.sqrt(n * (n - 1)) / (n - 2)
        skew = (
            F.when(n < 3, F.lit(None).cast("double"))
            .when(F.min(v) == F.max(v), F.lit(0.0))
            .otherwise(F.skewness(v) * F.when(n > 2, unbias))
        )
        aggs.append(
            F.struct(
                F.lit(c).alias("metric"), n.alias("count"), F.avg(v).alias("mean"),
                F.when(n > 1, F.stddev_samp(v)).alias("std"), F.min(v).alias("min"),
                F.max(v).alias("max"), skew.alias("skewness"),
            ).alias(f"m{i}")
        )
    moments = df.agg(*aggs).select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(have))])))
    if known is None:
        found = quartiles(df, have, approximate)
    else:
        rows = [(c, *[known.get((c, p)) for p in QUARTILES]) for c in have]
        found = df.sparkSession.createDataFrame(
            rows, "metric string, q25 double, median double, q75 double"
        )
    out = moments.join(F.broadcast(found), "metric", "left").withColumn(
        "iqr", F.col("q75") - F.col("q25")
    )
    numbers = ["mean", "std", "median", "q25", "q75", "iqr", "min", "max", "skewness"]
    return _rounded(out, numbers, digits).select("metric", "count", *numbers)


def trend_by(
    df: DataFrame,
    key: str,
    metrics: Sequence[str] = P.TREND_METRICS,
    order: Sequence | None = None,
    digits: int | None = 1,
    fill: float | None = 0.0,
) -> DataFrame:
    """Mean of ``metrics`` per key; with ``order``, exactly those keys, ranked by ``ord``."""
    metrics = list(metrics)
    if order is None:
        means = df.groupBy(key).agg(*[F.avg(m).alias(m) for m in metrics])
        return _rounded(means, metrics, digits)
    means = (
        df.where(F.col(key).isin(list(order)))
        .groupBy(key)
        .agg(*[F.avg(m).alias(m) for m in metrics])
    )
    keys = F.posexplode(F.array(*[F.lit(k) for k in order])).alias("ord", key)
    listed = df.sparkSession.range(1).select(keys)
    # at most one row per listed key on either side
    out = listed.join(F.broadcast(means), key, "left")
    if fill is not None:
        out = out.na.fill(fill, subset=metrics)
    return _rounded(out, metrics, digits)


def trend_by_event(
    df: DataFrame,
    flag: str = "campus_event_flag",
    metrics: Sequence[str] = P.TREND_METRICS,
    labels: Mapping[int, str] = P.EVENT_LABELS,
    digits: int = 1,
) -> DataFrame:
    """``trend_by`` for the flag values in ``labels``; absent ones give no row."""
    means = trend_by(df.where(F.col(flag).isin(list(labels))), flag, metrics, digits=digits)
    name = F.coalesce(*[F.when(F.col(flag) == k, F.lit(v)) for k, v in labels.items()])
    return means.na.fill(0.0, subset=list(metrics)).withColumn("status", name)


def normalized_profile(
    df: DataFrame,
    key: str,
    capacities: Mapping[str, float | Column],
    order: Sequence | None = None,
    digits: int = 1,
) -> DataFrame:
    """Mean per key as a percentage of each metric's capacity."""
    means = trend_by(df, key, list(capacities), order, digits=None, fill=None)
    return means.withColumns(
        {
            m: half_even(ratio(m, c if isinstance(c, Column) else F.lit(float(c))) * 100, digits)
            for m, c in capacities.items()
        }
    )


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    factor: float = 1.5,
    floor_zero: bool = False,
    digits: int | None = 2,
    known: Quantiles | None = None,
) -> DataFrame:
    """Quartiles, fences and the number of values outside them, per column."""
    q = quantile_values(df, columns, [0.25, 0.75]) if known is None else known
    rows, counts = [], []
    for i, c in enumerate(columns):
        q25, q75 = q.get((c, 0.25)), q.get((c, 0.75))
        low, high = _fences(q25, q75, factor, floor_zero)
        outside = (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))
        counts.append(F.count_if(outside).alias(f"n{i}"))
        iqr = None if q25 is None else q75 - q25
        facts = {"q25": q25, "q75": q75, "iqr": iqr, "lower_bound": low, "upper_bound": high}
        rows.append(
            F.struct(
                F.lit(c).alias("metric"),
                *[F.lit(v).cast("double").alias(k) for k, v in facts.items()],
                F.col(f"n{i}").alias("outlier_count"),
            )
        )
    out = df.agg(*counts).select(F.inline(F.array(*rows)))
    return _rounded(out, ["q25", "q75", "iqr", "lower_bound", "upper_bound"], digits)


def _fences(q25, q75, factor, floor_zero):
    if q25 is None:
        return None, None
    low, high = q25 - factor * (q75 - q25), q75 + factor * (q75 - q25)
    return (max(0.0, low) if floor_zero else low), high


def outlier_context(
    rules: Sequence[tuple[str | Column, str]] = P.OUTLIER_CONTEXT, other: str = P.OUTLIER_OTHER
) -> Column:
    """Label of the first rule that holds; a rule is a 0/1 column or a condition."""
    out = None
    for rule, label in rules:
        hit = F.col(rule) == 1 if isinstance(rule, str) else rule
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(other) if out is None else out.otherwise(other)


def iqr_outliers(
    df: DataFrame,
    column: str,
    factor: float = 1.5,
    context: Column | None = None,
    keep: Sequence[str] = ("record_id", "date", "time_slot"),
    known: Quantiles | None = None,
) -> DataFrame:
    """Rows outside the fences, with fences and context; nothing is removed from the table.

    The fences are literals, so the scan can skip row groups inside them.
    """
    q = quantile_values(df, [column], [0.25, 0.75]) if known is None else known
    low, high = _fences(q.get((column, 0.25)), q.get((column, 0.75)), factor, False)
    if context is None:
        rules = [(c, label) for c, label in P.OUTLIER_CONTEXT if c in df.columns]
        context = outlier_context(rules)
    return df.where((F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high))).select(
        *keep,
        half_even(F.col(column).cast("double"), 2).alias("value"),
        half_even(F.lit(low).cast("double"), 2).alias("lower_threshold"),
        half_even(F.lit(high).cast("double"), 2).alias("upper_threshold"),
        context.alias("event_context"),
        F.lit(P.OUTLIER_ACTION).alias("action_taken"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20, digits: int | None = None) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed, with counts and densities.

    A constant column gets the range value - 0.5 .. value + 0.5.
    """
    v = F.col(column).cast("double")
    facts = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n")).first()
    if not facts.n:
        raise ValueError(f"{column} holds no values")
    lo, hi = (facts.lo, facts.hi) if facts.lo < facts.hi else (facts.lo - 0.5, facts.hi + 0.5)
    width = (hi - lo) / bins
    # the division may miss an edge by a rounding step, the comparisons with the edges settle it
    near = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    at = F.col("near")
    settled = (
        F.when(F.col("v") < at * width + lo, at - 1)
        .when((F.col("v") >= (at + 1) * width + lo) & (at < bins - 1), at + 1)
        .otherwise(at)
    )
    placed = df.where(v.isNotNull()).select(v.alias("v"), near.alias("near"))
    counts = placed.groupBy(settled.alias("bin")).agg(F.count("*").alias("n"))
    listed = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = listed.join(F.broadcast(counts), "bin", "left").na.fill(0, subset=["n"])
    out = out.select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("left_edge"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("right_edge"),
        F.col("n").alias("count"),
        (F.col("n") / F.lit(facts.n * width)).alias("density"),
    )
    return _rounded(out, ["left_edge", "right_edge", "density"], digits)


def kde(
    df: DataFrame, column: str, points: int = 200, digits: int | None = None,
    resolution: float = 0.002,
) -> DataFrame:
    """Gaussian density on ``points`` values from min to max, bandwidth by Scott's rule.

    Rows are summed up in bins of ``resolution`` bandwidths: count, mean and
    variance.  A bin adds the kernel at its mean and the variance times half its
    second derivative, so equal values are exact and a density is wrong by less
    than ``0.23 * resolution ** 3`` of a kernel's peak (the third derivative of
    the kernel is at most 1.4 times the peak).  What moves and what is evaluated
    are bins: they follow range over bandwidth, not distinct values, and
    tasks send one partial sum per bin and grid point.
    """
    v = F.col(column).cast("double")
    facts = df.agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"),
        F.when(F.count(v) > 1, F.stddev_samp(v)).alias("sd"),
    ).first()
    if not facts.sd:
        raise ValueError(f"{column} needs two different values")
    h = facts.sd * facts.n ** (-0.2)
    step = (facts.hi - facts.lo) / (points - 1)
    scale = 1.0 / (facts.n * h * (2 * 3.141592653589793) ** 0.5)
    width = h * resolution
    at = F.floor((v - facts.lo) / width)
    inside = F.col("value") - (F.lit(facts.lo) + F.col("bin") * width)
    bins = (
        df.where(v.isNotNull()).select(v.alias("value"), at.alias("bin"))
        .select("bin", inside.alias("d"))
        .groupBy("bin")
        .agg(F.count("*").alias("cnt"), F.avg("d").alias("mean"), F.var_pop("d").alias("var"))
    )
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    middle = F.lit(facts.lo) + F.col("bin") * width + F.col("mean")
    z = (F.lit(facts.lo) + F.col("point") * step - F.col("middle")) / h
    bend = 1 + F.col("var") / (2 * h * h) * (z * z - 1)
    sums = (
        bins.select(middle.alias("middle"), "cnt", "var", grid.alias("point"))
        .groupBy("point")
        .agg(F.sum(F.col("cnt") * F.exp(-0.5 * z * z) * bend).alias("s"))
    )
    out = sums.select(
        "point",
        (F.lit(facts.lo) + F.col("point") * step).alias("x"),
        (F.col("s") * scale).alias("density"),
    )
    return _rounded(out, ["x", "density"], digits)


def box_stats(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, digits: int | None = 2
) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and the number of fliers."""
    q = quantile_values(df, columns, QUARTILES)
    rows, aggs = [], []
    for i, c in enumerate(columns):
        q25, q50, q75 = (q.get((c, p)) for p in QUARTILES)
        low, high = _fences(q25, q75, factor, False)
        v = F.col(c).cast("double")
        aggs += [
            # a whisker never ends inside the box
            F.least(F.min(F.when(v >= F.lit(low), v)), F.lit(q25)).alias(f"l{i}"),
            F.greatest(F.max(F.when(v <= F.lit(high), v)), F.lit(q75)).alias(f"h{i}"),
            F.count_if((v < F.lit(low)) | (v > F.lit(high))).alias(f"f{i}"),
        ]
        facts = {"q25": q25, "median": q50, "q75": q75}
        rows.append(
            F.struct(
                F.lit(c).alias("metric"),
                *[F.lit(x).cast("double").alias(k) for k, x in facts.items()],
                F.col(f"l{i}").alias("whisker_low"), F.col(f"h{i}").alias("whisker_high"),
                F.col(f"f{i}").alias("fliers"),
            )
        )
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    return _rounded(out, ["q25", "median", "q75", "whisker_low", "whisker_high"], digits)


def rate_and_mean(
    df: DataFrame,
    flag: str = "sports_overcrowded_flag",
    metric: str = "campus_pulse_index",
    split: str | None = None,
) -> DataFrame:
    """Rows, rate of ``flag`` in percent, mean of ``metric``; with ``split``, part sizes too."""
    aggs = [
        F.count("*").alias("total_records"),
        half_even(F.avg(F.col(flag).cast("double")) * 100, 1).alias("rate_pct"),
        half_even(F.avg(metric), 2).alias("mean_value"),
    ]
    if split:
        aggs += [F.count_if(F.col(split) == s).alias(f"{s}_records") for s in ("train", "test")]
    return df.agg(*aggs)


def mode_per_group(df: DataFrame, by: Sequence[str], column: str, name: str = "mode") -> DataFrame:
    """Most frequent value per group, the lowest one on ties."""
    counts = (
        df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_cnt"))
    )
    best = F.min_by(column, F.struct(-F.col("_cnt"), F.col(column)))
    return counts.groupBy(*by).agg(best.alias(name))


def persona(exam_rate, sports_load, food_orders, event_rate) -> Column:
    """Key of the first persona rule that holds."""
    lim = P.PERSONA_LIMITS
    return (
        F.when(exam_rate > lim["exam_rate"], "exam")
        .when(sports_load > lim["sports_load"], "sports")
        .when((food_orders > lim["food_orders"]) | (event_rate > lim["event_rate"]), "event")
        .otherwise("calm")
    )


def _persona_text(key: Column, part: int) -> Column:
    return F.coalesce(*[F.when(key == k, F.lit(v[part])) for k, v in P.PERSONAS.items()])


def group_profile(
    df: DataFrame,
    group: str = "cluster",
    sports: str = "sports_load_pct",
    food: str = "food_orders_demand",
    library: str = "library_load_pct",
    index: str = "campus_pulse_index",
    exam: str = "is_exam_week",
    event: str = "campus_event_flag",
    slot: str = "time_slot",
) -> DataFrame:
    """Size, share, means, usual slot and persona of each group."""
    # counts per (group, slot) feed sizes, sums and the mode from one shuffle
    metrics = {"_s": sports, "_f": food, "_l": library, "_i": index, "_x": exam, "_e": event}
    cells = df.groupBy(group, slot).agg(
        F.count("*").alias("_n"),
        *[F.sum(F.col(c).cast("double")).alias(a) for a, c in metrics.items()],
        *[F.count(F.col(c)).alias(f"{a}n") for a, c in metrics.items()],
    )
    usual = F.min_by(
        F.col(slot), F.when(F.col(slot).isNotNull(), F.struct(-F.col("_n"), F.col(slot)))
    )
    groups = cells.groupBy(group).agg(
        F.sum("_n").alias("sample_count"),
        *[F.try_divide(F.sum(a), F.sum(f"{a}n")).alias(a) for a in metrics],
        usual.alias("predominant_time_slot"),
    )
    total = df.agg(F.count("*").alias("n")).scalar()
    key = persona(F.col("_x"), F.col("_s"), F.col("_f"), F.col("_e"))
    return groups.withColumn("_key", key).select(
        group,
        _persona_text(F.col("_key"), 0).alias("label"),
        _persona_text(F.col("_key"), 1).alias("description"),
        _persona_text(F.col("_key"), 2).alias("recommended_action"),
        "sample_count",
        half_even(ratio("sample_count", total) * 100, 1).alias("percentage_of_data"),
        half_even("_s", 1).alias("avg_sports_load_pct"),
        half_even("_f", 1).alias("avg_food_orders"),
        half_even("_l", 1).alias("avg_library_load_pct"),
        half_even("_i", 1).alias("avg_campus_pulse_index"),
        "predominant_time_slot",
    )


def group_shift(
    df: DataFrame,
    flag: str = "is_exam_week",
    metrics: Mapping[str, str] = P.SHIFT_METRICS,
    digits: int = 1,
) -> DataFrame:
    """Mean where the flag is 1 less the mean where it is 0, per metric, in one pass."""
    on, off = F.col(flag) == 1, F.col(flag) == 0
    return df.agg(
        *[
            half_even(F.avg(F.when(on, F.col(c))) - F.avg(F.when(off, F.col(c))), digits).alias(n)
            for n, c in metrics.items()
        ]
    )


