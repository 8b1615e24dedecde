"""From an uploaded table to canonical columns: names, defaults, casts, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tideline import presets as P
from tideline.functions.numbers import half_even, number, whole
from tideline.functions.text import normal_name
from tideline.operators.quantiles import quantile_values


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case headers with underscores; of two that become equal the last is kept."""
    last = {normal_name(name): i for i, name in enumerate(df.columns)}
    unique = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"c{i}").alias(name) for name, i in last.items()])


def map_columns(
    df: DataFrame, aliases: Mapping[str, Sequence[str]] = P.COLUMN_ALIASES
) -> DataFrame:
    """Canonical columns from the first header each accepts; all others are dropped."""
    named = normalize_names(df)
    have = set(named.columns)
    picked = {}
    for target, names in aliases.items():
        source = next((n for n in names if n in have), None)
        if source is not None:
            picked[target] = F.col(source)
    return named.select(*[c.alias(t) for t, c in picked.items()])


def default_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Constant columns for the names ``df`` lacks."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def coerce_numeric(df: DataFrame, defaults: Mapping[str, int] = P.NUMBER_DEFAULTS) -> DataFrame:
    """Whole numbers, with a default where the cell is unreadable or the column absent."""
    return df.withColumns(
        {
            c: whole(c, v) if c in df.columns else F.lit(v).cast("int")
            for c, v in defaults.items()
        }
    )


def coalesce_derived(
    df: DataFrame, column: str, derived: Column, digits: int = 1, partial: float | None = None
) -> DataFrame:
    """Supplied numbers where readable, else ``derived``.

    With ``partial``, a column that has some values gets that constant in its
    gaps, and only an absent or empty column is derived.
    """
    if column not in df.columns:
        return df.withColumn(column, derived)
    given = number(column)
    if partial is None:
        return df.withColumn(column, half_even(F.coalesce(given, derived), digits))
    filled = df.select(F.count(column) > 0).scalar()
    fill = F.when(filled, F.lit(partial)).otherwise(derived)
    return df.withColumn(column, half_even(F.coalesce(given, fill), digits))


def _modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    cells = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    counts = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.count("*").alias("cnt"))
    )
    best = F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("value")
    return {r.metric: r.value for r in counts.groupBy("metric").agg(best).collect()}


def impute(
    df: DataFrame, columns: Sequence[str] | None = None, fit_on: DataFrame | None = None
) -> DataFrame:
    """Fill NULL numbers with the column median and other NULLs with the lowest mode.

    The values come from ``fit_on`` (a training part) or from ``df`` itself.
    An integer column with gaps becomes double, as its median may be a half.
    """
    fit = df if fit_on is None else fit_on
    names = list(columns or df.columns)
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    types = {f.name: f.dataType for f in df.schema}
    open_ = [c for c in names if gaps[c]]
    numeric = [c for c in open_ if isinstance(types[c], T.NumericType)]
    other = [c for c in open_ if c not in numeric]
    fills = {}
    if numeric:
        medians = quantile_values(fit, numeric, [0.5])
        for c in numeric:
            fills[c] = F.coalesce(F.col(c).cast("double"), F.lit(medians.get((c, 0.5))))
    if other:
        modes = _modes(fit, other)
        for c in other:
            fills[c] = F.coalesce(F.col(c), F.lit(modes.get(c)).cast(types[c]))
    return df.withColumns(fills) if fills else df


def fill_all(df: DataFrame) -> DataFrame:
    """Every NULL becomes 0, in text columns "0"."""
    return df.na.fill(0).na.fill("0")


def map_categories(df: DataFrame, column: str, recode: Mapping) -> DataFrame:
    return df.na.replace(dict(recode), subset=[column])


