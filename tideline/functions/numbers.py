"""Number handling shared by all operators.

Spark runs in ANSI mode, where a bad cast or a division by zero raises; the
helpers here give NULL instead.  NaN is turned into NULL on the way in, because
Spark orders NaN above every number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NAN = float("nan")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """``c`` as double; unreadable text and NaN become NULL."""
    return F.nullif(col(c).try_cast("double"), F.lit(NAN))


def half_even(c: str | Column, digits: int) -> Column:
    """Round halves to the even neighbour, scaled as array libraries do it.

    Unlike ``bround`` this stays in double arithmetic.
    """
    scale = F.lit(10.0**digits)
    return F.rint(col(c) * scale) / scale


def clip(c: str | Column, low=None, high=None) -> Column:
    """Limit ``c`` to [low, high]; NULL stays NULL."""
    value = col(c)
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def ratio(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def whole(c: str | Column, default: int | None = None) -> Column:
    """Number cut to an int (towards zero), ``default`` where unreadable or out of range."""
    value = number(c).try_cast("int")
    return value if default is None else F.coalesce(value, F.lit(default))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(NAN)) for c in floats}) if floats else df


def finite_or_zero(c: str | Column) -> Column:
    """Replace NULL, NaN and the infinities by 0.0."""
    value = col(c)
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), 0.0).otherwise(
        F.coalesce(value, F.lit(0.0))
    )
