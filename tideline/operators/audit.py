"""Audits of a table: NULLs, duplicate rows, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def null_audit(df: DataFrame, total: str | None = "(all)") -> DataFrame:
    """Rows (column, nulls), with the sum over all columns as one more row."""
    cells = [(c, F.count_if(F.col(c).isNull())) for c in df.columns]
    counts = df.agg(*[n.alias(f"n{i}") for i, (_, n) in enumerate(cells)])
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
        for i, (c, _) in enumerate(cells)
    ]
    if total is not None:
        both = sum((F.col(f"n{i}") for i in range(1, len(cells))), F.col("n0"))
        rows.append(F.struct(F.lit(total).alias("column"), both.alias("nulls")))
    return counts.select(F.inline(F.array(*rows)))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Number of rows beyond the first of each set of equal rows."""
    sets = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return sets.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Rows (position, column, type, rows, non_null)."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("rows"),
            F.col(f"n{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))
