"""Filters, listings and top-k over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.presets import SEARCH_COLUMNS


def listwise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def search_rows(df: DataFrame, text: str, columns: Sequence[str] = SEARCH_COLUMNS) -> DataFrame:
    """Rows where any of ``columns`` contains ``text``, ignoring case."""
    wanted = text.lower()
    hit = F.lit(False)
    for c in columns:
        found = F.lower(F.col(c).cast("string")).contains(wanted)
        hit = hit | F.coalesce(found, F.lit(False))
    return df.where(hit)


def latest(df: DataFrame, order: Sequence[str], n: int = 60) -> DataFrame:
    """The last ``n`` rows in ``order``."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def sample_head(df: DataFrame, order: Sequence[str | Column], n: int = 15) -> DataFrame:
    """The first ``n`` rows in ``order``, for reports."""
    return df.orderBy(*order).limit(n)


def top_features(df: DataFrame, n: int = 6, by: str = "importance", name: str = "feature"):
    return df.orderBy(F.desc(by), F.asc(name)).limit(n)


def top_k_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group; tasks drop the others before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
