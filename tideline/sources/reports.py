"""Result tables as JSON documents, and fitted models on disk."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F, types as T

from tideline.functions.numbers import finite_or_zero


def sanitize(df: DataFrame) -> DataFrame:
    """0.0 for NULL, NaN and infinite numbers in floating-point columns."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_zero(c) for c in floats}) if floats else df


def summary_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (section, record): each result row as a JSON text."""
    parts = []
    for name, table in tables.items():
        clean = sanitize(table)
        record = F.to_json(F.struct(*clean.columns), {"ignoreNullFields": "false"})
        parts.append(clean.select(F.lit(name).alias("section"), record.alias("record")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def summary_json(tables: Mapping[str, DataFrame], path: str) -> str:
    """Write every result as JSON lines under ``section=<name>``."""
    rows = summary_rows(tables).select("section", F.col("record").alias("value"))
    rows.write.mode("overwrite").partitionBy("section").text(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
