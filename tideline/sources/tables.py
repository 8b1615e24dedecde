"""Reading, numbering, appending and writing observation tables."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline import presets as P
from tideline.functions.numbers import nan_to_null
from tideline.operators.flow import SPLIT
from tideline.operators.ordering import global_row_number


def first_existing(spark: SparkSession, candidates: Iterable[str]) -> str:
    """First path or pattern that exists, on whatever file system it names."""
    candidates = list(candidates)
    for path in candidates:
        try:
            spark.read.format("binaryFile").load(path)
            return path
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these exists: {', '.join(candidates)}")


def read_observations(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType | None = P.OBSERVATION_SCHEMA,
    form: str | None = None,
) -> DataFrame:
    """Read CSV, Parquet, JSON or ORC with a given schema; NaN becomes NULL.

    The form follows from the file ending unless given.  Pass ``schema=None``
    to keep a Parquet schema, or all text columns of a CSV with a header.
    Columns of a CSV go by its header, in any order: those the schema lacks are
    left out, those the file lacks and unreadable values are NULL.  Each given
    path may have its own header; files under one path must share it.
    """
    paths = [path] if isinstance(path, str) else list(path)
    ending = form or os.path.splitext(paths[0].rstrip("/*"))[1].lstrip(".").lower() or "parquet"
    if ending == "csv":
        parts = [_read_csv(spark, p, schema) for p in paths]
        union = lambda a, b: a.unionByName(b, allowMissingColumns=True)
        return nan_to_null(reduce(union, parts))
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.format(ending).load(paths))


def _read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None) -> DataFrame:
    # a file whose header differs from that of its neighbours ends the read
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    if schema is None:
        return text
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    given = set(text.columns)
    return text.select(
        *[
            (F.col(f"`{f.name}`") if f.name in given else F.lit(None).cast("string"))
            .try_cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def assign_record_id(
    df: DataFrame,
    order: Sequence[str | Column],
    prefix: str = P.TABLE_PREFIX,
    name: str = "record_id",
    start: int | Column = 0,
) -> DataFrame:
    """``PREFIX-0001`` and so on in ``order``; longer numbers make longer ids."""
    base = start if isinstance(start, Column) else F.lit(start)
    numbered = global_row_number(df.drop(name), order, "_rn")
    text = F.format_string(f"{prefix}-%04d", F.col("_rn") + base)
    return numbered.withColumn(name, text).drop("_rn")


def append_table(
    old: DataFrame, new: DataFrame, order: Sequence[str], prefix: str = P.TABLE_PREFIX
) -> DataFrame:
    """Old rows, then new rows, all numbered again."""
    parts = old.withColumn("_part_no", F.lit(0)).unionByName(
        new.withColumn("_part_no", F.lit(1)), allowMissingColumns=True
    )
    return assign_record_id(parts, ["_part_no", *order], prefix).drop("_part_no")


def replace_table(new: DataFrame, order: Sequence[str], prefix: str = P.TABLE_PREFIX) -> DataFrame:
    return assign_record_id(new, order, prefix)


def append_rows(
    df: DataFrame,
    records: Sequence[Mapping[str, object]] | DataFrame,
    order: Sequence[str] = (),
    label: str = P.SUBMIT_LABEL,
    prefix: str = P.TABLE_PREFIX,
) -> DataFrame:
    """Add loose records with the next ids; columns they lack are NULL.

    A DataFrame of records needs an ``order``; a list keeps its own.
    """
    count = df.agg(F.count("*")).scalar()
    if isinstance(records, DataFrame):
        new = records
    else:
        types = {f.name: f.dataType for f in df.schema}
        names = list(dict.fromkeys(k for r in records for k in r))
        schema = T.StructType([T.StructField("_no", T.LongType())])
        for n in names:
            schema.add(n, types.get(n, T.StringType()))
        rows = [(i, *[r.get(n) for n in names]) for i, r in enumerate(records)]
        new, order = df.sparkSession.createDataFrame(rows, schema), ["_no"]
    new = assign_record_id(new, order, prefix, start=count).drop("_no")
    new = new.withColumn("data_source_label", F.lit(label))
    return df.unionByName(new, allowMissingColumns=True)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", form: str = "parquet") -> str:
    """Write as a folder of files; one task per partition."""
    writer = df.write.mode(mode)
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)
    return path


def write_split(df: DataFrame, path: str, split: str = SPLIT, form: str = "parquet") -> str:
    """Write the parts under ``split=train`` and ``split=test``, so that each is read alone."""
    writer = df.write.mode("overwrite").partitionBy(split)
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)
    return path
