"""Reading delimited uploads whose files differ, with a side table of unreadable cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tideline.functions.numbers import nan_to_null
from tideline.session import stable

PLACE = ("file", "line")


def _numbered_lines(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """All lines with their split and place in it, and one row per split.

    A split is the part of a file that one task reads.  Its row says how many
    lines of the file come before it and what the file's first line is.
    """
    lines = spark.read.text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
    )
    splits = lines.groupBy("file", "split").agg(
        F.min("place").alias("first"), F.count("*").alias("lines"),
        F.min_by(F.when(F.col("split") == 0, F.col("value")), "place").alias("header"),
    )
    in_file = Window.partitionBy("file").orderBy("split")
    return lines, stable(
        splits.select(
            "file", "split", "first",
            (F.sum("lines").over(in_file) - F.col("lines")).alias("before"),
            F.first("header").over(in_file).alias("header"),
        )
    )


def _cells(text: Column, width: int, sep: str) -> Column:
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    parsed = F.from_csv(text, fields.simpleString()[len("struct<"):-1].replace(":", " "), {"sep": sep})
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def read_checked(
    spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, sep: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of delimited text files, each with a header of its own.

    ``rows`` has the columns of ``schema`` by name, whatever their order in a
    file, then ``file`` and ``line`` (the header is line 1, empty lines count but
    give no row).  Columns a file lacks and unreadable cells are NULL, and so is
    NaN.  ``rejects`` has one row per unreadable cell: file, line, column, text.
    Cells beyond the header are ignored, short lines end in NULLs, of columns
    that share a name the first counts.  A line is a row, so quoted cells hold no
    line ends.  An empty file gives no row.

    The text is read once to count the lines of each split, once by whoever uses
    the rows and once by whoever uses the rejects; no line moves unless
    there are too many splits to broadcast their list.
    """
    fields = list(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    lines, splits = _numbered_lines(spark, [path] if isinstance(path, str) else path)
    width = splits.agg(F.max(F.size(F.split("header", f"\\Q{sep}\\E")))).first()[0]
    width = max(1, width or 1)
    names = F.transform(
        _cells(F.ltrim(F.col("header"), F.lit("﻿")), width, sep), lambda n: F.trim(n)
    )
    texts = (
        lines.join(splits.select("file", "split", "first", "before", names.alias("names")), ["file", "split"])
        .withColumn("line", F.col("before") + F.col("place") - F.col("first") + 1)
        .where((F.col("line") > 1) & (F.trim("value") != ""))
        .select("file", "line", "names", _cells(F.col("value"), width, sep).alias("cells"))
        .select(
            *PLACE,
            *[
                F.get("cells", (F.array_position("names", F.lit(f.name)) - 1).cast("int")).alias(f"t{i}")
                for i, f in enumerate(fields)
            ],
        )
    )
    read = [F.trim(F.col(f"t{i}")).try_cast(f.dataType) if not isinstance(f.dataType, T.StringType)
            else F.col(f"t{i}") for i, f in enumerate(fields)]
    rows = nan_to_null(texts.select(*[v.alias(f.name) for v, f in zip(read, fields)], *PLACE))
    bad = [
        F.when(
            v.isNull() & (F.trim(F.col(f"t{i}")) != ""),
            F.struct(F.lit(f.name).alias("column"), F.col(f"t{i}").alias("text")),
        )
        for i, (v, f) in enumerate(zip(read, fields))
    ]
    rejects = texts.select(*PLACE, F.explode(F.array_compact(F.array(*bad))).alias("r"))
    return rows, rejects.select(*PLACE, "r.column", "r.text")
