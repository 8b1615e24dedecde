"""Quantiles of a table that grows by the day, from one small sketch per day and column.

A day's sketch is built from that day's rows alone and kept; any span of days is
answered by merging its sketches, without reading the rows.  Where the exact
value is wanted, the merged sketch encloses each rank between two values, and the
rows are scanned for those between them only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.functions.numbers import number
from tideline.operators.quantiles import exact_quantiles

SIZE = 2048  # about 40 KB a sketch; ranks are off by a quarter of a percent at most, nearly always
SLACK = 0.005
DAY = "_day"


class DaySketches:
    """Folder of (metric, n, low, high, sketch) rows, partitioned by day."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], size: int = SIZE):
        self.spark, self.path, self.columns, self.size = spark, path, list(columns), size

    def add(self, rows: DataFrame, day: str) -> None:
        """Sketch the days that ``rows`` hold, each of them whole; a day that is there is replaced.

        Nothing that is stored is read.  NULL and NaN are left out; rows without a
        day form a partition of their own.
        """
        cells = []
        for c in self.columns:
            v = number(c)
            cells.append(F.struct(
                F.lit(c).alias("metric"), F.count(v).alias("n"), F.min(v).alias("low"),
                F.max(v).alias("high"), F.kll_sketch_agg_double(v, F.lit(self.size)).alias("sketch"),
            ))
        days = rows.groupBy(F.col(day).cast("date").alias(DAY)).agg(F.array(*cells).alias("cells"))
        days.select(DAY, F.inline("cells")).write.partitionBy(DAY).option(
            "partitionOverwriteMode", "dynamic"
        ).mode("overwrite").parquet(self.path)

    def days(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """The stored rows from ``first`` to ``last``; other days' files are not opened."""
        kept = self.spark.read.parquet(self.path)
        if first is not None:
            kept = kept.filter(F.col(DAY) >= F.lit(first).cast("date"))
        return kept if last is None else kept.filter(F.col(DAY) <= F.lit(last).cast("date"))

    def merged(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """One row per column: n, low, high and the sketch of all days asked for."""
        return self.days(first, last).filter("n > 0").groupBy("metric").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )

    def approximate(
        self, probs: Sequence[float], first: str | None = None, last: str | None = None
    ) -> DataFrame:
        """Rows (metric, prob, value), values that exist, from the sketches alone."""
        probs = F.array(*[F.lit(float(p)) for p in probs])
        found = self.merged(first, last).withColumn(
            "value", F.kll_sketch_get_quantile_double("sketch", probs)
        )
        return found.withColumn("prob", probs).select("metric", F.inline(F.arrays_zip("prob", "value")))

    def enclosed(
        self, probs: Sequence[float], first: str | None = None, last: str | None = None
    ) -> dict[tuple[str, float], tuple[int, float, float]]:
        """Number of values per (metric, prob), and two values that should enclose the rank."""
        probs = [float(p) for p in probs]
        ends = F.array(*[F.lit(min(max(p + d, 0.0), 1.0)) for p in probs for d in (-SLACK, SLACK)])
        rows = self.merged(first, last).select(
            "metric", "n", "low", "high", F.kll_sketch_get_quantile_double("sketch", ends).alias("e")
        ).collect()  # one per column
        out = {}
        for r in rows:
            for i, p in enumerate(probs):
                lo = r.low if p <= SLACK else r.e[2 * i]
                hi = r.high if p >= 1 - SLACK else r.e[2 * i + 1]
                out[r.metric, p] = (r.n, lo, hi)
        return out

    def exact(
        self, table: DataFrame, probs: Sequence[float], first: str | None = None,
        last: str | None = None,
    ) -> DataFrame:
        """Rows (metric, prob, value), interpolated; ``table`` holds the rows of the days asked for.

        If days were added or changed behind the sketches' back, counts show it and
        the search starts from the rows.
        """
        try:
            known = self.enclosed(probs, first, last)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            known = {}
        sizes = table.agg(*[F.count(number(c)).alias(c) for c in self.columns]).first()
        current = {k: v for k, v in known.items() if v[0] == sizes[k[0]]}
        return exact_quantiles(table, self.columns, probs, current)
