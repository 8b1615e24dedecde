"""Two-sample tests: Welch's t, rank-sum U, effect size, and a report over many tests.

A test is a metric and two conditions.  All tests of a call are answered from
the same passes: one aggregation for the means, one for the ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.numbers import half_even
from tideline.functions.tails import t_p_value, u_p_value
from tideline.operators.ordering import running_total


@dataclass(frozen=True)
class TwoSample:
    """Compare ``metric`` where ``a`` holds with where ``b`` holds."""

    name: str
    metric: str
    a: Column
    b: Column
    label_a: str = "A"
    label_b: str = "B"


def binary_split(name, metric, flag, label_a="A", label_b="B", value=1, other=0) -> TwoSample:
    return TwoSample(name, metric, F.col(flag) == value, F.col(flag) == other, label_a, label_b)


# Presets over the observation table: three of the batch report, three of exploration.
def preset_tests() -> list[TwoSample]:
    lunch = F.col("starting_hour") == 12
    return [
        binary_split("exam_sports", "sports_visitor_count", "is_exam_week", "Exam Weeks",
                     "Non-Exam Weeks"),
        binary_split("exam_library", "library_occupancy", "is_exam_week", "Exam Weeks",
                     "Non-Exam Weeks"),
        binary_split("event_food", "food_orders_demand", "sports_event_flag",
                     "Sports Event Days", "Regular Days"),
        binary_split("weekend_sports", "sports_visitor_count", "is_weekend", "Weekends",
                     "Weekdays"),
        binary_split("midterm_library", "library_occupancy", "is_midterm", "Midterm Phase",
                     "Regular Phase"),
        TwoSample("lunch_food", "food_orders_demand", lunch, ~lunch,
                  "Lunch Rush (12:00-14:00)", "Off-Peak Slots"),
    ]


def _samples(df: DataFrame, tests: Sequence[TwoSample]) -> DataFrame:
    """Rows (test, in_a, value), one per row and test it belongs to."""
    cells = [
        F.struct(
            F.lit(t.name).alias("test"),
            F.when(t.a, True).when(t.b, False).alias("in_a"),
            F.col(t.metric).cast("double").alias("value"),
        )
        for t in tests
    ]
    rows = df.select(F.inline(F.array(*cells)))
    return rows.where(F.col("in_a").isNotNull() & F.col("value").isNotNull())


def _moments(df: DataFrame, tests: Sequence[TwoSample]) -> DataFrame:
    a, b = F.when(F.col("in_a"), F.col("value")), F.when(~F.col("in_a"), F.col("value"))
    out = _samples(df, tests).groupBy("test").agg(
        F.count(a).alias("n_a"), F.avg(a).alias("mean_a"),
        F.when(F.count(a) > 1, F.var_samp(a)).alias("var_a"),
        F.count(b).alias("n_b"), F.avg(b).alias("mean_b"),
        F.when(F.count(b) > 1, F.var_samp(b)).alias("var_b"),
    )
    se_a, se_b = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    free = F.try_divide(
        (se_a + se_b) * (se_a + se_b),
        F.try_divide(se_a * se_a, F.col("n_a") - 1) + F.try_divide(se_b * se_b, F.col("n_b") - 1),
    )
    gap = F.col("mean_a") - F.col("mean_b")
    pooled = F.sqrt(
        F.try_divide(
            (F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"),
            F.col("n_a") + F.col("n_b") - 2,
        )
    )
    return out.withColumns(
        {
            "t": F.try_divide(gap, F.sqrt(se_a + se_b)),
            "df": free,
            "d": F.when(pooled > 0, gap / pooled).when(pooled == 0, 0.0),
        }
    )


def welch_t(df: DataFrame, tests: Sequence[TwoSample], digits: int = 4) -> DataFrame:
    """t, degrees of freedom and two-sided p (three digits) per test."""
    return _moments(df, tests).select(
        "test", "n_a", "n_b", half_even("t", digits).alias("t_statistic"),
        half_even("df", digits).alias("df"), t_p_value("t", "df").alias("p_value_ttest"),
    )


def cohens_d(df: DataFrame, tests: Sequence[TwoSample], digits: int = 3) -> DataFrame:
    """Effect size over the pooled deviation; Large from 0.8 on."""
    size = half_even("d", digits)
    label = F.when(F.abs(size) >= 0.8, "Large").otherwise("Medium")
    return _moments(df, tests).select("test", size.alias("cohens_d"), label.alias("effect"))


def _rank_sums(df: DataFrame, tests: Sequence[TwoSample]) -> DataFrame:
    # one row per test and distinct value, so a hot value is one row
    values = (
        _samples(df, tests)
        .groupBy("test", "value")
        .agg(F.count_if("in_a").alias("ca"), F.count("*").alias("c"))
    )
    placed = running_total(values, ["test", "value"], "c", "upto")
    # rank sums are taken from the first position of the test, like its ranks
    rank = F.col("upto") - F.col("c") + (F.col("c") + 1) / 2
    ties = F.col("c").cast("double")
    sums = placed.groupBy("test").agg(
        F.sum("ca").alias("n_a"), F.sum("c").alias("n"),
        F.sum(F.col("ca") * rank).alias("_ranks"),
        F.min(F.col("upto") - F.col("c")).alias("_start"),
        F.sum(ties * ties * ties - ties).alias("tie_term"),
    )
    n_a, n = F.col("n_a").cast("double"), F.col("n").cast("double")
    n_b = n - n_a
    u = F.col("_ranks") - n_a * F.col("_start") - n_a * (n_a + 1) / 2
    mean = n_a * n_b / 2
    spread = F.sqrt(n_a * n_b / 12 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    larger = F.greatest(u, n_a * n_b - u)
    return sums.select(
        "test", "n_a", (F.col("n") - F.col("n_a")).alias("n_b"),
        F.when((n_a > 0) & (n_b > 0), u).alias("u"), "tie_term",
        F.try_divide(larger - mean - 0.5, spread).alias("z"),
    )


def mann_whitney_u(df: DataFrame, tests: Sequence[TwoSample], digits: int = 4) -> DataFrame:
    """U of the first sample, z of the larger U with continuity, two-sided p."""
    return _rank_sums(df, tests).select(
        "test", "n_a", "n_b", half_even("u", 2).alias("mann_whitney_u"),
        half_even("z", digits).alias("z"),
        u_p_value("u", "n_a", "n_b", "z", "tie_term").alias("p_value_mwu"),
    )


def two_sample_report(
    df: DataFrame, tests: Sequence[TwoSample], alpha: float = 0.05
) -> DataFrame:
    """One row per test: samples, t, U, p-values, effect size and verdict."""
    ranks = _rank_sums(df, tests).select(
        "test", half_even("u", 2).alias("mann_whitney_u"),
        u_p_value("u", "n_a", "n_b", "z", "tie_term").alias("p_value_mwu"),
    )
    # one row per test on either side
    rows = _moments(df, tests).join(F.broadcast(ranks), "test", "left")
    names = F.array(
        *[
            F.struct(
                F.lit(t.name).alias("test"), F.lit(t.metric).alias("metric"),
                F.lit(t.label_a).alias("label_a"), F.lit(t.label_b).alias("label_b"),
            )
            for t in tests
        ]
    )
    listed = df.sparkSession.range(1).select(F.inline(names))
    rows = listed.join(F.broadcast(rows), "test", "left").withColumn("p", t_p_value("t", "df"))
    labelled = lambda s: F.format_string(
        "%s (N=%d)", F.col(f"label_{s}"), F.coalesce(F.col(f"n_{s}"), F.lit(0).cast("long"))
    )
    significant = F.coalesce(F.col("p") < alpha, F.lit(False))
    return rows.select(
        "test", "metric",
        labelled("a").alias("sample_a_label"),
        half_even("mean_a", 2).alias("sample_a_mean"),
        half_even(F.sqrt("var_a"), 2).alias("sample_a_std"),
        labelled("b").alias("sample_b_label"),
        half_even("mean_b", 2).alias("sample_b_mean"),
        half_even(F.sqrt("var_b"), 2).alias("sample_b_std"),
        half_even("t", 4).alias("t_statistic"),
        F.col("p").alias("p_value_ttest"),
        "mann_whitney_u", "p_value_mwu",
        half_even("d", 3).alias("cohens_d"),
        F.when(F.abs(half_even("d", 3)) >= 0.8, "Large").otherwise("Medium").alias("effect"),
        significant.alias("statistically_significant"),
        F.when(significant, f"Reject H0 (p < {alpha})")
        .otherwise(f"Fail to reject H0 (p >= {alpha})")
        .alias("conclusion"),
    )
