"""Model metrics as aggregations over (label, prediction) columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.functions.numbers import clip, half_even
from tideline.operators.ordering import global_row_number


def standardize(
    df: DataFrame,
    columns: Sequence[str],
    fit_on: DataFrame | None = None,
    suffix: str = "_z",
    digits: int | None = None,
) -> DataFrame:
    """z-scores with the population deviation; a constant column is only centred."""
    fit = df if fit_on is None else fit_on
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        flat = F.min(v) == F.max(v)
        aggs.append(F.avg(v).alias(f"{c}_mean"))
        aggs.append(F.when(flat, 1.0).otherwise(F.stddev_pop(v)).alias(f"{c}_scale"))
    facts = fit.agg(*aggs).first()
    scores = {}
    for c in columns:
        mean, scale = facts[f"{c}_mean"], facts[f"{c}_scale"]
        z = (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale or 1.0)
        scores[c + suffix] = z if digits is None else half_even(z, digits)
    return df.withColumns(scores)


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (classes * n of the class), one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(F.lit(0))  # one row per class
    share = F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))
    return counts.withColumn(name, share)


def label_index(
    train: DataFrame, test: DataFrame, label: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Sorted classes of both parts with their index.

    If there is one class only, the first of ``extra`` that differs is added.
    """
    both = train.select(label).union(test.select(label)).where(F.col(label).isNotNull())
    seen = both.distinct()
    if extra:
        # two classes are enough to know that there is more than one
        two = seen.limit(2).agg(F.collect_set(label).alias("c"))
        others = F.slice(F.array_except(F.array(*[F.lit(x) for x in extra]), "c"), 1, 1)
        seen = seen.union(two.where(F.size("c") < 2).select(F.explode(others)))
    return global_row_number(seen, [label], "_rn").select(
        (F.col("_rn") - 1).cast("int").alias("label_index"), label
    )


def clip_predictions(
    df: DataFrame, low: float | None, high: float | None, column: str = "prediction"
) -> DataFrame:
    return df.withColumn(column, clip(F.col(column).cast("double"), low, high))


def regression_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """MAE, RMSE (2 digits) and R2 (4 digits); R2 of a constant label is 1 or 0."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    n, wrong = F.count(y - p), F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * n
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(F.min(y) == F.max(y), F.when(wrong == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(wrong, spread))
    )
    data = df.where(y.isNotNull() & p.isNotNull())
    return data.groupBy(*by).agg(
        n.alias("n"),
        half_even(F.avg(F.abs(y - p)), 2).alias("mae"),
        half_even(F.sqrt(F.avg((y - p) * (y - p))), 2).alias("rmse"),
        half_even(r2, 4).alias("r2"),
    )


def _pair_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str]) -> DataFrame:
    return (
        df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(*by, F.col(label).alias("_y"), F.col(prediction).alias("_p"))
        .agg(F.count("*").alias("_n"))
    )


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    average: str = "binary",
    positive: object = 1,
    digits: int | None = 4,
) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where undefined.

    ``binary`` looks at the ``positive`` class, ``weighted`` takes the mean over
    the classes by their label counts.
    """
    pairs = _pair_counts(df, label, prediction, by)
    hit = F.col("_y") == F.col("_p")
    by = list(by)
    if average == "binary":
        y, p = F.col("_y") == F.lit(positive), F.col("_p") == F.lit(positive)
        s = lambda cond: F.sum(F.when(cond, F.col("_n")).otherwise(0))
        tp, labelled, predicted = s(y & p), s(y), s(p)
        zero = lambda c: F.coalesce(c, F.lit(0.0))
        out = pairs.groupBy(*by).agg(
            F.sum("_n").alias("n"),
            F.try_divide(s(hit), F.sum("_n")).alias("accuracy"),
            zero(F.try_divide(tp, predicted)).alias("precision"),
            zero(F.try_divide(tp, labelled)).alias("recall"),
            zero(F.try_divide(tp * 2, labelled + predicted)).alias("f1"),
        )
    elif average == "weighted":
        n, right = F.col("_n"), F.when(hit, F.col("_n")).otherwise(F.lit(0))
        none = F.lit(0).cast("long")
        cell = lambda c, y_, p_, h: F.struct(
            F.col(c).alias("_c"), y_.alias("_ny"), p_.alias("_np"), h.alias("_nh")
        )
        sides = pairs.select(
            *by, F.inline(F.array(cell("_y", n, none, right), cell("_p", none, n, none)))
        )
        per = sides.groupBy(*by, "_c").agg(*[F.sum(c).alias(c) for c in ("_ny", "_np", "_nh")])
        zero = lambda c: F.coalesce(c, F.lit(0.0))
        total = F.sum("_ny")
        mean = lambda c: F.try_divide(F.sum(F.col("_ny") * zero(c)), total)
        out = per.groupBy(*by).agg(
            total.alias("n"),
            F.try_divide(F.sum("_nh"), total).alias("accuracy"),
            mean(F.try_divide(F.col("_nh"), F.col("_np"))).alias("precision"),
            mean(F.try_divide(F.col("_nh"), F.col("_ny"))).alias("recall"),
            mean(F.try_divide(F.col("_nh") * 2, F.col("_ny") + F.col("_np"))).alias("f1"),
        )
    else:
        raise ValueError("average is binary or weighted")
    scores = ["accuracy", "precision", "recall", "f1"]
    if digits is not None:
        out = out.withColumns({c: half_even(c, digits) for c in scores})
    return out.select(*by, "n", *scores)


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", zeros: bool = False
) -> DataFrame:
    """Counts of the pairs of classes that occur.

    ``zeros`` adds the other pairs of the classes seen on either side; that
    table has the square of the classes in rows by definition.
    """
    pairs = _pair_counts(df, label, prediction, ())
    if not zeros:
        return pairs.select(
            F.col("_y").alias("label"), F.col("_p").alias("prediction"), F.col("_n").alias("n")
        )
    # classes only, from the pair counts
    seen = pairs.select(F.explode(F.array("_y", "_p")).alias("c")).distinct()
    classes = seen.agg(F.array_sort(F.collect_set("c")).alias("c"))
    grid = classes.select(F.explode("c").alias("_y"), "c").select(
        "_y", F.explode("c").alias("_p")
    )
    return grid.join(pairs, ["_y", "_p"], "left").select(
        F.col("_y").alias("label"), F.col("_p").alias("prediction"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def select_best(
    df: DataFrame,
    score: str,
    candidate: str = "candidate",
    order: str | Column = "ord",
    by: Sequence[str] = (),
) -> DataFrame:
    """Candidate with the highest score; of equal ones the first in ``order``."""
    o = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*by).agg(
        F.max_by(candidate, F.struct(F.col(score), -o)).alias("best"),
        F.max(score).alias("best_score"),
    )
