"""The whole batch over a canonical observation table: statistics, models, clusters, advice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tideline import presets as P
from tideline.functions.calendar import cyclic
from tideline.operators.association import corr_matrix
from tideline.operators.clusters import (
    CLUSTER, ClusterSuite, cluster_pipeline, cluster_points, cluster_profiles, kmeans_sweep,
    pca_project, save_clusters,
)
from tideline.operators.distribution import (
    QUARTILES, describe_stats, group_shift, iqr_bounds, iqr_outliers, rate_and_mean, trend_by, trend_by_event,
)
from tideline.operators.flow import SPLIT, chrono_split, lag_corr
from tideline.operators.hypothesis import preset_tests, two_sample_report
from tideline.operators.mapping import impute
from tideline.operators.models import (
    FOOD_SUITE, LIBRARY_SUITE, SPORTS_SUITE, FittedSuite, SuiteSpec, all_importances,
    feature_importance, model_report, save_suite, train_suite,
)
from tideline.operators.quantiles import quantile_values
from tideline.operators.recommend import (
    expand_slots, explain_factors, listed_slots, recommend_prep, recommend_slots, recommend_study, score_crowd,
    score_demand, score_occupancy,
)
from tideline.operators.ordering import global_row_number
from tideline.operators.rows import latest
from tideline.operators.stages import fit_scale
from tideline.session import stable

ORDER = ("date", "starting_hour", "record_id")
SUITES = (SPORTS_SUITE, FOOD_SUITE, LIBRARY_SUITE)


def clean_table(
    df: DataFrame, columns: Sequence[str] | None = None, fit_on: DataFrame | None = None
) -> DataFrame:
    """Fill the gaps and add the cyclic hour and weekday."""
    out = impute(df, columns, fit_on)
    hour, day = cyclic("starting_hour", 24), cyclic("day_of_week_num", 7)
    names = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
    return out.withColumns(dict(zip(names, (*hour, *day))))


def statistics(table: DataFrame, order: Sequence[str] = ORDER) -> dict[str, DataFrame]:
    """Descriptions, correlations, outliers, tests, trends and flows of the raw table."""
    columns = [c for c in P.CORRELATION_COLUMNS if c in table.columns]
    watched = ["sports_visitor_count", "food_orders_demand"]
    # one search for all that goes by quartiles
    described = [c for c in P.DESCRIBE_COLUMNS if c in table.columns]
    known = quantile_values(table, list(dict.fromkeys(described + watched)), QUARTILES)
    return {
        "descriptive": describe_stats(table, known=known),
        "pearson": corr_matrix(table, columns, undefined=0.0),
        "spearman": corr_matrix(table, columns, "spearman", undefined=0.0),
        "outlier_bounds": iqr_bounds(table, watched, known=known),
        **{f"outliers_{c}": iqr_outliers(table, c, known=known) for c in watched},
        "tests": two_sample_report(table, preset_tests()),
        "trend_by_day": trend_by(table, "day_of_week", order=P.DAY_ORDER),
        "trend_by_slot": trend_by(table, "time_slot", order=P.SLOT_ORDER),
        "trend_by_stage": trend_by(table, "semester_stage", order=P.STAGE_ORDER),
        "trend_by_event": trend_by_event(table),
        "flow": corr_matrix(table, P.FLOW_COLUMNS, deletion="pairwise", undefined=0.0),
        "flow_lag": lag_corr(table, "sports_visitor_count", "food_orders_demand", order),
        "flow_shift": group_shift(table),
    }


def train_all(
    table: DataFrame, order: Sequence[str] = ORDER, suites: Sequence[SuiteSpec] = SUITES,
    test_size: float = 0.2,
) -> tuple[DataFrame, dict[str, FittedSuite]]:
    """The cleaned, split table and one fitted suite per facility."""
    split = stable(chrono_split(clean_table(table), order, test_size))
    parts = [split.where(F.col(SPLIT) == p).drop(SPLIT) for p in ("train", "test")]
    return split, {s.name: train_suite(*parts, s) for s in suites}


def batch_tables(
    table: DataFrame, order: Sequence[str] = ORDER, suites: Sequence[SuiteSpec] = SUITES,
    k_range: tuple[int, int] = (2, 6), restarts: int = 10, silhouette: str = "squared",
    requested_hour: int = 18, models_path: str | None = None,
) -> dict[str, DataFrame]:
    """All result tables by name; pass them to ``summary_json`` to publish them.

    The table is written once and read by every step.  ``silhouette="euclidean"``
    takes the square of the rows.  With ``models_path`` the suites are saved under
    their names and what places rows in clusters under ``clusters``.
    """
    spark = table.sparkSession
    table = stable(table)
    split, fitted = train_all(table, order, suites)
    results = {"dataset": rate_and_mean(split, split=SPLIT), **statistics(table, order)}
    results["models"] = model_report(spark, list(fitted.values()))
    for name, suite in fitted.items():
        forest = "Random Forest Regressor"
        results[f"importance_{name}"] = feature_importance(spark, suite, forest)
    results["importances"] = all_importances(spark, list(fitted.values()))
    results["index_weights"] = spark.createDataFrame(
        list(P.PULSE_WEIGHTS.items()), "part string, weight double"
    )

    # numbers, since hashes of record ids may meet
    points = global_row_number(table.select("record_id", *P.CLUSTER_FEATURES), ["record_id"], "_id")
    sweep = kmeans_sweep(
        points, "_id", P.CLUSTER_FEATURES, *k_range, restarts=restarts, silhouette=silhouette
    )
    scale = fit_scale(table, P.CLUSTER_FEATURES)
    placed = stable(sweep.model.transform(scale.transform(table)))
    profiles = stable(cluster_profiles(placed))
    results["cluster_scores"] = sweep.frame(spark)
    results["cluster_profiles"] = profiles
    keep = ["record_id", "sports_load_pct", "library_load_pct", "food_orders_demand",
            "campus_pulse_index", "time_slot", "is_exam_week"]
    projection = pca_project(placed, 2)
    results["cluster_variance"] = projection.frame(spark)
    results["cluster_points"] = cluster_points(placed, profiles, projection, order, keep)
    results["cluster_axes"] = pca_project(placed, 3).apply(placed).select(
        "record_id", CLUSTER, "pca_1", "pca_2", "pca_3"
    )
    clusters = ClusterSuite(
        cluster_pipeline(scale, sweep.model, profiles, projection), sweep.scores, sweep.best_k,
        projection.variance,
    )
    if models_path:
        for name, suite in fitted.items():
            save_suite(spark, suite, f"{models_path}/{name}")
        save_clusters(spark, clusters, f"{models_path}/clusters")

    # advice for the latest situation
    context = latest(split.drop(SPLIT), order, 1)
    if "sports" in fitted:
        crowd = score_crowd(fitted["sports"].predict(expand_slots(context)))
        results["advice_sports"] = listed_slots(
            recommend_slots(crowd, ["record_id"], requested_hour), ["record_id"]
        )
        results["explanations"] = explain_factors(
            context, ["record_id"], results["importance_sports"]
        ).drop("ord", "feature")
    if "food" in fitted:
        plan = "food_prepared_qty"
        demand = score_demand(fitted["food"].predict(context), plan=plan)
        results["advice_food"] = recommend_prep(demand, plan).select(
            "record_id", "predicted_orders_demand", "recommended_preparation_qty",
            "predicted_risk_category", plan, "planned_prep_evaluation", "waste_risk",
            "shortage_risk",
        )
    if "library" in fitted:
        slots = fitted["library"].predict(expand_slots(context, peak=None))
        seats = recommend_study(score_occupancy(slots.drop("library_capacity")), ["record_id"])
        results["advice_library"] = listed_slots(seats, ["record_id"])
    return results
