"""Scores, slot recommendations, preparation advice and explanations.

All work on a table of contexts (one row per question) and its predictions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline import presets as P
from tideline.functions.banding import band, risk_level
from tideline.functions.calendar import peak_flag
from tideline.functions.facility import load_pct
from tideline.functions.numbers import clip, col, half_even
from tideline.functions.texts import fill


def _as_column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def score_crowd(
    df: DataFrame, value: str = "predicted_value", flag: str | None = "predicted_class",
    probability: str | None = "probability", capacity: float | Column = 200,
) -> DataFrame:
    """Count, load, probability, overcrowded if the model or the load says so, risk band."""
    count = clip(half_even(F.col(value).cast("double"), 1), 0.0, None)
    out = df.withColumn("predicted_visitor_count", count).withColumn(
        "facility_capacity", _as_column(capacity)
    )
    out = out.withColumn(
        "predicted_load_pct", load_pct("predicted_visitor_count", "facility_capacity")
    )
    crowded = F.col("predicted_load_pct") >= P.HIGH_LOAD
    if flag:
        crowded = crowded | (F.coalesce(F.col(flag).cast("int"), F.lit(0)) == 1)
    if probability:
        out = out.withColumn("overcrowding_probability", half_even(probability, 3))
    return out.withColumns(
        {"is_overcrowded": crowded, "risk_label": risk_level("predicted_load_pct")}
    )


def score_demand(
    df: DataFrame, value: str = "predicted_value", plan: str | Column | None = None,
    category: str | None = "predicted_class",
) -> DataFrame:
    """Demand, advised preparation and, where a plan is given, a verdict on it."""
    demand = clip(half_even(F.col(value).cast("double"), 1), 10.0, None)
    out = df.withColumn("predicted_orders_demand", demand)
    advised = half_even(F.col("predicted_orders_demand") * P.SAFE_PREP, 0).cast("int")
    out = out.withColumn("recommended_preparation_qty", advised)
    if category:
        out = out.withColumn(
            "predicted_risk_category", F.coalesce(F.col(category).cast("string"),
                                                  F.lit(P.BALANCED))
        )
    if plan is None:
        return out.withColumn("planned_prep_evaluation", F.lit(None).cast("string"))
    p, d = col(plan), F.col("predicted_orders_demand")
    gap = p - d
    whole = lambda c: half_even(c, 0).cast("bigint")
    say = lambda key: fill(
        P.PREP_TEXTS[key], p=p, d=whole(d), x=whole(F.abs(gap)),
        r=F.col("recommended_preparation_qty"),
    )
    verdict = (
        F.when(gap > d * P.PREP_OVER, say("over"))
        .when(gap < -(d * P.PREP_UNDER), say("under"))
        .otherwise(P.PREP_TEXTS["fit"])
    )
    return out.withColumn("planned_prep_evaluation", F.when(p > 0, verdict))


def score_occupancy(
    df: DataFrame, value: str = "predicted_value", capacity: float | Column = 350
) -> DataFrame:
    """Occupancy, load, high-demand flag and seat availability."""
    seats = clip(half_even(F.col(value).cast("double"), 1), 10.0, None)
    out = df.withColumn("predicted_occupancy", seats).withColumn(
        "library_capacity", _as_column(capacity)
    )
    out = out.withColumn("predicted_load_pct", load_pct("predicted_occupancy", "library_capacity"))
    return out.withColumns(
        {
            "is_high_demand": F.col("predicted_load_pct") >= P.HIGH_LOAD,
            "study_space_availability": band(
                "predicted_load_pct", P.AVAILABILITY_BAND[0], P.AVAILABILITY_LONG
            ),
        }
    )


def expand_slots(
    df: DataFrame,
    schedule: Sequence[tuple[str, int, str]] = P.SLOT_SCHEDULE,
    peak: str | None = "recommend",
) -> DataFrame:
    """Every context once per slot, with the slot's hour and, if wanted, its peak flag."""
    cells = [
        F.struct(
            F.lit(i).alias("slot_ord"), F.lit(s).alias("slot_name"), F.lit(h).alias("starting_hour"),
            F.lit(w).alias("time_window"),
        )
        for i, (s, h, w) in enumerate(schedule)
    ]
    rest = [c for c in df.columns if c not in ("slot_ord", "slot_name", "starting_hour",
                                               "time_window")]
    out = df.select(*rest, F.inline(F.array(*cells)))
    if peak is None:
        return out
    weekend = F.col("is_weekend") if "is_weekend" in df.columns else None
    return out.withColumn("is_peak_hour", peak_flag("starting_hour", peak, weekend))


def day_schedule(
    scored: DataFrame, by: Sequence[str], fields: Mapping[str, str], slots: int
) -> DataFrame:
    """One row per context with its slots as an array in slot order.

    Each slot is its own aggregate, so the state per context has a fixed size.
    Structs are aggregated in sorted rows: brought together first, a task sorts
    its share of the contexts, not all slots of the part of a file that it reads.
    """
    cell = F.struct(
        F.col(fields["load"]).cast("double").alias("load"), F.col("slot_ord").alias("ord"),
        F.col("slot_name").alias("slot"), F.col("starting_hour").alias("hour"),
        F.col("time_window").alias("window"),
        *[F.col(c).alias(n) for n, c in fields.items() if n != "load"],
    )
    picks = [F.max(F.when(F.col("slot_ord") == i, cell)).alias(f"s{i}") for i in range(slots)]
    listed = F.filter(F.array(*[F.col(f"s{i}") for i in range(slots)]), lambda s: s.isNotNull())
    return scored.repartition(*by).groupBy(*by).agg(*picks).select(*by, listed.alias("day"))


def requested_slot(day: Column, hour: Column, default: str = P.DEFAULT_SLOT) -> Column:
    """Last slot that starts within an hour of ``hour``, else the default slot."""
    near = F.filter(day, lambda s: F.abs(s["hour"] - hour) <= 1)
    usual = F.filter(day, lambda s: s["slot"] == default)
    return F.when(F.size(near) > 0, F.try_element_at(near, F.lit(-1))).otherwise(
        F.try_element_at(usual, F.lit(1))
    )


def recommend_slots(
    scored: DataFrame, by: Sequence[str], requested_hour: str | int = 18, k: int = 3,
    load: str = "predicted_load_pct", extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per context: the requested slot, a verdict, and the ``k`` quietest better slots.

    ``by`` identifies a context.  If no slot is quieter, all others are offered.
    """
    by = list(by)
    if isinstance(requested_hour, str) and requested_hour not in by:
        by.append(requested_hour)
    hour = F.col(requested_hour) if isinstance(requested_hour, str) else F.lit(requested_hour)
    fields = {"load": load, **(extra or {})}
    days = day_schedule(scored, by, fields, len(P.SLOT_SCHEDULE))
    days = days.withColumn("asked", requested_slot(F.col("day"), hour))
    others = F.filter("day", lambda s: s["hour"] != F.col("asked.hour"))
    quieter = F.filter("others", lambda s: s["load"] < F.col("asked.load"))
    days = days.withColumn("others", others).withColumn("quieter", quieter)
    offered = F.when(F.size("quieter") > 0, F.col("quieter")).otherwise(F.col("others"))
    # slots compare by load, then by their order in the day
    days = days.withColumn("offered", F.slice(F.array_sort(offered), 1, k))
    high, moderate = P.CROWD_LIMITS
    asked_load, window = F.col("asked.load"), F.col("asked.window")
    pick = lambda i: F.when(
        asked_load >= high, _verdict("high", i, window, asked_load)
    ).when(asked_load >= moderate, _verdict("moderate", i, window, asked_load)).otherwise(
        _verdict("optimal", i, window, asked_load)
    )
    return days.select(
        *by,
        hour.alias("requested") if not isinstance(requested_hour, str) else F.lit(None).alias("_"),
        F.col("asked.slot").alias("requested_slot"),
        window.alias("requested_window"),
        asked_load.alias("requested_load_pct"),
        pick(0).alias("status_summary"),
        pick(1).alias("action_verdict"),
        F.coalesce(asked_load >= high, F.lit(False)).alias("should_shift"),
        F.transform("offered", lambda s: _offer(s, asked_load)).alias("recommended"),
        F.col("day").alias("full_day_schedule"),
    ).drop("_")


def _verdict(key: str, part: int, window: Column, load: Column) -> Column:
    return fill(P.CROWD_VERDICTS[key][part], w=window, l=load)


def _offer(slot: Column, asked_load: Column) -> Column:
    saving = half_even(asked_load - slot["load"], 1)
    return F.struct(
        slot["window"].alias("time_window"),
        slot["load"].alias("predicted_load_pct"),
        F.when(saving > 0, fill(P.SAVING_TEXT, s=saving))
        .otherwise(P.NO_SAVING_TEXT)
        .alias("capacity_reduction"),
        F.when(slot["load"] < P.COURT_LIMIT, P.COURT_OPEN)
        .otherwise(P.COURT_BUSY)
        .alias("court_availability"),
        fill(P.SLOT_TIP, w=slot["window"]).alias("tip"),
    )


def listed_slots(recommended: DataFrame, by: Sequence[str], column: str = "recommended"):
    """One row per recommended slot, with its rank."""
    rows = recommended.select(*by, F.posexplode(column).alias("_pos", "_slot"))
    return rows.select(*by, (F.col("_pos") + 1).alias("rank"), "_slot.*")


def recommend_study(
    scored: DataFrame, by: Sequence[str], k: int = 2, load: str = "predicted_load_pct",
    limit: float = P.STUDY_LIMIT, extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per context the ``k`` quietest slots below ``limit`` and the whole day."""
    days = day_schedule(scored, by, {"load": load, **(extra or {})}, len(P.SLOT_SCHEDULE))
    free = F.array_sort(F.filter("day", lambda s: s["load"] < limit))
    best = F.transform(
        F.slice(free, 1, k),
        lambda s: F.struct(
            s["window"].alias("time_window"), s["load"].alias("predicted_load_pct")
        ),
    )
    return days.select(*by, best.alias("recommended"), F.col("day").alias("full_day_schedule"))


def recommend_prep(
    df: DataFrame, plan: str, demand: str = "predicted_orders_demand"
) -> DataFrame:
    """Waste and shortage risk of a planned preparation."""
    gap = F.col(plan) - F.col(demand)
    waste, short = P.WASTE_CUTS, P.SHORT_CUTS
    return df.withColumns(
        {
            "waste_risk": F.when(gap > waste[0], "High").when(gap > waste[1], "Moderate")
            .otherwise("Low"),
            "shortage_risk": F.when(gap < short[0], "High").when(gap < short[1], "Moderate")
            .otherwise("Low"),
        }
    )


def explain_factors(
    df: DataFrame, by: Sequence[str], importances: DataFrame | None = None,
    rules: Mapping[str, tuple] = P.EXPLAIN_RULES,
) -> DataFrame:
    """Rows (factor, impact, push, type, importance_weight) for what moves each context's load
    away from the baseline.

    ``importances`` (feature, importance) has one row per feature.
    """
    v = {
        c: F.coalesce(F.col(c), F.lit(default)) if c in df.columns else F.lit(default)
        for c, default in P.EXPLAIN_DEFAULTS.items()
    }
    hour, classes = v["starting_hour"], v["classes_ending_near"]
    momentum = v["sports_prev_crowd"]
    tournament = v["tournament_flag"] == 1
    evening = hour.isin(P.EVENING_HOURS)
    when = {
        "evening": (evening, None),
        "morning": (~evening & hour.isin(P.MORNING_HOURS), None),
        "classes": (classes > 0, classes),
        "tournament": (tournament, None),
        "match": (~tournament & (v["sports_event_flag"] == 1), None),
        "exam": (v["is_exam_week"] == 1, None),
        "rain": (v["rain_flag"] == 1, None),
        "momentum": (momentum > P.MOMENTUM_LIMIT, momentum),
    }
    cells = []
    for i, (key, (text, push, feature, weight)) in enumerate(rules.items()):
        holds, shown = when[key]
        size = classes * F.lit(push) if key == "classes" else F.lit(push)
        cells.append(
            F.when(
                holds,
                F.struct(
                    F.lit(i).alias("ord"),
                    (fill(text, v=shown) if shown is not None else F.lit(text)).alias("factor"),
                    size.cast("double").alias("push"),
                    F.lit("positive" if push > 0 else "negative").alias("type"),
                    F.lit(feature).alias("feature"),
                    F.lit(float(weight)).alias("importance_weight"),
                ),
            )
        )
    listed = F.filter(F.array(*cells), lambda s: s.isNotNull())
    push = half_even("push", 1)
    sign = F.when(F.col("push") > 0, "+").otherwise("")
    rows = df.select(*by, F.inline(listed)).withColumn(
        "impact", F.concat(sign, push.cast("string"), F.lit("%"))
    ).withColumn("baseline_load_pct", F.lit(P.BASELINE_LOAD))
    if importances is None:
        return rows
    known = importances.select("feature", F.col("importance").alias("_known"))
    return rows.join(F.broadcast(known), "feature", "left").withColumn(
        "importance_weight", F.coalesce("_known", "importance_weight")
    ).drop("_known")
