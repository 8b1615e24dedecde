"""Scores and recommendations over tables of contexts with given predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import presets as P
from tideline.catalogue.learning import DEMAND, FEATURES, demand_parts, fitted, fitted_alone
from tideline.catalogue.registry import RISK, query
from tideline.operators.models import feature_importance
from tideline.operators.recommend import (
    expand_slots, explain_factors, listed_slots, recommend_prep, recommend_slots,
    recommend_study, requested_slot, day_schedule, score_crowd, score_demand, score_occupancy,
)
from tideline.plans.observations import read_table

SLOTS = ", ".join(f"({i}, '{s}', {h}, '{w}')" for i, (s, h, w) in enumerate(P.SLOT_SCHEDULE))
CONTEXTS = f"""
slots AS (SELECT * FROM (VALUES {SLOTS}) t(slot_ord, slot_name, hour, time_window)),
ctx AS (SELECT c_custkey, 7 + c_custkey % 16 AS requested_hour,
  CASE WHEN c_nationkey < 8 THEN 1 ELSE 0 END AS is_weekend FROM customer),
scored AS (SELECT c_custkey, requested_hour, is_weekend, slots.*,
  ((c_custkey * 37 + hour * 113) % 1000) / 10::DOUBLE AS load FROM ctx, slots),
asked AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY
  abs(hour - requested_hour) <= 1 DESC,
  CASE WHEN abs(hour - requested_hour) <= 1 THEN -slot_ord ELSE abs(slot_ord - 4) END) AS pick
  FROM scored),
req AS (SELECT c_custkey, slot_name AS rs, hour AS rh, time_window AS rw, load AS rl
  FROM asked WHERE pick = 1)"""


def _contexts(spark, sf):
    return read_table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_custkey") % 16 + 7).cast("int").alias("requested_hour"),
        (F.col("c_nationkey") < 8).cast("int").alias("is_weekend"),
    )


def _scored(spark, sf):
    hour = F.col("starting_hour")
    load = (F.col("c_custkey") * 37 + hour * 113) % 1000 / 10
    return expand_slots(_contexts(spark, sf)).withColumn("predicted_load_pct", load)


@query(
    "expand_slots",
    f"""WITH {CONTEXTS} SELECT c_custkey, slot_name, CAST(hour AS INT) AS starting_hour,
      time_window, CASE WHEN hour IN (17, 18, 19) OR (is_weekend = 1 AND hour IN (10, 16, 17))
      THEN 1 ELSE 0 END AS is_peak_hour FROM scored""",
)
def _(spark, sf):
    return expand_slots(_contexts(spark, sf)).select(
        "c_custkey", "slot_name", "starting_hour", "time_window", "is_peak_hour"
    )


@query(
    "requested_slot",
    f"WITH {CONTEXTS} SELECT c_custkey, rs AS slot, rl AS load FROM req",
)
def _(spark, sf):
    days = day_schedule(
        _scored(spark, sf), ["c_custkey", "requested_hour"], {"load": "predicted_load_pct"}, 6
    )
    slot = requested_slot(F.col("day"), F.col("requested_hour"))
    return days.select("c_custkey", slot["slot"].alias("slot"), slot["load"].alias("load"))


VERDICT = """CASE WHEN rl >= 80 THEN {0} WHEN rl >= 65 THEN {1} ELSE {2} END"""


def _verdict_sql(part):
    texts = []
    for key in ("high", "moderate", "optimal"):
        text = P.CROWD_VERDICTS[key][part]
        text = text.replace("{w}", "' || rw || '").replace("{l}", "' || rl || '")
        texts.append(f"'{text}'")
    return VERDICT.format(*texts)


@query(
    "recommend_slots",
    f"""WITH {CONTEXTS},
    d AS (SELECT DISTINCT c_custkey, requested_hour, slot_ord, slot_name, hour, time_window, load
      FROM scored),
    j AS (SELECT d.*, rs, rw, rl, hour <> rh AS other, load < rl AS quieter,
      count(*) FILTER (load < rl) OVER (PARTITION BY d.c_custkey) AS n_quieter
      FROM d JOIN req ON d.c_custkey IS NOT DISTINCT FROM req.c_custkey),
    o AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY load, slot_ord) AS rank
      FROM j WHERE other AND (quieter OR n_quieter = 0)),
    best AS (SELECT c_custkey, CAST(to_json(list({{'time_window': time_window,
        'predicted_load_pct': load,
        'capacity_reduction': CASE WHEN round_even(rl - load, 1) > 0 THEN round_even(rl - load, 1)
          || '% less crowded than requested time' ELSE 'Lowest alternative load available' END,
        'court_availability': CASE WHEN load < 60 THEN '{P.COURT_OPEN}' ELSE '{P.COURT_BUSY}' END,
        'tip': 'Shift to ' || time_window || ' for immediate access and reduced wait times.'}}
        ORDER BY rank)) AS VARCHAR) AS recommended FROM o WHERE rank <= 3 GROUP BY 1),
    days AS (SELECT c_custkey, requested_hour, rs, rw, rl, CAST(to_json(list({{'load': load,
        'ord': slot_ord, 'slot': slot_name, 'hour': hour, 'window': time_window}}
        ORDER BY slot_ord)) AS VARCHAR) AS full_day_schedule FROM j GROUP BY 1, 2, 3, 4, 5)
    SELECT days.c_custkey, CAST(requested_hour AS INT) AS requested_hour, rs AS requested_slot,
      rw AS requested_window, rl AS requested_load_pct, {_verdict_sql(0)} AS status_summary,
      {_verdict_sql(1)} AS action_verdict, rl >= 80 AS should_shift, recommended,
      full_day_schedule
    FROM days JOIN best ON days.c_custkey IS NOT DISTINCT FROM best.c_custkey""",
)
def _(spark, sf):
    out = recommend_slots(_scored(spark, sf), ["c_custkey"], "requested_hour")
    lists = ("recommended", "full_day_schedule")
    return out.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in lists})


OFFERS = f"""WITH {CONTEXTS},
j AS (SELECT *, load < rl AS quieter, count(*) FILTER (load < rl) OVER (PARTITION BY c_custkey)
  AS n_quieter FROM scored JOIN req USING (c_custkey) WHERE hour <> rh),
o AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY load, slot_ord) AS rank
  FROM j WHERE quieter OR n_quieter = 0)"""


@query(
    "recommended_slots",
    f"""{OFFERS} SELECT c_custkey, CAST(rank AS INT) AS rank, time_window,
      load AS predicted_load_pct,
      CASE WHEN round_even(rl - load, 1) > 0 THEN round_even(rl - load, 1)
        || '% less crowded than requested time' ELSE 'Lowest alternative load available' END
        AS capacity_reduction,
      CASE WHEN load < 60 THEN '{P.COURT_OPEN}' ELSE '{P.COURT_BUSY}' END AS court_availability,
      'Shift to ' || time_window || ' for immediate access and reduced wait times.' AS tip
    FROM o WHERE rank <= 3""",
)
def _(spark, sf):
    out = recommend_slots(_scored(spark, sf), ["c_custkey"], "requested_hour")
    return listed_slots(out, ["c_custkey"])


@query(
    "recommend_study",
    f"""WITH {CONTEXTS}, o AS (SELECT *, row_number() OVER (PARTITION BY c_custkey
      ORDER BY load, slot_ord) AS rank FROM scored WHERE load < 60)
    SELECT c_custkey, CAST(rank AS INT) AS rank, time_window, load AS predicted_load_pct
    FROM o WHERE rank <= 2""",
)
def _(spark, sf):
    return listed_slots(recommend_study(_scored(spark, sf), ["c_custkey"]), ["c_custkey"])


@query(
    "score_crowd",
    f"""WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, greatest(0.0::DOUBLE,
        round_even(l_extendedprice / 400 - 10, 1)) AS predicted_visitor_count,
        (l_discount > 0.09)::INT AS c, round_even(l_tax * 10.55, 3) AS overcrowding_probability
        FROM lineitem),
    l AS (SELECT *, round_even(predicted_visitor_count / 250 * 100, 1) AS predicted_load_pct FROM v)
    SELECT l_orderkey, l_linenumber, l_partkey, predicted_visitor_count, overcrowding_probability,
      predicted_load_pct, c = 1 OR predicted_load_pct >= 80 AS is_overcrowded,
      {RISK.format(c='predicted_load_pct')} AS risk_label FROM l""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_extendedprice") / 400 - 10).alias("predicted_value"),
        (F.col("l_discount") > 0.09).cast("int").alias("predicted_class"),
        (F.col("l_tax") * 10.55).alias("probability"),
    )
    return score_crowd(lines, capacity=250).drop(
        "predicted_value", "predicted_class", "probability", "facility_capacity"
    )


def _prep_sql(key):
    text = P.PREP_TEXTS[key].replace("{p}", "' || plan || '").replace(
        "{d}", "' || round_even(d, 0)::BIGINT || '"
    ).replace("{x}", "' || round_even(abs(plan - d), 0)::BIGINT || '").replace(
        "{r}", "' || r || '"
    )
    return f"'{text}'"


DEMANDS = """v AS (SELECT l_orderkey, l_linenumber, l_partkey, greatest(10.0::DOUBLE,
    round_even(l_extendedprice / 800, 1)) AS d, (l_quantity * 3 - 5)::INT AS plan FROM lineitem),
  w AS (SELECT *, round_even(d * 1.05::DOUBLE, 0)::INT AS r FROM v)"""


@query(
    "score_demand",
    f"""WITH {DEMANDS} SELECT l_orderkey, l_linenumber, l_partkey, d AS predicted_orders_demand,
      r AS recommended_preparation_qty, CASE WHEN plan > 0 THEN
        CASE WHEN plan - d > d * 0.18::DOUBLE THEN {_prep_sql('over')}
        WHEN plan - d < -(d * 0.10::DOUBLE) THEN {_prep_sql('under')}
        ELSE {_prep_sql('fit')} END END AS planned_prep_evaluation FROM w""",
)
def _(spark, sf):
    return score_demand(_demands(spark, sf), plan="plan", category=None).drop(
        "predicted_value", "plan"
    )


def _demands(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_extendedprice") / 800).alias("predicted_value"),
        (F.col("l_quantity") * 3 - 5).cast("int").alias("plan"),
    )


@query(
    "recommend_prep",
    f"""WITH {DEMANDS} SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN plan - d > 25 THEN 'High' WHEN plan - d > 10 THEN 'Moderate' ELSE 'Low' END
        AS waste_risk,
      CASE WHEN plan - d < -15 THEN 'High' WHEN plan - d < -5 THEN 'Moderate' ELSE 'Low' END
        AS shortage_risk FROM w""",
)
def _(spark, sf):
    scored = score_demand(_demands(spark, sf), plan="plan", category=None)
    return recommend_prep(scored, "plan").select(
        "l_orderkey", "l_linenumber", "l_partkey", "waste_risk", "shortage_risk"
    )


@query(
    "score_occupancy",
    """WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, greatest(10.0::DOUBLE,
        round_even(l_extendedprice / 300 - 5, 1)) AS predicted_occupancy FROM lineitem),
    l AS (SELECT *, round_even(predicted_occupancy / 350 * 100, 1) AS predicted_load_pct FROM v)
    SELECT *, predicted_load_pct >= 80 AS is_high_demand,
      CASE WHEN predicted_load_pct < 50 THEN 'Ample Seats Available' WHEN predicted_load_pct < 75
        THEN 'Moderate Availability' WHEN predicted_load_pct < 90
        THEN 'Limited Seats (High Demand)' ELSE 'Full Capacity (Critical)' END
        AS study_space_availability FROM l""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_extendedprice") / 300 - 5).alias("predicted_value"),
    )
    return score_occupancy(lines).drop("predicted_value", "library_capacity")


RULES = """
r AS (SELECT l_orderkey, l_linenumber, l_partkey, (7 + l_partkey % 14)::INT AS h,
  (l_quantity % 5)::INT AS c, l_returnflag = 'R' AS t, l_linestatus = 'O' AS m,
  l_discount > 0.08 AS e, l_tax > 0.06 AS w, (l_extendedprice / 500)::INT AS p FROM lineitem),
f AS (
  SELECT *, 'Evening Prime Workout Window (17:00 - 20:00)' AS factor, 35.0::DOUBLE AS push,
    0.15::DOUBLE AS weight FROM r WHERE h IN (17, 18, 19) UNION ALL
  SELECT *, 'Morning Low-Traffic Window', -18.0, 0.12 FROM r WHERE h IN (8, 10) UNION ALL
  SELECT *, c || ' Academic Batches Dismissing Nearby', c * 5.5, 0.08 FROM r WHERE c > 0 UNION ALL
  SELECT *, 'Inter-Collegiate Tournament in Progress', 28.0, 0.14 FROM r WHERE t UNION ALL
  SELECT *, 'Scheduled Sports Match', 16.5, 0.09 FROM r WHERE NOT t AND m UNION ALL
  SELECT *, 'Active Exam Week (Academic Priority Shift)', -19.5, 0.10 FROM r WHERE e UNION ALL
  SELECT *, 'Inclement Weather / Rain (Outdoor Courts Suspended)', -12.0, 0.05 FROM r WHERE w
  UNION ALL
  SELECT *, 'High Incoming Crowd Momentum (Previous Slot: ' || p || ' visitors)', 14.0, 0.16
  FROM r WHERE p > 120)"""


@query(
    "explain_factors",
    f"""WITH {RULES} SELECT l_orderkey, l_linenumber, l_partkey, factor, push::DOUBLE AS push,
      CASE WHEN push > 0 THEN 'positive' ELSE 'negative' END AS type,
      printf('%+.1f%%', push::DOUBLE) AS impact, weight::DOUBLE AS importance_weight,
      32.5::DOUBLE AS baseline_load_pct FROM f""",
)
def _(spark, sf):
    flag = lambda c: c.cast("int")
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_partkey") % 14 + 7).cast("int").alias("starting_hour"),
        (F.col("l_quantity") % 5).cast("int").alias("classes_ending_near"),
        flag(F.col("l_returnflag") == "R").alias("tournament_flag"),
        flag(F.col("l_linestatus") == "O").alias("sports_event_flag"),
        flag(F.col("l_discount") > 0.08).alias("is_exam_week"),
        flag(F.col("l_tax") > 0.06).alias("rain_flag"),
        F.rint(F.col("l_extendedprice") / 500).cast("int").alias("sports_prev_crowd"),
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return explain_factors(lines, keys).drop("ord", "feature")


# --- the same over predictions of the trained suites ---


def _predicted(spark, sf):
    _, test = demand_parts(spark, sf)
    return fitted(spark, sf, DEMAND).predict(test)


@query("predict_crowd")
def _(spark, sf):
    return score_crowd(_predicted(spark, sf), capacity=400).select(
        "o_orderkey", "predicted_visitor_count", "predicted_load_pct",
        "overcrowding_probability", "is_overcrowded", "risk_label",
    )


@query("predict_demand")
def _(spark, sf):
    plans = score_demand(_predicted(spark, sf), plan=(F.col("quantity") * 1.5).cast("int"))
    return plans.select(
        "o_orderkey", "predicted_orders_demand", "recommended_preparation_qty",
        "predicted_risk_category", "planned_prep_evaluation",
    )


@query("predict_occupancy")
def _(spark, sf):
    return score_occupancy(_predicted(spark, sf), capacity=400).select(
        "o_orderkey", "predicted_occupancy", "predicted_load_pct", "study_space_availability"
    )


@query("recommend_predicted")
def _(spark, sf):
    """Slots for each test order, the slot's hour standing in for the order's month."""
    _, test = demand_parts(spark, sf)
    slots = expand_slots(test.select("o_orderkey", *FEATURES))
    scored = fitted(spark, sf, DEMAND).predict(
        slots.withColumn("month", F.col("starting_hour") % 12 + 1)
    )
    loads = score_crowd(scored, capacity=400)
    out = recommend_slots(loads, ["o_orderkey"], 18, extra={"risk": "risk_label"})
    return listed_slots(out, ["o_orderkey"])


@query("explain_predicted")
def _(spark, sf):
    forest = "Random Forest Regressor"
    weights = feature_importance(spark, fitted_alone(spark, sf, (forest,)), forest)
    named = weights.withColumn(
        "feature", F.when(F.col("feature") == "month", "starting_hour")
        .when(F.col("feature") == "n_lines", "classes_ending_near").otherwise(F.col("feature"))
    )
    _, test = demand_parts(spark, sf)
    contexts = test.select(
        "o_orderkey", (F.col("month") + 7).alias("starting_hour"),
        F.col("n_lines").alias("classes_ending_near"),
    )
    return explain_factors(contexts, ["o_orderkey"], named)
