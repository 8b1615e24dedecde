"""Loads, balances and the pulse index."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import presets as P
from tideline.catalogue.registry import POINTS, PULSE, RISK, SEATS, query, with_obs
from tideline.functions.banding import availability, band, pulse_level, risk_level
from tideline.functions.facility import (
    load_pct, prepared_qty, pulse_breakdown, pulse_index, supply_balance, supply_risk,
    threshold_flag,
)
from tideline.functions.numbers import half_even
from tideline.plans.observations import observation_table, read_table


def _obs(spark, sf):
    return observation_table(spark, sf)


@query(
    "band",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'S' WHEN o_totalprice < 150000
      THEN 'M' ELSE 'L' END AS size, CASE WHEN o_custkey % 5 = 0 THEN 'none'
      WHEN o_custkey % 5 < 2 THEN 'few' ELSE 'many' END AS partial FROM orders""",
)
def _(spark, sf):
    part = F.nullif(F.col("o_custkey") % 5, F.lit(0))
    return read_table(spark, sf, "orders").select(
        "o_orderkey", band("o_totalprice", [50000, 150000], ["S", "M", "L"]).alias("size"),
        band(part, [2], ["few", "many"], null_label="none").alias("partial"),
    )


@query(
    "facility_load",
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_partkey % 10 > 0
      THEN round_even(l_quantity / (l_partkey % 10 * 10) * 100, 1) END AS load_pct FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice, load_pct,
      CASE WHEN load_pct >= 80 THEN 1 ELSE 0 END AS overcrowded,
      {RISK.format(c='load_pct')} AS risk, {SEATS.format(c='load_pct')} AS seats FROM l""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        load_pct("l_quantity", F.col("l_partkey") % 10 * 10).alias("load_pct"),
    )
    return lines.withColumns(
        {
            "overcrowded": threshold_flag("load_pct"),
            "risk": risk_level("load_pct"),
            "seats": availability("load_pct"),
        }
    )


@query(
    "supply_balance",
    """WITH q AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity::INT AS demand,
        round_even(50 * (1 - l_discount) - l_partkey % 20, 0)::INT AS prepared,
        CASE WHEN l_returnflag = 'R' THEN round_even(l_quantity::INT * 0.85::DOUBLE, 0)
          ELSE round_even(l_quantity::INT * 1.05::DOUBLE, 0) END::INT AS advised FROM lineitem),
    b AS (SELECT *, least(prepared, demand) AS food_sold_qty,
        greatest(0, prepared - least(prepared, demand)) AS food_surplus_qty,
        greatest(0, demand - prepared) AS food_shortage_qty,
        round_even(greatest(0, prepared - least(prepared, demand))::DOUBLE
          / greatest(1, prepared) * 100, 1) AS food_surplus_pct FROM q)
    SELECT *, CASE WHEN food_surplus_pct > 18 THEN 'Surplus Risk' WHEN food_shortage_qty > 10
      THEN 'Shortage Risk' ELSE 'Balanced' END AS risk,
      CASE WHEN food_surplus_pct > 18 THEN 'Surplus Risk' WHEN food_shortage_qty > 15
      THEN 'Shortage Risk' ELSE 'Balanced' END AS risk_15 FROM b""",
)
def _(spark, sf):
    made = half_even(50 * (1 - F.col("l_discount")) - F.col("l_partkey") % 20, 0).cast("int")
    risk = F.when(F.col("l_returnflag") == "R", P.SHORTAGE).otherwise(P.BALANCED)
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.col("l_quantity").cast("int").alias("demand"), made.alias("prepared"),
        prepared_qty(F.col("l_quantity").cast("int"), risk).alias("advised"),
    )
    out = lines.withColumns(supply_balance("prepared", "demand"))
    return out.withColumns(
        {
            "risk": supply_risk("food_surplus_pct", "food_shortage_qty"),
            "risk_15": supply_risk("food_surplus_pct", "food_shortage_qty", max_shortage=15),
        }
    )


LEVEL = """CASE l_linenumber % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High'
  ELSE 'Other' END"""
PARTS = f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  0.35::DOUBLE * (l_quantity * 2) AS s, 0.30::DOUBLE * (l_discount * 1000) AS l,
  0.25::DOUBLE * least(100.0::DOUBLE, greatest(0.0::DOUBLE,
    l_extendedprice / 200 / 300 * 100)) AS f,
  0.10::DOUBLE * {POINTS.format(c='(' + LEVEL + ')')} AS w FROM lineitem)"""


def _parts(spark, sf):
    code = F.col("l_linenumber") % 4
    level = F.when(code == 0, "Low").when(code == 1, "Medium").when(code == 2, "High")
    lines = read_table(spark, sf, "lineitem")
    return lines, (
        F.col("l_quantity") * 2, F.col("l_discount") * 1000, F.col("l_extendedprice") / 200,
        level.otherwise("Other"),
    )


@query(
    "pulse_index",
    f"""{PARTS}, i AS (SELECT l_orderkey, l_linenumber, l_extendedprice,
      round_even(least(100.0::DOUBLE, greatest(0.0::DOUBLE, s + l + f + w)), 2) AS pulse,
      round_even(s + l + f + w, 2) AS open_pulse FROM p)
    SELECT *, {PULSE.format(c='pulse')} AS status FROM i""",
)
def _(spark, sf):
    lines, facilities = _parts(spark, sf)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        pulse_index(*facilities).alias("pulse"),
        pulse_index(*facilities, clamp=False).alias("open_pulse"),
    ).withColumn("status", pulse_level("pulse"))


@query(
    "pulse_breakdown",
    f"""{PARTS} SELECT l_orderkey, l_linenumber, l_extendedprice,
      round_even(s, 2) AS sports_contribution, round_even(l, 2) AS library_contribution,
      round_even(f, 2) AS food_contribution, round_even(w, 2) AS workload_contribution FROM p""",
)
def _(spark, sf):
    lines, facilities = _parts(spark, sf)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        *[c.alias(n) for n, c in pulse_breakdown(*facilities).items()],
    )


ADVICE = " ".join(
    f"WHEN '{s}' THEN '{a}'" for s, (a, _) in P.PULSE_ADVICE.items()
)


@query(
    "pulse_advice",
    with_obs(
        f"""SELECT date, starting_hour, campus_pulse_index, campus_activity_status,
        CASE campus_activity_status WHEN 'Low Activity' THEN 'success' WHEN 'Moderate Load'
          THEN 'info' WHEN 'High Congestion' THEN 'warning' ELSE 'danger' END AS badge_color,
        CASE campus_activity_status {ADVICE} END AS advisory FROM obs"""
    ),
)
def _(spark, sf):
    texts = F.array(
        *[
            F.struct(F.lit(s).alias("campus_activity_status"), F.lit(a).alias("advisory"),
                     F.lit(b).alias("badge_color"))
            for s, (a, b) in P.PULSE_ADVICE.items()
        ]
    )
    advice = spark.range(1).select(F.inline(texts))
    obs = _obs(spark, sf).select(
        "date", "starting_hour", "campus_pulse_index", "campus_activity_status"
    )
    # one row per status
    return obs.join(F.broadcast(advice), "campus_activity_status")


OBS_COLUMNS = [
    "date", "day_of_week", "day_of_week_num", "is_weekend", "month", "time_slot",
    "starting_hour", "is_peak_hour", "sports_visitor_count", "food_orders_demand",
    "library_occupancy", "classes_ending_near", "temperature", "is_exam_week",
    "academic_workload", "campus_event_flag", "sports_capacity", "library_capacity",
    "sports_load_pct", "library_load_pct", "sports_overcrowded_flag", "sports_risk_level",
    "food_prepared_qty", "food_sold_qty", "food_surplus_qty", "food_surplus_pct",
    "food_shortage_qty", "food_risk_category", "campus_pulse_index", "campus_activity_status",
]


@query("observations", with_obs(f"SELECT {', '.join(OBS_COLUMNS)} FROM obs"))
def _(spark, sf):
    return _obs(spark, sf).select(*OBS_COLUMNS)
