"""Registry of queries and the SQL texts they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL_TEXTS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL_TEXTS[name] = sql
        return function

    return add


# --- SQL pieces used by several queries ---

SLOT_HOUR = (
    "CASE WHEN hour(ts) < 10 THEN 8 WHEN hour(ts) < 12 THEN 10 WHEN hour(ts) < 14 THEN 12 "
    "WHEN hour(ts) < 17 THEN 14 WHEN hour(ts) < 20 THEN 17 ELSE 20 END"
)
SLOT_NAME = (
    "CASE {h} WHEN 8 THEN 'Morning' WHEN 10 THEN 'Late Morning' WHEN 12 THEN 'Noon / Lunch' "
    "WHEN 14 THEN 'Afternoon' WHEN 17 THEN 'Evening Peak' ELSE 'Night' END"
)
SLOT_BY_HOUR = (
    "CASE WHEN {h} < 10 THEN 'Morning' WHEN {h} < 12 THEN 'Late Morning' "
    "WHEN {h} < 14 THEN 'Noon / Lunch' WHEN {h} < 17 THEN 'Afternoon' "
    "WHEN {h} < 20 THEN 'Evening Peak' ELSE 'Night' END"
)
RISK = (
    "CASE WHEN {c} < 60 THEN 'Low' WHEN {c} < 80 THEN 'Moderate' WHEN {c} < 95 THEN 'High' "
    "ELSE 'Severe' END"
)
SEATS = (
    "CASE WHEN {c} < 50 THEN 'Ample' WHEN {c} < 75 THEN 'Moderate' WHEN {c} < 90 "
    "THEN 'Limited' ELSE 'Full' END"
)
PULSE = (
    "CASE WHEN {c} < 45 THEN 'Low Activity' WHEN {c} < 70 THEN 'Moderate Load' "
    "WHEN {c} < 85 THEN 'High Congestion' ELSE 'Campus Surge' END"
)
POINTS = (
    "CASE {c} WHEN 'Low' THEN 30.0::DOUBLE WHEN 'Medium' THEN 60.0::DOUBLE "
    "WHEN 'High' THEN 90.0::DOUBLE ELSE 60.0::DOUBLE END"
)

OBS = f"""
cells AS (
  SELECT CAST(ts AS DATE) AS day, {SLOT_HOUR} AS starting_hour,
    CAST(count(*) FILTER (event_type = 'view') AS INT) AS sports_visitor_count,
    CAST(count(*) FILTER (event_type = 'purchase') AS INT) AS food_orders_demand,
    CAST(count(*) FILTER (event_type = 'click') AS INT) AS library_occupancy,
    CAST(count(*) FILTER (event_type = 'signup') AS INT) AS classes_ending_near,
    CAST(count(*) FILTER (event_type = 'error') AS INT) AS errors,
    round_even(avg(value), 1) AS temperature
  FROM events GROUP BY 1, 2),
facts AS (
  SELECT CAST(ceil(max(sports_visitor_count) * 1.25) AS INT) AS sports_capacity,
    CAST(ceil(max(food_orders_demand) * 1.25) AS INT) AS food_capacity,
    CAST(ceil(max(library_occupancy) * 1.25) AS INT) AS library_capacity,
    avg(errors) AS mean_errors
  FROM cells),
loads AS (
  SELECT cells.*, strftime(day, '%Y-%m-%d') AS date, dayname(day) AS day_of_week,
    (isodow(day) - 1)::INT AS day_of_week_num,
    CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend, month(day)::INT AS month,
    {SLOT_NAME.format(h='starting_hour')} AS time_slot,
    CASE WHEN starting_hour IN (12, 13, 14, 17, 18, 19, 20) THEN 1 ELSE 0 END AS is_peak_hour,
    CASE WHEN day(day) BETWEEN 15 AND 21 THEN 1 ELSE 0 END AS is_exam_week,
    CASE WHEN day(day) BETWEEN 15 AND 21 THEN 'High' WHEN day(day) <= 7 THEN 'Low'
      ELSE 'Medium' END AS academic_workload,
    CASE WHEN errors > mean_errors THEN 1 ELSE 0 END AS campus_event_flag,
    sports_capacity, food_capacity, library_capacity,
    round_even(sports_visitor_count::DOUBLE / sports_capacity * 100, 1) AS sports_load_pct,
    round_even(library_occupancy::DOUBLE / library_capacity * 100, 1) AS library_load_pct,
    round_even(food_orders_demand * 1.05::DOUBLE, 0)::INT AS food_prepared_qty
  FROM cells, facts),
balance AS (
  SELECT *, CASE WHEN sports_load_pct >= 80 THEN 1 ELSE 0 END AS sports_overcrowded_flag,
    {RISK.format(c='sports_load_pct')} AS sports_risk_level,
    least(food_prepared_qty, food_orders_demand) AS food_sold_qty,
    greatest(0, food_prepared_qty - food_orders_demand) AS food_surplus_qty,
    round_even(greatest(0, food_prepared_qty - food_orders_demand)::DOUBLE
      / greatest(1, food_prepared_qty) * 100, 1) AS food_surplus_pct,
    greatest(0, food_orders_demand - food_prepared_qty) AS food_shortage_qty,
    round_even(least(100.0::DOUBLE, greatest(0.0::DOUBLE,
      0.35::DOUBLE * sports_load_pct + 0.30::DOUBLE * library_load_pct
      + 0.25::DOUBLE * least(100.0::DOUBLE, greatest(0.0::DOUBLE,
          food_orders_demand::DOUBLE / food_capacity * 100))
      + 0.10::DOUBLE * {POINTS.format(c='academic_workload')})), 2) AS campus_pulse_index
  FROM loads),
obs AS (
  SELECT *, CASE WHEN food_surplus_pct > 18 THEN 'Surplus Risk'
      WHEN food_shortage_qty > 10 THEN 'Shortage Risk' ELSE 'Balanced' END AS food_risk_category,
    {PULSE.format(c='campus_pulse_index')} AS campus_activity_status
  FROM balance)
"""


def with_obs(body: str) -> str:
    return f"WITH {OBS} {body}"
