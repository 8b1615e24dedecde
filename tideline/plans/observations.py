"""Observation tables derived from an event log.

The event log has one row per event; a facility observation is a count of
events in a cell of the calendar.  ``observations`` has one row per date and
slot, ``site_observations`` one per site (user), date and hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import presets as P
from tideline.functions.banding import band, pulse_level, risk_level
from tideline.functions.calendar import calendar_columns, peak_flag
from tideline.functions.facility import (
    load_pct, prepared_qty, pulse_index, supply_balance, supply_risk, threshold_flag,
)
from tideline.functions.numbers import half_even
from tideline.session import stable

# which event type stands for which facility
EVENT_COLUMNS = {
    "sports_visitor_count": "view",
    "food_orders_demand": "purchase",
    "library_occupancy": "click",
    "classes_ending_near": "signup",
    "errors": "error",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _counts() -> list[Column]:
    return [
        F.count_if(F.col("event_type") == kind).cast("int").alias(name)
        for name, kind in EVENT_COLUMNS.items()
    ]


def slot_hour(hour: Column) -> Column:
    """Schedule hour of the slot that holds ``hour``."""
    return band(hour, P.SLOT_CUTS, [h for _, h, _ in P.SLOT_SCHEDULE])


def event_cells(events: DataFrame) -> DataFrame:
    """Counts per date and slot: the only pass over the log."""
    return events.groupBy(
        F.to_date("ts").alias("day"), slot_hour(F.hour("ts")).alias("starting_hour")
    ).agg(*_counts(), half_even(F.avg("value"), 1).alias("temperature"))


def observations(cells: DataFrame) -> DataFrame:
    """One row per date and slot, with capacities that follow from the table."""
    capacity = lambda c: F.ceil(F.max(c) * 1.25).cast("int")
    facts = cells.agg(
        capacity("sports_visitor_count").alias("sports"),
        capacity("food_orders_demand").alias("food"),
        capacity("library_occupancy").alias("library"),
        F.avg("errors").alias("errors"),
    )
    fact = facts.select(F.struct("sports", "food", "library", "errors")).scalar()
    month_day = F.dayofmonth("day")
    exam = month_day.between(15, 21)
    slots = [s for s, _, _ in P.SLOT_SCHEDULE]
    starts = [h for _, h, _ in P.SLOT_SCHEDULE]
    base = cells.select(
        *[c.alias(n) for n, c in calendar_columns("day").items()],
        "day", "starting_hour",
        band("starting_hour", starts[1:], slots).alias("time_slot"),
        peak_flag("starting_hour").alias("is_peak_hour"),
        *EVENT_COLUMNS, "temperature",
        exam.cast("int").alias("is_exam_week"),
        F.when(exam, "High").when(month_day <= 7, "Low").otherwise("Medium")
        .alias("academic_workload"),
        (F.col("errors") > fact["errors"]).cast("int").alias("campus_event_flag"),
        fact["sports"].alias("sports_capacity"),
        fact["food"].alias("food_capacity"),
        fact["library"].alias("library_capacity"),
    )
    loads = base.withColumns(
        {
            "sports_load_pct": load_pct("sports_visitor_count", "sports_capacity"),
            "library_load_pct": load_pct("library_occupancy", "library_capacity"),
            "food_prepared_qty": prepared_qty("food_orders_demand"),
        }
    )
    return loads.withColumns(
        {
            "sports_overcrowded_flag": threshold_flag("sports_load_pct"),
            "sports_risk_level": risk_level("sports_load_pct"),
            **supply_balance("food_prepared_qty", "food_orders_demand"),
            "campus_pulse_index": pulse_index(
                "sports_load_pct", "library_load_pct", "food_orders_demand",
                "academic_workload", ceiling=F.col("food_capacity"),
            ),
        }
    ).withColumns(
        {
            "food_risk_category": supply_risk("food_surplus_pct", "food_shortage_qty"),
            "campus_activity_status": pulse_level("campus_pulse_index"),
        }
    )


def site_observations(events: DataFrame) -> DataFrame:
    """One row per site, date and hour."""
    return events.groupBy(
        F.col("user_id").alias("site"), F.to_date("ts").alias("day"), F.hour("ts").alias("hour")
    ).agg(*_counts(), F.avg("value").alias("value"))


def raw_uploads(events: DataFrame) -> DataFrame:
    """Site observations under the headers and codes of a hand-made upload."""
    cell = site_observations(events)
    date = F.date_format("day", "yyyy-MM-dd")
    hour = F.col("hour")
    phase = F.dayofmonth("day")
    return cell.select(
        F.col("site").cast("string").alias("Site No."),
        date.alias(" Observation Date"),
        F.format_string("%02d:00-%02d:00", hour, (hour + 1) % 24).alias("Slot"),
        F.when(phase.between(15, 21), "Mid-Term").when(phase > 28, "Finals").otherwise("Regular")
        .alias("Semester Phase"),
        F.when(F.col("errors") > 0, "n/a")
        .otherwise((F.col("site") % 6).cast("string"))
        .alias("Academic Workload"),
        F.when(F.col("site") % 50 == 7, "Inter-college Match")
        .when(F.col("site") % 50 == 9, "Cultural Fest")
        .alias("Event Name"),
        F.when(F.col("library_occupancy") > 0, (F.col("sports_visitor_count") * 60).cast("string"))
        .otherwise("?")
        .alias("Sports-Visitors"),
        (F.col("food_orders_demand") * 150).alias("Food Orders"),
        F.when(F.col("food_orders_demand") > 0, F.lit("1")).alias("Food Risk"),
        (F.col("library_occupancy") * 120 + 40).alias("Library  Crowd"),
        F.col("classes_ending_near").alias("Classes"),
    )


def observation_table(spark: SparkSession, folder: str) -> DataFrame:
    """``observations`` of the events; the small cells are written, the log is read once."""
    return observations(stable(event_cells(read_table(spark, folder, "events"))))


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with what the orders say about it."""
    orders = read_table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.avg("o_totalprice").alias("mean_price"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_closed"),
    )
    customers = read_table(spark, folder, "customer")
    return customers.join(
        orders, customers.c_custkey == orders.o_custkey, "left"
    ).select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.coalesce("mean_price", F.lit(0.0)).alias("mean_price"),
        F.coalesce("n_closed", F.lit(0)).alias("n_closed"),
    )


def order_demand(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: what it asks for, with the features a demand model may use.

    Lines are reduced to one row per order before they meet the orders.
    """
    lines = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"),
        F.sum("l_extendedprice").alias("amount"),
    )
    orders = read_table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "o_orderkey", "o_orderdate", "n_lines", "quantity", "discount", "tax",
        F.month("o_orderdate").alias("month"), F.weekday("o_orderdate").alias("weekday"),
        (F.col("amount") / 1000).alias("amount"),
        (F.col("amount") > 250000).cast("int").alias("is_large"),
        F.when(F.col("amount") > 300000, "Surplus Risk").when(
            F.col("amount") < 100000, "Shortage Risk"
        ).otherwise("Balanced").alias("risk"),
        "o_orderstatus",
    )
