"""Mapping, casting, imputing and auditing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.catalogue.registry import query, with_obs
from tideline.functions.text import normal_text
from tideline.operators.audit import duplicate_count, null_audit, schema_profile
from tideline.operators.mapping import (
    coalesce_derived, coerce_numeric, default_columns, fill_all, impute, map_categories,
    map_columns, normalize_names,
)
from tideline.plans.observations import observation_table, read_table


@query(
    "normalize_text",
    """SELECT p_partkey, trim(regexp_replace(lower(trim(p_name || ' (' || p_type || ') #')),
      '[^a-z0-9]+', '_', 'g'), '_') AS name FROM part""",
)
def _(spark, sf):
    text = F.concat("p_name", F.lit(" ("), "p_type", F.lit(") #"))
    return read_table(spark, sf, "part").select("p_partkey", normal_text(text).alias("name"))


@query(
    "normalize_names",
    """SELECT o_orderstatus AS order_state, count(*) AS n_rows, CAST(sum(o_custkey) AS BIGINT)
      AS total_key FROM orders GROUP BY 1""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders")
    messy = orders.groupBy(F.col("o_orderstatus").alias(" Order--State ")).agg(
        F.count("*").alias("N Rows"), F.max("o_custkey").alias("total key"),
        F.sum("o_custkey").alias("Total.Key"),
    )
    return normalize_names(messy)


@query(
    "map_columns",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(o_orderkey % 24 AS INT)
      AS starting_hour, CAST(o_custkey AS BIGINT) AS food_orders_demand,
      o_orderpriority AS event_type FROM orders""",
)
def _(spark, sf):
    raw = read_table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("Event Name"),
        F.lit("never used").alias("dt"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Observation  Date"),
        (F.col("o_orderkey") % 24).cast("int").alias("HOUR"),
        F.col("o_custkey").alias("Meals Ordered"),
        F.col("o_totalprice").alias("Unmapped price"),
    )
    return map_columns(raw)


@query(
    "default_columns",
    """SELECT event_id, 24.0::DOUBLE AS temperature, 'Clear' AS weather_condition,
      event_type, 5 AS sports_active_courts FROM events""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "event_type")
    return default_columns(
        events,
        {"temperature": 24.0, "weather_condition": "Clear", "event_type": "None",
         "sports_active_courts": 5},
    )


@query(
    "coerce_numeric",
    """SELECT event_id, CAST(trunc(coalesce(try_cast(CASE WHEN event_type = 'error' THEN 'n/a'
      ELSE json_extract_string(props, '$.k') || '.75' END AS DOUBLE), 85)) AS INT)
      AS sports_visitor_count, 130 AS food_orders_demand FROM events""",
)
def _(spark, sf):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.concat(F.get_json_object("props", "$.k"), F.lit(".75"))
    )
    events = read_table(spark, sf, "events").select(
        "event_id", text.alias("sports_visitor_count")
    )
    return coerce_numeric(events, {"sports_visitor_count": 85, "food_orders_demand": 130})


@query(
    "coalesce_derived",
    """SELECT o_orderkey,
      round_even(CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 1000
        ELSE o_custkey / 7::DOUBLE END, 1) AS load_pct,
      round_even(CASE WHEN o_orderpriority = '1-URGENT' THEN 50.0::DOUBLE
        ELSE o_totalprice / 5000 END, 2) AS pulse,
      round_even(o_custkey / 9::DOUBLE, 2) AS empty_pulse FROM orders""",
)
def _(spark, sf):
    price, key = F.col("o_totalprice"), F.col("o_custkey")
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "F", (price / 1000).cast("string"))
        .otherwise("unknown").alias("load_pct"),
        F.when(F.col("o_orderpriority") != "1-URGENT", price / 5000).alias("pulse"),
        F.lit(None).cast("double").alias("empty_pulse"),
    )
    out = coalesce_derived(orders, "load_pct", key / 7, 1)
    out = coalesce_derived(out, "pulse", key / 8, 2, partial=50.0)
    out = coalesce_derived(out, "empty_pulse", key / 9, 2, partial=50.0)
    return out.drop("o_custkey")


IMPUTE = """
WITH gaps AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, nullif(l_discount, 0) AS l_discount,
    CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity::INT END AS l_quantity,
    nullif(l_returnflag, 'R') AS l_returnflag FROM lineitem),
mode AS (SELECT l_returnflag FROM gaps WHERE l_returnflag IS NOT NULL GROUP BY 1
  ORDER BY count(*) DESC, 1 LIMIT 1),
med AS (SELECT median(l_discount) AS d, median(l_quantity) AS q FROM gaps)
SELECT gaps.l_orderkey, l_linenumber, l_extendedprice, coalesce(l_discount, med.d) AS l_discount,
  coalesce(l_quantity::DOUBLE, med.q) AS l_quantity,
  coalesce(gaps.l_returnflag, mode.l_returnflag) AS l_returnflag
FROM gaps, med, mode"""


@query("impute", IMPUTE)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity").cast("int")).alias("l_quantity"),
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
    )
    return impute(lines, ["l_discount", "l_quantity", "l_returnflag"])


@query(
    "impute_from_train",
    """SELECT o_orderkey, coalesce(CASE WHEN o_custkey % 4 > 0 THEN o_totalprice END,
      (SELECT median(o_totalprice) FROM orders WHERE o_custkey % 4 > 0
        AND o_orderdate < '2000-01-01')) AS o_totalprice FROM orders""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_custkey") % 4 > 0, F.col("o_totalprice")).alias("o_totalprice"),
    )
    train = orders.where(F.col("o_orderdate") < "2000-01-01")
    return impute(orders, ["o_totalprice"], fit_on=train).drop("o_orderdate")


@query(
    "fill_all",
    """SELECT event_id, coalesce(CASE WHEN event_type <> 'view' THEN value END, 0) AS value,
      coalesce(nullif(event_type, 'click'), '0') AS event_type FROM events""",
)
def _(spark, sf):
    return fill_all(
        read_table(spark, sf, "events").select(
            "event_id",
            F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
            F.nullif("event_type", F.lit("click")).alias("event_type"),
        )
    )


@query(
    "map_categories",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Mid' WHEN 'F' THEN 'Late'
      ELSE o_orderstatus END AS stage FROM orders""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders")
    return map_categories(
        orders.select("o_orderkey", F.col("o_orderstatus").alias("stage")),
        "stage", {"O": "Mid", "F": "Late"},
    )


@query(
    "null_audit",
    """WITH n AS (SELECT count(*) FILTER (l_discount = 0) AS d,
      count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem)
    SELECT 'l_orderkey' AS "column", 0::BIGINT AS nulls UNION ALL SELECT 'l_discount', d FROM n
    UNION ALL SELECT 'l_returnflag', r FROM n UNION ALL SELECT '(all)', d + r FROM n""",
)
def _(spark, sf):
    return null_audit(
        read_table(spark, sf, "lineitem").select(
            "l_orderkey", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
            F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
        )
    )


@query(
    "duplicate_count",
    """SELECT CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM
      (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT) AS duplicates""",
)
def _(spark, sf):
    return duplicate_count(read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "duplicate_rows",
    """SELECT CAST((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM
      (SELECT DISTINCT * FROM lineitem)) AS BIGINT) AS duplicates""",
)
def _(spark, sf):
    return duplicate_count(read_table(spark, sf, "lineitem"))


@query(
    "schema_profile",
    with_obs(
        """SELECT 1 AS position, 'date' AS "column", 'string' AS type, count(*) AS rows,
        count(date) AS non_null FROM obs UNION ALL
        SELECT 2, 'starting_hour', 'int', count(*), count(starting_hour) FROM obs UNION ALL
        SELECT 3, 'shortage', 'int', count(*), count(nullif(food_shortage_qty, 0)) FROM obs
        UNION ALL SELECT 4, 'campus_pulse_index', 'double', count(*), count(*) FROM obs"""
    ),
)
def _(spark, sf):
    obs = observation_table(spark, sf)
    return schema_profile(
        obs.select(
            "date", "starting_hour",
            F.nullif("food_shortage_qty", F.lit(0)).alias("shortage"), "campus_pulse_index",
        )
    )
