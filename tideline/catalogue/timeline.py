"""Lags, history, splits and flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.catalogue.registry import query, with_obs
from tideline.operators.flow import (
    chrono_split, history_features, lag_corr, lag_feature, random_split, transition_matrix,
)
from tideline.operators.ordering import average_rank, global_row_number, running_total
from tideline.plans.observations import observation_table, read_table

LINE_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
]


@query(
    "global_row_number",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER
      (ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(*LINE_ORDER)
    return global_row_number(lines, LINE_ORDER).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "rn"
    )


@query(
    "running_total",
    """SELECT event_id, CAST(sum(user_id) OVER (ORDER BY ts, event_id) AS BIGINT) AS total
    FROM events""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events").select("ts", "event_id", "user_id")
    return running_total(events, ["ts", "event_id"], "user_id").select("event_id", "total")


@query(
    "average_rank",
    """SELECT 'l_discount' AS metric, l_discount AS value, count(*) AS cnt,
      (sum(count(*)) OVER (ORDER BY l_discount) - count(*) + (count(*) + 1) / 2)::DOUBLE AS rank
      FROM lineitem GROUP BY 2 UNION ALL
    SELECT 'l_extendedprice', l_extendedprice, count(*), (sum(count(*)) OVER
      (ORDER BY l_extendedprice) - count(*) + (count(*) + 1) / 2)::DOUBLE
      FROM lineitem GROUP BY 2""",
)
def _(spark, sf):
    return average_rank(read_table(spark, sf, "lineitem"), ["l_discount", "l_extendedprice"])


@query(
    "lag_feature",
    """SELECT event_id, coalesce(lag(value) OVER o, value) AS prev_value,
      coalesce(lag(event_type) OVER o, event_type) AS prev_type FROM events
    WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events").drop("props")
    out = lag_feature(
        events, {"prev_value": "value", "prev_type": "event_type"}, ["ts", "event_id"],
        ["user_id"],
    )
    return out.select("event_id", "prev_value", "prev_type")


@query(
    "lag_feature_global",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice, coalesce(lag(l_quantity) OVER
      (ORDER BY {', '.join(LINE_ORDER)}), l_quantity) AS prev FROM lineitem""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(*LINE_ORDER, "l_quantity")
    return lag_feature(lines, {"prev": "l_quantity"}, LINE_ORDER).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "prev"
    )


@query(
    "history_features",
    """SELECT o_orderkey, round_even(avg(o_totalprice) OVER (), 1) AS hist_avg,
      max(o_totalprice) OVER () AS hist_peak FROM orders""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return history_features(
        orders, {"hist_avg": "o_totalprice"}, {"hist_peak": "o_totalprice"}
    ).drop("o_totalprice")


@query(
    "history_features_by_key",
    """SELECT o_orderkey, round_even(avg(o_totalprice) OVER w, 1) AS hist_avg,
      max(o_totalprice) OVER w AS hist_peak FROM orders WINDOW w AS (PARTITION BY o_custkey)""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return history_features(
        orders, {"hist_avg": "o_totalprice"}, {"hist_peak": "o_totalprice"}, ["o_custkey"]
    ).select("o_orderkey", "hist_avg", "hist_peak")


@query(
    "chrono_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey)
      <= floor(count(*) OVER () * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS split
    FROM orders""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders")
    return chrono_split(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "split")


@query(
    "chrono_split_keys",
    """SELECT p_partkey, CASE WHEN row_number() OVER (ORDER BY p_retailprice, p_partkey)
      <= floor(count(*) OVER () * (1 - 0.3::DOUBLE)) THEN 'train' ELSE 'test' END AS split
    FROM part""",
)
def _(spark, sf):
    part = read_table(spark, sf, "part")
    split = chrono_split(part, ["p_retailprice", "p_partkey"], 0.3)
    return split.select("p_partkey", "split")


@query("random_split")
def _(spark, sf):
    orders = read_table(spark, sf, "orders")
    return random_split(orders, ["o_orderkey"]).groupBy("split").count()


@query(
    "random_split_exact",
    """SELECT 'test' AS split, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n FROM orders UNION ALL
    SELECT 'train', count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) FROM orders""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey")
    split = random_split(orders, ["o_orderkey"], exact=True)
    return split.groupBy("split").agg(F.count("*").alias("n"))


@query(
    "lag_corr",
    with_obs(
        """, s AS (SELECT sports_visitor_count AS a, lead(food_orders_demand) OVER
          (ORDER BY day, starting_hour) AS b FROM obs)
        SELECT round_even(corr(a, b), 3) AS lag_correlation, count(b) AS pairs FROM s"""
    ),
)
def _(spark, sf):
    obs = observation_table(spark, sf)
    return lag_corr(obs, "sports_visitor_count", "food_orders_demand", ["day", "starting_hour"])


@query(
    "lag_corr_by_user",
    """WITH s AS (SELECT value AS a, lead(event_id) OVER (PARTITION BY user_id
      ORDER BY ts, event_id) AS b FROM events)
    SELECT round_even(corr(a, b), 3) AS lag_correlation, count(b) AS pairs FROM s""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events")
    return lag_corr(events, "value", "event_id", ["ts", "event_id"], ["user_id"])


@query(
    "transition_matrix",
    """WITH s AS (SELECT event_type AS a, lead(event_type) OVER (PARTITION BY user_id
      ORDER BY ts, event_id) AS b FROM events),
    c AS (SELECT a, b, count(*) AS n FROM s WHERE b IS NOT NULL GROUP BY 1, 2)
    SELECT a AS from_state, b AS to_state, n,
      round_even(n / sum(n) OVER (PARTITION BY a), 4) AS probability FROM c""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events")
    return transition_matrix(events, ["user_id"], "event_type", ["ts", "event_id"])
