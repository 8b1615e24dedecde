"""Filters, searches, listings and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.catalogue.registry import query, with_obs
from tideline.operators.rows import (
    latest, listwise, sample_head, search_rows, top_features, top_k_per_group,
)
from tideline.plans.observations import observation_table, read_table


@query(
    "boolean_filters",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
    WHERE l_shipdate >= '1998-01-01' AND l_returnflag = 'R' AND (l_quantity < 5
      OR l_quantity > 45) AND l_discount <> 0.05""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    quantity = F.col("l_quantity")
    return lines.where(
        (F.col("l_shipdate") >= "1998-01-01") & (F.col("l_returnflag") == "R")
        & ((quantity < 5) | (quantity > 45)) & (F.col("l_discount") != 0.05)
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query(
    "listwise",
    """SELECT event_id, value, event_type FROM events WHERE event_type <> 'view'
      AND user_id % 3 > 0""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 3 > 0, F.col("value")).alias("value"),
        F.nullif("event_type", F.lit("view")).alias("event_type"),
    )
    return listwise(events, ["value", "event_type"])


@query(
    "search_rows",
    """SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'br')
      OR contains(lower(p_brand), 'br') OR contains(lower(p_type), 'br')
      OR contains(CAST(p_partkey AS VARCHAR), 'br')""",
)
def _(spark, sf):
    part = read_table(spark, sf, "part")
    found = search_rows(part, "BR", ["p_name", "p_brand", "p_type", "p_partkey"])
    return found.select("p_partkey", "p_name", "p_brand")


@query(
    "search_observations",
    with_obs(
        """SELECT date, time_slot, day_of_week, campus_pulse_index FROM obs
        WHERE contains(lower(date), 'mon') OR contains(lower(time_slot), 'mon')
          OR contains(lower(day_of_week), 'mon')"""
    ),
)
def _(spark, sf):
    obs = observation_table(spark, sf)
    return search_rows(obs, "Mon", ["date", "time_slot", "day_of_week"]).select(
        "date", "time_slot", "day_of_week", "campus_pulse_index"
    )


@query(
    "latest",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type FROM events
    ORDER BY ts DESC, event_id DESC LIMIT 60""",
)
def _(spark, sf):
    last = latest(read_table(spark, sf, "events"), ["ts", "event_id"], 60)
    return last.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "event_type"
    )


@query(
    "sample_head",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 15""",
)
def _(spark, sf):
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"]
    return sample_head(read_table(spark, sf, "lineitem"), order, 15).select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    "top_features",
    """SELECT p_type AS feature, round_even(avg(p_retailprice), 4) AS importance FROM part
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6""",
)
def _(spark, sf):
    means = read_table(spark, sf, "part").groupBy(F.col("p_type").alias("feature")).agg(
        F.bround(F.avg("p_retailprice"), 4).alias("importance")
    )
    return top_features(means, 6)


@query(
    "top_k_per_group",
    """SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber, CAST(rank AS INT) AS rank FROM
    (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey,
      l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 3""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    best = top_k_per_group(
        lines, ["l_suppkey"], ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"], 3
    )
    return best.select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber", "rank")
