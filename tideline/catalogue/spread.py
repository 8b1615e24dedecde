"""Distributions, trends, outliers and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import presets as P
from tideline.catalogue.registry import query, with_obs
from tideline.functions.numbers import half_even
from tideline.operators.distribution import (
    box_stats, describe_stats, group_profile, group_shift, histogram, iqr_bounds, iqr_outliers,
    kde, mode_per_group, normalized_profile, outlier_context, rate_and_mean, trend_by,
    trend_by_event,
)
from tideline.operators.flow import chrono_split
from tideline.operators.quantiles import approx_quantiles
from tideline.plans.observations import observation_table, read_table
from tideline.session import scratch_path
from tideline.sources.sketches import DaySketches

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _obs(spark, sf):
    return observation_table(spark, sf)


def _describe(table: str, column: str, where: str = "") -> str:
    return f"""SELECT '{column}' AS metric, count({column}) AS count,
      round_even(avg({column}), 2) AS mean, round_even(stddev_samp({column}), 2) AS std,
      round_even(median({column}), 2) AS median,
      round_even(quantile_cont({column}, 0.25), 2) AS q25,
      round_even(quantile_cont({column}, 0.75), 2) AS q75,
      round_even(quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25), 2) AS iqr,
      round_even(min({column})::DOUBLE, 2) AS min, round_even(max({column})::DOUBLE, 2) AS max,
      CASE WHEN min({column}) = max({column}) THEN 0.0::DOUBLE
        ELSE round_even(skewness({column}), 2) END AS skewness FROM {table} {where}"""


def union(parts) -> str:
    return " UNION ALL ".join(parts)


@query("describe_stats", union(_describe("lineitem", c) for c in LINE_COLUMNS))
def _(spark, sf):
    return describe_stats(read_table(spark, sf, "lineitem"), [*LINE_COLUMNS, "l_absent"])


@query(
    "describe_gaps",
    union([
        _describe("(SELECT nullif(l_discount, 0) AS l_discount FROM lineitem)", "l_discount"),
        _describe("(SELECT CASE WHEN l_returnflag = 'R' THEN l_quantity END AS l_quantity "
                  "FROM lineitem)", "l_quantity"),
    ]),
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("l_quantity"),
    )
    return describe_stats(lines, ["l_discount", "l_quantity"])


OBS_METRICS = ["sports_visitor_count", "sports_load_pct", "food_orders_demand",
               "food_surplus_qty", "library_occupancy", "library_load_pct",
               "campus_pulse_index", "temperature", "classes_ending_near"]


@query("describe_observations", with_obs(union(_describe("obs", c) for c in OBS_METRICS)))
def _(spark, sf):
    return describe_stats(_obs(spark, sf))


@query("approximate_quartiles")
def _(spark, sf):
    return approx_quantiles(read_table(spark, sf, "lineitem"), LINE_COLUMNS, [0.25, 0.5, 0.75])


def _trend(table, key, order, metrics, digits=1):
    keys = ", ".join(f"({i}, '{k}')" for i, k in enumerate(order))
    means = ", ".join(
        f"round_even(coalesce(avg({m}), 0), {digits})::DOUBLE AS {m}" for m in metrics
    )
    return f"""SELECT ord, k AS {key}, {means} FROM (VALUES {keys}) d(ord, k)
      LEFT JOIN {table} t ON t.{key} = d.k GROUP BY 1, 2"""


@query("trend_by_slot", with_obs(_trend("obs", "time_slot", P.SLOT_ORDER, P.TREND_METRICS)))
def _(spark, sf):
    return trend_by(_obs(spark, sf), "time_slot", order=P.SLOT_ORDER)


@query("trend_by_day", with_obs(_trend("obs", "day_of_week", P.DAY_ORDER, P.TREND_METRICS)))
def _(spark, sf):
    return trend_by(_obs(spark, sf), "day_of_week", order=P.DAY_ORDER)


@query(
    "trend_by_stage",
    _trend("(SELECT l_extendedprice, l_quantity, CASE l_returnflag WHEN 'R' THEN 'Mid' "
           "WHEN 'A' THEN 'Early' WHEN 'N' THEN 'Other' END AS stage FROM lineitem)",
           "stage", P.STAGE_ORDER, ["l_extendedprice", "l_quantity"]),
)
def _(spark, sf):
    flag = F.col("l_returnflag")
    stage = F.when(flag == "R", "Mid").when(flag == "A", "Early").when(flag == "N", "Other")
    lines = read_table(spark, sf, "lineitem").withColumn("stage", stage)
    return trend_by(lines, "stage", ["l_extendedprice", "l_quantity"], P.STAGE_ORDER)


@query(
    "trend_orders_by_day",
    _trend("(SELECT dayname(o_orderdate) AS day_of_week, o_totalprice, o_custkey FROM orders)",
           "day_of_week", P.DAY_ORDER, ["o_totalprice", "o_custkey"]),
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "EEEE").alias("day_of_week"), "o_totalprice", "o_custkey"
    )
    return trend_by(orders, "day_of_week", ["o_totalprice", "o_custkey"], P.DAY_ORDER)


@query(
    "trend_by_event",
    with_obs(
        """SELECT campus_event_flag, round_even(avg(sports_visitor_count), 1)
        AS sports_visitor_count, round_even(avg(food_orders_demand), 1) AS food_orders_demand,
        round_even(avg(library_occupancy), 1) AS library_occupancy,
        round_even(avg(campus_pulse_index), 1) AS campus_pulse_index,
        CASE campus_event_flag WHEN 0 THEN 'No Event' ELSE 'Campus Event' END AS status
        FROM obs GROUP BY 1"""
    ),
)
def _(spark, sf):
    return trend_by_event(_obs(spark, sf))


@query(
    "hourly_profile",
    """SELECT hour(ts)::INT AS hour, round_even(avg(value), 2) AS value,
      round_even(avg(user_id), 2) AS user_id FROM events GROUP BY 1""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events").withColumn("hour", F.hour("ts"))
    return trend_by(events, "hour", ["value", "user_id"], digits=2)


@query(
    "normalized_profile",
    with_obs(
        """SELECT ord, time_slot, round_even(v / (SELECT any_value(sports_capacity) FROM obs)
          * 100, 1) AS sports_visitor_count, round_even(l / 350::DOUBLE * 100, 1)
          AS library_occupancy FROM (SELECT time_slot, avg(sports_visitor_count) AS v,
          avg(library_occupancy) AS l FROM obs GROUP BY 1) JOIN (VALUES (0, 'Morning'),
          (1, 'Late Morning'), (2, 'Noon / Lunch'), (3, 'Afternoon'), (4, 'Evening Peak'),
          (5, 'Night')) d(ord, k) ON k = time_slot"""
    ),
)
def _(spark, sf):
    obs = _obs(spark, sf)
    capacity = obs.select(F.max("sports_capacity")).scalar()
    return normalized_profile(
        obs, "time_slot", {"sports_visitor_count": capacity, "library_occupancy": 350},
        P.SLOT_ORDER,
    )


def _bounds(table, column, factor=1.5, floor=False, digits=2):
    low = f"q25 - {factor}::DOUBLE * (q75 - q25)"
    low = f"greatest(0.0::DOUBLE, {low})" if floor else low
    high = f"q75 + {factor}::DOUBLE * (q75 - q25)"
    return f"""SELECT '{column}' AS metric, round_even(q25, {digits}) AS q25,
      round_even(q75, {digits}) AS q75, round_even(q75 - q25, {digits}) AS iqr,
      round_even({low}, {digits}) AS lower_bound, round_even({high}, {digits}) AS upper_bound,
      (SELECT count(*) FROM {table} WHERE {column} < {low} OR {column} > {high})
        AS outlier_count
      FROM (SELECT quantile_cont({column}::DOUBLE, 0.25) AS q25,
        quantile_cont({column}::DOUBLE, 0.75) AS q75 FROM {table})"""


@query("iqr_bounds", union(_bounds("lineitem", c, 0.5) for c in LINE_COLUMNS))
def _(spark, sf):
    return iqr_bounds(read_table(spark, sf, "lineitem"), LINE_COLUMNS, factor=0.5)


@query(
    "iqr_bounds_floored",
    with_obs(union(_bounds("obs", c, 1.5, True, 1) for c in
                   ["sports_visitor_count", "food_orders_demand", "library_occupancy",
                    "campus_pulse_index"])),
)
def _(spark, sf):
    columns = ["sports_visitor_count", "food_orders_demand", "library_occupancy",
               "campus_pulse_index"]
    return iqr_bounds(_obs(spark, sf), columns, floor_zero=True, digits=1)


@query(
    "iqr_outliers",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a,
      quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem),
    f AS (SELECT a - 0.45::DOUBLE * (b - a) AS lo, b + 0.45::DOUBLE * (b - a) AS hi FROM q)
    SELECT l_orderkey, l_linenumber, round_even(l_extendedprice, 2) AS value,
      round_even(lo, 2) AS lower_threshold, round_even(hi, 2) AS upper_threshold,
      CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN l_linestatus = 'O' THEN 'Open'
        WHEN l_discount > 0.08 THEN 'Discounted' ELSE 'Plain' END AS event_context,
      'Retained for model training (genuine high-impact operational spike)' AS action_taken
    FROM lineitem, f WHERE l_extendedprice < lo OR l_extendedprice > hi""",
)
def _(spark, sf):
    context = outlier_context(
        [(F.col("l_returnflag") == "R", "Returned"), (F.col("l_linestatus") == "O", "Open"),
         (F.col("l_discount") > 0.08, "Discounted")], "Plain",
    )
    return iqr_outliers(
        read_table(spark, sf, "lineitem"), "l_extendedprice", 0.45, context,
        ["l_orderkey", "l_linenumber"],
    )


@query(
    "iqr_outliers_observations",
    with_obs(
        """, q AS (SELECT quantile_cont(sports_visitor_count::DOUBLE, 0.25) AS a,
          quantile_cont(sports_visitor_count::DOUBLE, 0.75) AS b FROM obs)
        SELECT date, time_slot, sports_visitor_count::DOUBLE AS value,
          round_even(a - 0.5::DOUBLE * (b - a), 2) AS lower_threshold,
          round_even(b + 0.5::DOUBLE * (b - a), 2) AS upper_threshold,
          CASE WHEN is_exam_week = 1 THEN 'Exam Period Shift' WHEN is_peak_hour = 1
            THEN 'Peak Hour Concentration' ELSE 'Unusual Synchronized Class Dismissal' END
            AS event_context,
          'Retained for model training (genuine high-impact operational spike)' AS action_taken
        FROM obs, q WHERE sports_visitor_count < a - 0.5::DOUBLE * (b - a)
          OR sports_visitor_count > b + 0.5::DOUBLE * (b - a)"""
    ),
)
def _(spark, sf):
    return iqr_outliers(
        _obs(spark, sf), "sports_visitor_count", 0.5, keep=["date", "time_slot"]
    )


@query(
    "histogram",
    """WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
      count(l_extendedprice) AS n FROM lineitem),
    w AS (SELECT *, (hi - lo) / 20 AS w FROM m),
    g AS (SELECT l_extendedprice AS v, lo, w, least(floor((l_extendedprice - lo) / (hi - lo)
      * 20), 19)::INT AS b FROM lineitem, w),
    c AS (SELECT CASE WHEN v < b * w + lo THEN b - 1 WHEN v >= (b + 1) * w + lo AND b < 19
      THEN b + 1 ELSE b END AS bin, count(*) AS c FROM g GROUP BY 1)
    SELECT b.bin::INT AS bin, round_even(lo + b.bin * w, 4) AS left_edge,
      round_even(lo + (b.bin + 1) * w, 4) AS right_edge, coalesce(c, 0) AS count,
      round_even(coalesce(c, 0) / (n * w), 12) AS density
    FROM range(20) b(bin) CROSS JOIN w LEFT JOIN c ON c.bin = b.bin""",
)
def _(spark, sf):
    out = histogram(read_table(spark, sf, "lineitem"), "l_extendedprice", 20)
    return out.withColumns(
        {
            "left_edge": F.rint(F.col("left_edge") * 1e4) / 1e4,
            "right_edge": F.rint(F.col("right_edge") * 1e4) / 1e4,
            "density": F.rint(F.col("density") * 1e12) / 1e12,
        }
    )


@query(
    "kde",
    """WITH m AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, count(*) AS n,
      stddev_samp(l_quantity) * count(*) ** (-0.2) AS h FROM lineitem),
    v AS (SELECT l_quantity AS x, count(*) AS c FROM lineitem GROUP BY 1)
    SELECT p::INT AS point, round_even(lo + p * (hi - lo) / 199, 6) AS x,
      round_even(sum(c * exp(-0.5 * ((lo + p * (hi - lo) / 199 - v.x) / h) ** 2))
        / (n * h * sqrt(2 * pi())), 8) AS density
    FROM range(200) g(p), m, v GROUP BY p, lo, hi, n, h""",
)
def _(spark, sf):
    out = kde(read_table(spark, sf, "lineitem"), "l_quantity")
    return out.withColumns(
        {"x": F.rint(F.col("x") * 1e6) / 1e6, "density": F.rint(F.col("density") * 1e8) / 1e8}
    )


def _box(table, column, factor):
    return f"""SELECT '{column}' AS metric, round_even(q25, 2) AS q25, round_even(q50, 2)
      AS median, round_even(q75, 2) AS q75,
      round_even(min(CASE WHEN {column} >= lo THEN {column} END), 2) AS whisker_low,
      round_even(max(CASE WHEN {column} <= hi THEN {column} END), 2) AS whisker_high,
      count(*) FILTER ({column} < lo OR {column} > hi) AS fliers
      FROM {table}, (SELECT *, q25 - {factor}::DOUBLE * (q75 - q25) AS lo,
        q75 + {factor}::DOUBLE * (q75 - q25) AS hi FROM (SELECT
        quantile_cont({column}, 0.25) AS q25, quantile_cont({column}, 0.5) AS q50,
        quantile_cont({column}, 0.75) AS q75 FROM {table})) GROUP BY q25, q50, q75"""


@query("box_stats", union(_box("lineitem", c, 0.3) for c in LINE_COLUMNS))
def _(spark, sf):
    return box_stats(read_table(spark, sf, "lineitem"), LINE_COLUMNS, 0.3)


@query(
    "rate_and_mean",
    with_obs(
        """SELECT count(*) AS total_records, round_even(avg(sports_overcrowded_flag) * 100, 1)
        AS rate_pct, round_even(avg(campus_pulse_index), 2) AS mean_value,
        CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) AS train_records,
        count(*) - CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) AS test_records FROM obs"""
    ),
)
def _(spark, sf):
    split = chrono_split(_obs(spark, sf), ["day", "starting_hour"])
    return rate_and_mean(split, split="split")


@query(
    "mode_per_group",
    """SELECT l_suppkey, l_linenumber AS mode FROM (SELECT l_suppkey, l_linenumber,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_linenumber) AS r
      FROM lineitem GROUP BY 1, 2) WHERE r = 1""",
)
def _(spark, sf):
    return mode_per_group(read_table(spark, sf, "lineitem"), ["l_suppkey"], "l_linenumber")


PERSONA = """CASE WHEN x > 0.6 THEN 'exam' WHEN s > 75 THEN 'sports' WHEN f > 180 OR e > 0.4
  THEN 'event' ELSE 'calm' END"""


def _persona(part):
    cases = " ".join(f"WHEN '{k}' THEN '{v[part]}'" for k, v in P.PERSONAS.items())
    return f"CASE {PERSONA} {cases} END"


@query(
    "group_profile",
    f"""WITH t AS (SELECT l_suppkey % 12 AS cluster, l_quantity * 1.6 + l_suppkey % 12 * 4 AS s,
      l_extendedprice / 300 AS f, l_discount * 1000 AS l, l_tax * 1000 AS i,
      CASE WHEN l_suppkey % 12 = 1 OR l_linestatus = 'O' AND l_returnflag <> 'N' THEN 1 ELSE 0 END
        AS x,
      CASE WHEN l_suppkey % 12 = 2 THEN 1 ELSE 0 END AS e,
      {P.SLOT_ORDER}[1 + l_linenumber % 6] AS slot FROM lineitem),
    n AS (SELECT cluster, slot, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC,
      slot) AS r FROM t GROUP BY 1, 2),
    g AS (SELECT cluster, count(*) AS n, avg(s) AS s, avg(f) AS f, avg(l) AS l, avg(i) AS i,
      avg(x) AS x, avg(e) AS e FROM t GROUP BY 1)
    SELECT cluster, {_persona(0)} AS label, {_persona(1)} AS description,
      {_persona(2)} AS recommended_action, n AS sample_count,
      round_even(n / (SELECT count(*) FROM t)::DOUBLE * 100, 1) AS percentage_of_data,
      round_even(s, 1) AS avg_sports_load_pct, round_even(f, 1) AS avg_food_orders,
      round_even(l, 1) AS avg_library_load_pct, round_even(i, 1) AS avg_campus_pulse_index,
      slot AS predominant_time_slot FROM g JOIN n USING (cluster) WHERE r = 1""",
)
def _(spark, sf):
    group = F.col("l_suppkey") % 12
    late = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") != "N")
    slots = F.array(*[F.lit(s) for s in P.SLOT_ORDER])
    rows = read_table(spark, sf, "lineitem").select(
        group.alias("cluster"),
        (F.col("l_quantity") * 1.6 + group * 4).alias("sports_load_pct"),
        (F.col("l_extendedprice") / 300).alias("food_orders_demand"),
        (F.col("l_discount") * 1000).alias("library_load_pct"),
        (F.col("l_tax") * 1000).alias("campus_pulse_index"),
        ((group == 1) | late).cast("int").alias("is_exam_week"),
        (group == 2).cast("int").alias("campus_event_flag"),
        F.get(slots, F.col("l_linenumber") % 6).alias("time_slot"),
    )
    return group_profile(rows)


@query(
    "group_shift",
    with_obs(
        " SELECT " + ", ".join(
            f"round_even(avg({c}) FILTER (is_exam_week = 1) - avg({c}) FILTER "
            f"(is_exam_week = 0), 1) AS {n}" for n, c in P.SHIFT_METRICS.items()
        ) + " FROM obs"
    ),
)
def _(spark, sf):
    return group_shift(_obs(spark, sf))


@query(
    "group_shift_lines",
    """SELECT round_even(avg(l_extendedprice) FILTER (l_linestatus = 'F')
      - avg(l_extendedprice) FILTER (l_linestatus <> 'F'), 1) AS price_shift FROM lineitem""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem").withColumn(
        "closed", (F.col("l_linestatus") == "F").cast("int")
    )
    return group_shift(lines, "closed", {"price_shift": "l_extendedprice"})


@query(
    "daily_quantiles",
    """WITH m AS (SELECT 'value' AS metric, value AS x, CAST(ts AS DATE) AS d FROM events
      UNION ALL SELECT 'user_id', user_id::DOUBLE, CAST(ts AS DATE) FROM events),
    q AS (SELECT span, metric, quantile_cont(x, [0.0, 0.25, 0.5, 0.9, 1.0]) AS v FROM (
      SELECT 'all' AS span, * FROM m UNION ALL SELECT 'second half', * FROM m WHERE day(d) >= 16)
      GROUP BY 1, 2)
    SELECT span, metric, unnest([0.0::DOUBLE, 0.25, 0.5, 0.9, 1.0]) AS prob,
      round_even(unnest(v), 6) AS value FROM q""",
)
def _(spark, sf):
    # a sketch per day, added day by day in two lots, the second lot twice
    events = read_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    store = DaySketches(spark, scratch_path(spark, "sketches"), ["value", "user_id"])
    early, late = (events.filter(c) for c in (F.dayofmonth("day") < 16, F.dayofmonth("day") >= 16))
    for lot in (early, late, late):
        store.add(lot, "day")
    first = events.filter(F.dayofmonth("day") >= 16).agg(F.min("day").cast("string")).first()[0]
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    out = store.exact(events, probs).withColumn("span", F.lit("all"))
    half = store.exact(late, probs, first).withColumn("span", F.lit("second half"))
    return out.unionByName(half).select(
        "span", "metric", "prob", half_even("value", 6).alias("value")
    )
