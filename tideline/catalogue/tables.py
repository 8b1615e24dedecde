"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.catalogue.registry import SEATS, SLOT_BY_HOUR, PULSE, RISK, POINTS, query, with_obs
from tideline.operators.distribution import describe_stats
from tideline.operators.flow import chrono_split
from tideline.plans.ingest import ingest
from tideline.plans.observations import observation_table, raw_uploads, read_table
from tideline.session import scratch_path
from tideline.sources.rejects import PLACE, read_checked
from tideline.sources.reports import sanitize, summary_json
from tideline.sources.tables import (
    append_rows, append_table, assign_record_id, read_observations, replace_table, write_split,
    write_table,
)
from tideline.sources.versions import VersionedTable


@query(
    "read_parquet",
    """SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS date
    FROM orders WHERE o_totalprice >= 100000""",
)
def _(spark, sf):
    orders = read_observations(spark, f"{sf}/orders.parquet", schema=None)
    return orders.where(F.col("o_totalprice") >= 100000).select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )


@query(
    "read_csv",
    with_obs(
        """SELECT date, time_slot, starting_hour, sports_visitor_count, sports_load_pct,
        campus_pulse_index, campus_activity_status FROM obs"""
    ),
)
def _(spark, sf):
    obs = observation_table(spark, sf)
    columns = [
        "date", "time_slot", "starting_hour", "sports_visitor_count", "sports_load_pct",
        "campus_pulse_index", "campus_activity_status",
    ]
    schema = obs.select(*columns).schema
    path = write_table(obs.select(*columns), scratch_path(spark, "csv"), form="csv")
    return read_observations(spark, path, schema, "csv")


@query(
    "read_rejects",
    """WITH o AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN 'price on request'
      WHEN o_orderkey % 11 = 0 THEN '' ELSE 'ok' END AS price, o_orderkey % 13 = 0 AS late,
      strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
    SELECT o_orderkey, CASE WHEN price = 'ok' THEN o_totalprice END AS o_totalprice,
      CASE WHEN NOT late THEN day END AS day,
      CASE WHEN price = 'price on request' THEN price END AS bad_price,
      CASE WHEN late THEN 'after ' || day END AS bad_day FROM o""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.when(key % 7 == 0, "price on request").when(key % 11 == 0, "").otherwise(
        F.col("o_totalprice").cast("string")
    )
    told = F.when(key % 13 == 0, F.concat(F.lit("after "), day)).otherwise(day)
    uploads = orders.select(key, price.alias("o_totalprice"), told.alias("day"))
    folder = scratch_path(spark, "uploads")
    # two kinds of files under one path, with other columns in another order
    write_table(uploads.where(key % 2 == 0), f"{folder}/kind=0", form="csv")
    write_table(
        uploads.where(key % 2 == 1).select("day", F.lit("x").alias("other"), "o_totalprice", key),
        f"{folder}/kind=1", form="csv",
    )
    rows, rejects = read_checked(
        spark, f"{folder}/kind=*", "o_orderkey long, o_totalprice double, day date"
    )
    bad = rejects.groupBy(*PLACE).agg(
        F.max(F.when(F.col("column") == "o_totalprice", F.col("text"))).alias("bad_price"),
        F.max(F.when(F.col("column") == "day", F.col("text"))).alias("bad_day"),
    )
    return rows.join(bad, list(PLACE), "left").select(
        "o_orderkey", "o_totalprice", F.date_format("day", "yyyy-MM-dd").alias("day"),
        "bad_price", "bad_day",
    )


ORDER_SPLIT = """
  SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn,
    floor(count(*) OVER () * (1 - 0.2::DOUBLE)) AS cut FROM orders"""


@query(
    "write_split",
    f"""SELECT CASE WHEN rn <= cut THEN 'train' ELSE 'test' END AS split,
      strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
    FROM ({ORDER_SPLIT}) GROUP BY 1, 2""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders")
    path = write_split(
        chrono_split(orders, ["o_orderdate", "o_orderkey"]), scratch_path(spark, "split")
    )
    back = spark.read.parquet(path)
    return back.groupBy("split", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")
    )


INGEST = f"""
WITH cell AS (
  SELECT user_id AS site, CAST(ts AS DATE) AS day, hour(ts)::INT AS hour,
    CAST(count(*) FILTER (event_type = 'view') AS INT) AS v,
    CAST(count(*) FILTER (event_type = 'purchase') AS INT) AS p,
    CAST(count(*) FILTER (event_type = 'click') AS INT) AS c,
    CAST(count(*) FILTER (event_type = 'signup') AS INT) AS s,
    CAST(count(*) FILTER (event_type = 'error') AS INT) AS e
  FROM events GROUP BY 1, 2, 3),
a AS (
  SELECT CAST(site AS VARCHAR) AS site_no, day, hour AS starting_hour,
    CASE WHEN day(day) BETWEEN 15 AND 21 THEN 'Mid' WHEN day(day) > 28 THEN 'Finals'
      ELSE 'Mid' END AS semester_stage,
    CASE WHEN day(day) BETWEEN 15 AND 21 OR day(day) > 28 THEN 1 ELSE 0 END AS is_exam_week,
    CASE WHEN e > 0 THEN 'Medium' WHEN site % 6 <= 2 THEN 'Low' WHEN site % 6 <= 4
      THEN 'Medium' ELSE 'High' END AS academic_workload,
    CASE WHEN site % 50 = 7 THEN 'Inter-college Match' WHEN site % 50 = 9 THEN 'Cultural Fest'
      ELSE 'None' END AS event_type,
    CASE WHEN site % 50 = 7 THEN 1 ELSE 0 END AS sports_event_flag,
    CASE WHEN site % 50 IN (7, 9) THEN 1 ELSE 0 END AS campus_event_flag,
    CASE WHEN c > 0 THEN v * 60 ELSE 85 END AS sports_visitor_count,
    p * 150 AS food_orders_demand, c * 120 + 40 AS library_occupancy,
    s AS classes_ending_near,
    CASE WHEN p > 0 THEN 'Shortage Risk' ELSE 'Balanced' END AS food_risk_category
  FROM cell),
b AS (
  SELECT *, strftime(day, '%Y-%m-%d') AS date, dayname(day) AS day_of_week,
    (isodow(day) - 1)::INT AS day_of_week_num, month(day)::INT AS month,
    least(16, greatest(1, (day - min(day) OVER ()) // 7 + 1))::INT AS semester_week,
    {SLOT_BY_HOUR.format(h='starting_hour')} AS time_slot,
    CASE WHEN starting_hour BETWEEN 12 AND 14 OR starting_hour BETWEEN 17 AND 20 THEN 1
      ELSE 0 END AS is_peak_hour,
    row_number() OVER o AS rn,
    coalesce(lag(sports_visitor_count) OVER o, sports_visitor_count) AS sports_prev_crowd,
    coalesce(lag(food_orders_demand) OVER o, food_orders_demand) AS food_prev_orders,
    coalesce(lag(library_occupancy) OVER o, library_occupancy) AS library_prev_occupancy,
    round_even(avg(sports_visitor_count) OVER (), 1) AS sports_hist_avg_crowd,
    max(sports_visitor_count) OVER () AS sports_hist_peak_crowd,
    round_even(sports_visitor_count::DOUBLE / 200 * 100, 1) AS sports_load_pct,
    round_even(library_occupancy::DOUBLE / 350 * 100, 1) AS library_load_pct,
    round_even(food_orders_demand * CASE WHEN food_risk_category = 'Shortage Risk'
      THEN 0.85::DOUBLE ELSE 1.05::DOUBLE END, 0)::INT AS food_prepared_qty
  FROM a WINDOW o AS (ORDER BY day, starting_hour, site_no)),
c AS (
  SELECT *, round_even(greatest(0, food_prepared_qty - food_orders_demand)::DOUBLE
      / greatest(1, food_prepared_qty) * 100, 1) AS food_surplus_pct,
    greatest(0, food_orders_demand - food_prepared_qty) AS food_shortage_qty,
    round_even(0.35::DOUBLE * sports_load_pct + 0.30::DOUBLE * library_load_pct
      + 0.25::DOUBLE * least(100.0::DOUBLE, greatest(0.0::DOUBLE,
          food_orders_demand::DOUBLE / 300 * 100))
      + 0.10::DOUBLE * {POINTS.format(c='academic_workload')}, 2) AS campus_pulse_index
  FROM b)
SELECT printf('EXP-%04d', rn) AS record_id, site_no, date, day_of_week, day_of_week_num, month,
  semester_week, semester_stage, time_slot, starting_hour, is_peak_hour, classes_ending_near,
  academic_workload, is_exam_week, event_type, sports_event_flag, campus_event_flag,
  sports_visitor_count, sports_prev_crowd, sports_hist_avg_crowd, sports_hist_peak_crowd,
  sports_load_pct, {RISK.format(c='sports_load_pct')} AS sports_risk_level,
  food_orders_demand, food_prev_orders, food_prepared_qty, food_surplus_pct, food_shortage_qty,
  food_risk_category, library_occupancy, library_prev_occupancy, library_load_pct,
  {SEATS.format(c='library_load_pct')} AS study_space_availability, campus_pulse_index,
  {PULSE.format(c='campus_pulse_index')} AS campus_activity_status,
  'USER_UPLOADED_OBSERVATION' AS data_source_label
FROM c"""
INGEST_COLUMNS = [
    "record_id", "site_no", "date", "day_of_week", "day_of_week_num", "month", "semester_week",
    "semester_stage", "time_slot", "starting_hour", "is_peak_hour", "classes_ending_near",
    "academic_workload", "is_exam_week", "event_type", "sports_event_flag",
    "campus_event_flag", "sports_visitor_count", "sports_prev_crowd", "sports_hist_avg_crowd",
    "sports_hist_peak_crowd", "sports_load_pct", "sports_risk_level", "food_orders_demand",
    "food_prev_orders", "food_prepared_qty", "food_surplus_pct", "food_shortage_qty",
    "food_risk_category", "library_occupancy", "library_prev_occupancy", "library_load_pct",
    "study_space_availability", "campus_pulse_index", "campus_activity_status",
    "data_source_label",
]


@query("ingest_file", INGEST)
def _(spark, sf):
    raw = raw_uploads(read_table(spark, sf, "events"))
    done = ingest(raw, ["date", "starting_hour", "site_no"], keep=["site_no"])
    return done.select(*INGEST_COLUMNS)


@query(
    "append_table",
    """SELECT printf('CIQ-%04d', row_number() OVER (ORDER BY part, o_orderdate, o_orderkey))
      AS record_id, o_orderkey, part = 1 AS is_new FROM (
      SELECT o_orderdate, o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS part
      FROM orders)""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_orderstatus")
    new = F.col("o_orderstatus") == "O"
    both = append_table(
        orders.where(~new), orders.where(new), ["o_orderdate", "o_orderkey"]
    )
    return both.select("record_id", "o_orderkey", new.alias("is_new"))


@query(
    "replace_table",
    """SELECT printf('CIQ-%04d', row_number() OVER (ORDER BY p_retailprice, p_partkey))
      AS record_id, p_partkey FROM part""",
)
def _(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return replace_table(part, ["p_retailprice", "p_partkey"]).select("record_id", "p_partkey")


@query(
    "assign_record_id",
    """SELECT printf('EXP-%04d', row_number() OVER (ORDER BY l_shipdate, l_orderkey,
        l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS record_id,
      l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem""",
)
def _(spark, sf):
    order = [
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    ]
    lines = read_table(spark, sf, "lineitem").select(*order)
    return assign_record_id(lines, order, "EXP").select(
        "record_id", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )


@query(
    "append_rows",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
      printf('CIQ-%04d', row_number() OVER (ORDER BY c_custkey)) AS record_id,
      'TABLE' AS data_source_label FROM customer
    UNION ALL
    SELECT s_name, s_acctbal, NULL, printf('CIQ-%04d', (SELECT count(*) FROM customer)
      + row_number() OVER (ORDER BY s_name)), 'USER_SUBMITTED_CAMPUS_OBSERVATION' FROM supplier""",
)
def _(spark, sf):
    customers = read_table(spark, sf, "customer")
    table = assign_record_id(customers, ["c_custkey"]).select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), "record_id",
        F.lit("TABLE").alias("data_source_label"),
    )
    loose = read_table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return append_rows(table, loose, ["name"])


@query(
    "append_versions",
    """WITH p AS (SELECT event_id, event_type, event_id % 4 AS part,
        row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS n,
        count(*) OVER (PARTITION BY event_id % 4) AS size FROM events),
    s AS (SELECT max(CASE WHEN part = 0 THEN size END) AS a, max(CASE WHEN part = 1 THEN size END)
        AS b, max(CASE WHEN part = 2 THEN size END) AS c FROM p),
    r AS (SELECT *, printf('CIQ-%04d', n + CASE part WHEN 0 THEN 0 WHEN 1 THEN a WHEN 2 THEN a + b
        ELSE a + b + c END) AS record_id FROM p, s)
    SELECT 'first' AS version, record_id, event_id, event_type FROM r WHERE part = 0
    UNION ALL SELECT 'before the first writer', record_id, event_id, event_type FROM r
      WHERE part IN (0, 2)
    UNION ALL SELECT 'last', record_id, event_id,
      CASE WHEN part = 3 THEN NULL ELSE event_type END FROM r""",
)
def _(spark, sf):
    # two writers at a time: the one that began first publishes last
    events = read_table(spark, sf, "events").select("event_id", "event_type")
    part = lambda i: events.filter(F.col("event_id") % 4 == i)
    table = VersionedTable(spark, scratch_path(spark, "versions"))
    first = table.replace(part(0), ["event_id"]).version
    slow = table.begin(part(1), ["event_id"])
    between = table.append(part(2), ["event_id"]).version
    slow.publish()
    table.append(part(3).select("event_id"), ["event_id"])  # a column less
    shown = {"first": first, "before the first writer": between, "last": None}
    out = [
        table.read(v).select(F.lit(name).alias("version"), "record_id", "event_id",
                             "event_type") for name, v in shown.items()
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "sanitize_numbers",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'signup', 'view') THEN 0.0::DOUBLE
      ELSE value END AS value FROM events""",
)
def _(spark, sf):
    kind, value = F.col("event_type"), F.col("value")
    broken = (
        F.when(kind == "error", F.lit(float("nan")))
        .when(kind == "signup", F.lit(float("inf")))
        .when(kind == "view", F.lit(None))
        .otherwise(value)
    )
    events = read_table(spark, sf, "events")
    return sanitize(events.select("event_id", broken.alias("value")))


@query(
    "summary_json",
    """SELECT 'l_quantity' AS metric, count(*) AS count,
      round_even(avg(l_quantity), 2) AS mean, round_even(median(l_quantity), 2) AS median
    FROM lineitem UNION ALL
    SELECT 'l_extendedprice', count(*), round_even(avg(l_extendedprice), 2),
      round_even(median(l_extendedprice), 2) FROM lineitem""",
)
def _(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    stats = describe_stats(lines, ["l_quantity", "l_extendedprice"])
    flags = lines.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    path = summary_json(
        {"descriptive": stats, "flags": flags}, scratch_path(spark, "summary")
    )
    rows = spark.read.schema("metric string, count long, mean double, median double").json(
        f"{path}/section=descriptive"
    )
    return rows.select("metric", "count", "mean", "median")
