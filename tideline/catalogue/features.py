"""Calendar, text and category features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import presets as P
from tideline.catalogue.registry import SLOT_BY_HOUR, query
from tideline.functions.banding import slot_of_hour
from tideline.functions.calendar import (
    academic_calendar, calendar_columns, cyclic, peak_flag, semester_week,
)
from tideline.functions.numbers import half_even
from tideline.functions.text import (
    event_columns, matches, parse_hour, supply_text, workload_code, workload_level,
)
from tideline.plans.observations import read_table


@query(
    "calendar_features",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, dayname(o_orderdate)
      AS day_of_week, (isodow(o_orderdate) - 1)::INT AS day_of_week_num,
      CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend,
      month(o_orderdate)::INT AS month FROM orders""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select(
        "o_orderkey", *[c.alias(n) for n, c in calendar_columns("o_orderdate").items()]
    )


@query(
    "parse_hour",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 14 ELSE hour(ts)::INT END AS hour,
      CASE WHEN event_type = 'error' THEN 12 ELSE hour(ts)::INT END AS explored_hour FROM events""",
)
def _(spark, sf):
    text = F.when(F.col("event_type") != "error", F.date_format("ts", "H:mm-HH:59"))
    return read_table(spark, sf, "events").select(
        "event_id", parse_hour(text).alias("hour"), parse_hour(text, 12).alias("explored_hour")
    )


@query(
    "slot_of_hour",
    f"SELECT event_id, {SLOT_BY_HOUR.format(h='hour(ts)')} AS time_slot FROM events",
)
def _(spark, sf):
    events = read_table(spark, sf, "events")
    return events.select("event_id", slot_of_hour(F.hour("ts")).alias("time_slot"))


@query(
    "peak_flag",
    """SELECT event_id,
      CASE WHEN hour(ts) BETWEEN 12 AND 14 OR hour(ts) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS ingest,
      CASE WHEN hour(ts) IN (12, 13, 17, 18, 19) THEN 1 ELSE 0 END AS exploration,
      CASE WHEN hour(ts) IN (17, 18, 19) OR (isodow(ts) >= 6 AND hour(ts) IN (10, 16, 17))
        THEN 1 ELSE 0 END AS recommend FROM events""",
)
def _(spark, sf):
    hour, weekend = F.hour("ts"), (F.weekday("ts") >= 5).cast("int")
    return read_table(spark, sf, "events").select(
        "event_id", *[peak_flag(hour, p, weekend).alias(p) for p in P.PEAK_HOURS]
    )


@query(
    "semester_week",
    """SELECT event_id, least(16, greatest(1, (CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE))
      FROM events)) // 7 + 1))::INT AS semester_week FROM events""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events")
    first = events.select(F.min(F.to_date("ts"))).scalar()
    return events.select("event_id", semester_week("ts", first).alias("semester_week"))


@query(
    "stage_flags",
    """SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'mid-term|midterm|exam|finals')
        THEN 1 ELSE 0 END AS exam,
      CASE WHEN regexp_matches(text, '(?i)mid') THEN 1 ELSE 0 END AS midterm,
      CASE WHEN regexp_matches(text, '(?i)exam|final') THEN 1 ELSE 0 END AS exam_explored
    FROM documents""",
)
def _(spark, sf):
    return read_table(spark, sf, "documents").select(
        "doc_id", matches("text", P.STAGE_PATTERN).alias("exam"),
        matches("text", "mid").alias("midterm"),
        matches("text", "exam|final").alias("exam_explored"),
    )


@query(
    "workload_level",
    """SELECT o_orderkey, CASE WHEN o_custkey % 9 <= 2 THEN 'Low' WHEN o_custkey % 9 <= 4
        THEN 'Medium' WHEN o_custkey % 9 = 5 THEN 'High' WHEN o_custkey % 9 = 6 THEN 'Low'
        WHEN o_custkey % 9 = 7 THEN 'Medium' ELSE 'High' END AS level,
      CASE o_custkey % 7 WHEN 1 THEN 'Low' WHEN 2 THEN 'Low' WHEN 5 THEN 'High' ELSE 'Medium'
        END AS code_level FROM orders""",
)
def _(spark, sf):
    code = F.col("o_custkey") % 9
    text = (
        F.when(code <= 5, code.cast("string")).when(code == 6, " lOW").when(code == 7, "busy")
    )
    return read_table(spark, sf, "orders").select(
        "o_orderkey", workload_level(text).alias("level"),
        workload_code(F.col("o_custkey") % 7).alias("code_level"),
    )


@query(
    "event_flags",
    """WITH t AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Sports Day'
      WHEN 1 THEN 'Autumn FEST' WHEN 2 THEN 'Chess match and festival' WHEN 3 THEN 'Lecture' END
      AS e FROM part),
    f AS (SELECT *, CASE WHEN regexp_matches(lower(e), 'sport|tournament|match') THEN 1 ELSE 0 END
      AS s, CASE WHEN regexp_matches(lower(e), 'fest|cultural') THEN 1 ELSE 0 END AS c FROM t)
    SELECT p_partkey, coalesce(e, 'None') AS event_type, s AS sports_event_flag,
      s AS tournament_flag, c AS cultural_major_event_flag, greatest(s, c) AS campus_event_flag,
      80 * greatest(s, c) AS expected_event_attendance FROM f""",
)
def _(spark, sf):
    kind = F.col("p_partkey") % 5
    name = (
        F.when(kind == 0, "Sports Day").when(kind == 1, "Autumn FEST")
        .when(kind == 2, "Chess match and festival").when(kind == 3, "Lecture")
    )
    return read_table(spark, sf, "part").select(
        "p_partkey", *[c.alias(n) for n, c in event_columns(name).items()]
    )


@query(
    "cyclic_encode",
    """SELECT event_id, round_even(sin(2 * pi() * hour(ts) / 24.0), 6) AS hour_sin,
      round_even(cos(2 * pi() * hour(ts) / 24.0), 6) AS hour_cos,
      round_even(sin(2 * pi() * (isodow(ts) - 1) / 7.0), 6) AS dow_sin,
      round_even(cos(2 * pi() * (isodow(ts) - 1) / 7.0), 6) AS dow_cos FROM events""",
)
def _(spark, sf):
    hour, day = cyclic(F.hour("ts"), 24), cyclic(F.weekday("ts"), 7)
    names = ["hour_sin", "hour_cos", "dow_sin", "dow_cos"]
    return read_table(spark, sf, "events").select(
        "event_id", *[half_even(c, 6).alias(n) for n, c in zip(names, [*hour, *day])]
    )


@query(
    "academic_calendar",
    """WITH w AS (SELECT o_orderkey, o_orderkey % 16 + 1 AS w, isodow(o_orderdate) - 1 AS d
      FROM orders)
    SELECT o_orderkey, CASE WHEN w <= 4 THEN 'Early' WHEN w <= 8 THEN 'Mid' WHEN w <= 14
        THEN 'Late' ELSE 'Finals' END AS semester_stage,
      CASE WHEN w <= 4 THEN 'Low' WHEN w < 8 THEN 'Medium' WHEN w = 8 THEN 'High' WHEN w <= 12
        THEN 'Medium' ELSE 'High' END AS academic_workload,
      CASE WHEN w = 8 OR w >= 15 THEN 1 ELSE 0 END AS is_exam_week,
      CASE WHEN w = 8 THEN 1 ELSE 0 END AS is_midterm,
      CASE WHEN (w BETWEEN 4 AND 14 AND d IN (3, 4)) OR (w BETWEEN 9 AND 14 AND d = 2) THEN 1
        ELSE 0 END AS is_assignment_deadline FROM w""",
)
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 16 + 1).alias("w"),
        F.weekday("o_orderdate").alias("d"),
    )
    return orders.select(
        "o_orderkey", *[c.alias(n) for n, c in academic_calendar("w", "d").items()]
    )


@query(
    "recode_risk",
    """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'Balanced' WHEN 1 THEN 'Shortage Risk'
      WHEN 2 THEN 'Surplus Risk' WHEN 3 THEN 'Shortage Risk' WHEN 4 THEN 'Balanced'
      WHEN 5 THEN 'Surplus Risk' WHEN 6 THEN 'Unclear' ELSE 'Balanced' END AS risk FROM part""",
)
def _(spark, sf):
    texts = ["0", "1.0", " surplus ", "TRUE", "No Risk", "2", "Unclear"]
    code = (F.col("p_partkey") % 8).cast("int")
    text = F.get(F.array(*[F.lit(t) for t in texts]), code)
    return read_table(spark, sf, "part").select("p_partkey", supply_text(text).alias("risk"))
