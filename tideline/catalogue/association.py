"""Correlations and two-sample tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline import presets as P
from tideline.catalogue.registry import query, with_obs
from tideline.operators.association import corr_matrix
from tideline.operators.hypothesis import (
    TwoSample, binary_split, cohens_d, mann_whitney_u, two_sample_report, welch_t,
)
from tideline.plans.observations import observation_table, read_table

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs(table, columns, where="true", digits=3):
    parts = []
    for a in columns:
        for b in columns:
            r = "1.0::DOUBLE" if a == b else f"round_even(corr({a}, {b}), {digits})"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {r} AS r FROM {table} WHERE {where}"
                         + (" LIMIT 1" if a == b else ""))
    return " UNION ALL ".join(f"({p})" for p in parts)


@query("corr_pearson", _pairs("lineitem", LINE_COLUMNS))
def _(spark, sf):
    return corr_matrix(read_table(spark, sf, "lineitem"), LINE_COLUMNS)


GAPS = """g AS (SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount,
  CASE WHEN l_partkey % 3 > 0 THEN l_tax END AS l_tax FROM lineitem)"""


def _gaps(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_partkey") % 3 > 0, F.col("l_tax")).alias("l_tax"),
    )


@query(
    "corr_listwise",
    f"WITH {GAPS} " + _pairs("g", LINE_COLUMNS, "l_discount IS NOT NULL AND l_tax IS NOT NULL"),
)
def _(spark, sf):
    return corr_matrix(_gaps(spark, sf), LINE_COLUMNS)


@query("corr_pairwise", f"WITH {GAPS} " + _pairs("g", LINE_COLUMNS))
def _(spark, sf):
    return corr_matrix(_gaps(spark, sf), LINE_COLUMNS, deletion="pairwise")


def _ranks(table, columns):
    cells = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}"
        for c in columns
    )
    return f"r AS (SELECT {cells} FROM {table})"


@query(
    "corr_spearman", f"WITH {_ranks('lineitem', LINE_COLUMNS)} " + _pairs("r", LINE_COLUMNS)
)
def _(spark, sf):
    return corr_matrix(read_table(spark, sf, "lineitem"), LINE_COLUMNS, "spearman")


FLOW = P.FLOW_COLUMNS


@query("corr_observations", with_obs(_pairs("obs", FLOW)))
def _(spark, sf):
    return corr_matrix(observation_table(spark, sf), FLOW, deletion="pairwise")


@query("corr_spearman_observations", with_obs(f", {_ranks('obs', FLOW)} " + _pairs("r", FLOW)))
def _(spark, sf):
    return corr_matrix(observation_table(spark, sf), FLOW, "spearman")


@query(
    "corr_constant",
    """WITH s AS (SELECT 'value' AS name, value AS x, event_id FROM events
      UNION ALL SELECT 'flat', 0.1::DOUBLE, event_id FROM events)
    SELECT p.name AS a, q.name AS b, CASE WHEN min(p.x) = max(p.x) OR min(q.x) = max(q.x)
      THEN 0.0::DOUBLE ELSE round_even(corr(p.x, q.x), 4) END AS r
    FROM s p JOIN s q USING (event_id) GROUP BY 1, 2""",
)
def _(spark, sf):
    events = read_table(spark, sf, "events").select("value", F.lit(0.1).alias("flat"))
    return corr_matrix(events, ["value", "flat"], undefined=0.0)


LINE_TESTS = [
    ("status_price", "l_extendedprice", "l_linestatus = 'F'", "l_linestatus = 'O'"),
    ("flag_quantity", "l_quantity", "l_returnflag = 'R'", "l_returnflag <> 'R'"),
    ("early_discount", "l_discount", "l_linenumber <= 2", "l_linenumber > 4"),
]


def _line_tests():
    status, flag, number = F.col("l_linestatus"), F.col("l_returnflag"), F.col("l_linenumber")
    return [
        TwoSample("status_price", "l_extendedprice", status == "F", status == "O"),
        TwoSample("flag_quantity", "l_quantity", flag == "R", flag != "R"),
        TwoSample("early_discount", "l_discount", number <= 2, number > 4),
    ]


def _samples(tests, table="lineitem"):
    return " UNION ALL ".join(
        f"SELECT '{n}' AS test, ({a}) AS in_a, {m}::DOUBLE AS v FROM {table} WHERE ({a}) OR ({b})"
        for n, m, a, b in tests
    )


def _moments(tests, table="lineitem"):
    return f"""s AS ({_samples(tests, table)}),
    m AS (SELECT test, count(*) FILTER (in_a) AS n_a, avg(v) FILTER (in_a) AS m_a,
        var_samp(v) FILTER (in_a) AS v_a, count(*) FILTER (NOT in_a) AS n_b,
        avg(v) FILTER (NOT in_a) AS m_b, var_samp(v) FILTER (NOT in_a) AS v_b FROM s GROUP BY 1),
    t AS (SELECT *, (m_a - m_b) / sqrt(v_a / n_a + v_b / n_b) AS t,
        (v_a / n_a + v_b / n_b) ** 2 / ((v_a / n_a) ** 2 / (n_a - 1)
          + (v_b / n_b) ** 2 / (n_b - 1)) AS df,
        (m_a - m_b) / sqrt(((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2)) AS d FROM m)"""


U_TEXT = """
    c AS (SELECT test, v, count(*) AS c, count(*) FILTER (in_a) AS ca FROM s GROUP BY 1, 2),
    r AS (SELECT *, sum(c) OVER (PARTITION BY test ORDER BY v) - c + (c + 1) / 2 AS rank FROM c),
    k AS (SELECT test, sum(ca)::DOUBLE AS a, sum(c)::DOUBLE AS n, sum(ca * rank)::DOUBLE AS w,
      sum(c::DOUBLE ** 3 - c) AS ties FROM r GROUP BY 1),
    u AS (SELECT test, a, n - a AS b, n, ties, w - a * (a + 1) / 2 AS u FROM k)"""


@query(
    "welch_t",
    f"""WITH {_moments(LINE_TESTS)} SELECT test, n_a, n_b, round_even(t, 4) AS t_statistic,
      round_even(df, 2) AS df FROM t""",
)
def _(spark, sf):
    out = welch_t(read_table(spark, sf, "lineitem"), _line_tests(), digits=4)
    return out.drop("p_value_ttest").withColumn("df", F.rint(F.col("df") * 100) / 100)


@query(
    "mann_whitney_u",
    f"""WITH s AS ({_samples(LINE_TESTS)}), {U_TEXT}
    SELECT test, a::BIGINT AS n_a, b::BIGINT AS n_b, round_even(u, 2) AS mann_whitney_u,
      round_even((greatest(u, a * b - u) - a * b / 2 - 0.5)
        / sqrt(a * b / 12 * ((n + 1) - ties / (n * (n - 1)))), 4) AS z FROM u""",
)
def _(spark, sf):
    return mann_whitney_u(read_table(spark, sf, "lineitem"), _line_tests()).drop("p_value_mwu")


@query(
    "cohens_d",
    f"""WITH {_moments(LINE_TESTS)} SELECT test, round_even(d, 3) AS cohens_d,
      CASE WHEN abs(round_even(d, 3)) >= 0.8 THEN 'Large' ELSE 'Medium' END AS effect FROM t""",
)
def _(spark, sf):
    return cohens_d(read_table(spark, sf, "lineitem"), _line_tests())


OBS_TESTS = [
    ("exam_sports", "sports_visitor_count", "is_exam_week = 1", "is_exam_week = 0"),
    ("exam_library", "library_occupancy", "is_exam_week = 1", "is_exam_week = 0"),
    ("event_food", "food_orders_demand", "campus_event_flag = 1", "campus_event_flag = 0"),
    ("weekend_sports", "sports_visitor_count", "is_weekend = 1", "is_weekend = 0"),
    ("lunch_food", "food_orders_demand", "starting_hour = 12", "starting_hour <> 12"),
]


def _obs_tests():
    hour = F.col("starting_hour")
    return [
        binary_split("exam_sports", "sports_visitor_count", "is_exam_week"),
        binary_split("exam_library", "library_occupancy", "is_exam_week"),
        binary_split("event_food", "food_orders_demand", "campus_event_flag"),
        binary_split("weekend_sports", "sports_visitor_count", "is_weekend", "Weekends",
                     "Weekdays"),
        TwoSample("lunch_food", "food_orders_demand", hour == 12, hour != 12, "Lunch", "Off"),
    ]


@query("two_sample_report")
def _(spark, sf):
    return two_sample_report(observation_table(spark, sf), _obs_tests())


@query(
    "two_sample_values",
    with_obs(f""", {_moments(OBS_TESTS, 'obs')}, {U_TEXT}
    SELECT test, CASE test WHEN 'weekend_sports' THEN 'Weekends' WHEN 'lunch_food' THEN 'Lunch'
        ELSE 'A' END || ' (N=' || n_a || ')' AS sample_a_label,
      round_even(m_a, 2) AS sample_a_mean, round_even(sqrt(v_a), 2) AS sample_a_std,
      round_even(m_b, 2) AS sample_b_mean, round_even(sqrt(v_b), 2) AS sample_b_std,
      round_even(t, 4) AS t_statistic, round_even(u.u, 2) AS mann_whitney_u,
      round_even(d, 3) AS cohens_d FROM t JOIN u USING (test)"""),
)
def _(spark, sf):
    report = two_sample_report(observation_table(spark, sf), _obs_tests())
    return report.select(
        "test", "sample_a_label", "sample_a_mean", "sample_a_std", "sample_b_mean",
        "sample_b_std", "t_statistic", "mann_whitney_u", "cohens_d",
    )
