import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tideline import presets as P
from tideline.functions import tails
from tideline.functions.banding import availability, band, pulse_level, risk_level, slot_of_hour
from tideline.functions.calendar import (
    academic_calendar, calendar_columns, peak_flag, read_day, semester_week,
)
from tideline.functions.facility import (
    load_pct, prepared_qty, pulse_breakdown, pulse_index, supply_balance, supply_risk,
    threshold_flag, workload_points,
)
from tideline.functions.numbers import clip, finite_or_zero, half_even, number, whole
from tideline.functions.text import (
    event_columns, normal_name, normal_text, parse_hour, supply_text, workload_code,
    workload_level,
)
from tideline.functions.texts import fill


def one(spark, value, expr, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in value], f"v {kind}")
            .select(expr).collect()]


def test_half_even_rounds_ties_to_even(spark):
    values = [0.125, 0.375, 2.5, 3.5, -0.125, None]
    assert one(spark, values[:2], half_even("v", 2), "double") == [0.12, 0.38]
    assert one(spark, values, half_even("v", 0), "double") == [0.0, 0.0, 2.0, 4.0, 0.0, None]


def test_number_and_whole(spark):
    values = ["7", " 3.9 ", "x", None, "NaN", "-2.7"]
    assert one(spark, values, number("v")) == [7.0, 3.9, None, None, None, -2.7]
    assert one(spark, values, whole("v", 5)) == [7, 3, 5, 5, 5, -2]
    assert one(spark, ["1e12", "Infinity"], whole("v", 5)) == [5, 5]


def test_clip_and_finite(spark):
    nan, inf = float("nan"), float("inf")
    assert one(spark, [-1.0, 5.0, 99.0, None], clip("v", 0.0, 10.0), "double") == [
        0.0, 5.0, 10.0, None]
    assert one(spark, [nan, inf, -inf, None, 2.0], finite_or_zero("v"), "double") == [
        0.0, 0.0, 0.0, 0.0, 2.0]


@pytest.mark.parametrize("expr,cuts,labels", [
    (risk_level, *P.RISK_BAND), (availability, *P.AVAILABILITY_BAND),
    (pulse_level, *P.PULSE_BAND), (slot_of_hour, P.SLOT_CUTS, P.SLOT_ORDER),
])
def test_bands_include_their_lower_end(spark, expr, cuts, labels):
    values, want = [], []
    for i, cut in enumerate(cuts):
        values += [cut - 0.001, float(cut)]
        want += [labels[i], labels[i + 1]]
    assert one(spark, values + [None], expr("v"), "double") == want + [labels[-1]]


def test_band_checks_its_arguments():
    with pytest.raises(ValueError):
        band("v", [2, 1], ["a", "b", "c"])
    with pytest.raises(ValueError):
        band("v", [1], ["a"])


@pytest.mark.parametrize("name,want", [
    (" Sports-Visitors ", "sports_visitors"), ("Temp (C)", "temp_c"), ("__a__b__", "a_b"),
    ("Ünit", "nit"), ("", ""),
])
def test_normal_name_and_text_agree(spark, name, want):
    assert normal_name(name) == want
    assert one(spark, [name], normal_text("v")) == [want]


def test_parse_hour(spark):
    values = ["8:00-10:00", "from 12:30", "Evening", "123:45", None, "7-9"]
    assert one(spark, values, parse_hour("v")) == [8, 12, 14, 23, 14, 14]
    assert one(spark, ["x"], parse_hour("v", 12)) == [12]


def test_workload_level(spark):
    values = ["1", "2", "2.5", "4", "4.1", "low", " HIGH", "medium", "busy", "NaN", None]
    assert one(spark, values, workload_level("v")) == [
        "Low", "Low", "Medium", "Medium", "High", "Low", "High", "Medium", "Medium", "High",
        "High"]
    assert one(spark, [None], workload_level("v", "Medium")) == ["Medium"]
    assert one(spark, [1, 2, 3, 4, 5, 6, None], workload_code("v"), "int") == [
        "Low", "Low", "Medium", "Medium", "High", "Medium", "Medium"]


def test_supply_text(spark):
    values = ["1", " TRUE", "Shortage", "2.0", "surplus risk", "0", "none", "", "nan", None, "Odd"]
    s, u, b = P.SHORTAGE, P.SURPLUS, P.BALANCED
    assert one(spark, values, supply_text("v")) == [s, s, s, u, u, b, b, b, b, b, "Odd"]


def test_event_columns(spark):
    df = spark.createDataFrame([("Chess Match",), ("Cultural fest",), ("nan",), (None,)], "v string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in event_columns("v").items()])
           .collect()]
    assert got == [
        ("Chess Match", 1, 1, 0, 1, 80), ("Cultural fest", 0, 0, 1, 1, 80),
        ("None", 0, 0, 0, 0, 0), ("None", 0, 0, 0, 0, 0)]


def test_calendar(spark):
    df = spark.createDataFrame([("2026-08-03",), ("2026-08-09",), ("2027-01-01",)], "v string")
    got = [tuple(r) for r in df.select(*calendar_columns("v").values()).collect()]
    assert got == [("2026-08-03", "Monday", 0, 0, 8), ("2026-08-09", "Sunday", 6, 1, 8),
                   ("2027-01-01", "Friday", 4, 0, 1)]
    first = F.lit("2026-08-03").cast("date")
    assert one(spark, ["2026-08-03", "2026-08-09", "2026-08-10", "2027-08-01", "2026-01-01"],
               semester_week("v", first)) == [1, 1, 2, 16, 1]


def test_peak_flag_presets(spark):
    hours = list(range(24))
    hit = lambda *a: {h for h, f in zip(hours, one(spark, hours, peak_flag("v", *a), "int")) if f}
    assert hit("ingest") == {12, 13, 14, 17, 18, 19, 20}
    assert hit("exploration") == {12, 13, 17, 18, 19}
    assert hit("recommend", F.lit(0)) == {17, 18, 19}
    assert hit("recommend", F.lit(1)) == {10, 16, 17, 18, 19}


def test_academic_calendar(spark):
    cells = [(w, d) for w in range(1, 17) for d in range(7)]
    df = spark.createDataFrame(cells, "w int, d int")
    got = df.select("w", "d", *[c.alias(n) for n, c in academic_calendar("w", "d").items()])
    seen = {(r.w, r.d): r for r in got.collect()}
    assert {w for w, _ in seen if seen[w, 0].is_exam_week} == {8, 15, 16}
    assert {w for w, _ in seen if seen[w, 0].is_midterm} == {8}
    assert [seen[w, 0].academic_workload for w in (4, 5, 8, 9, 13, 16)] == [
        "Low", "Medium", "High", "Medium", "High", "High"]
    due = {k for k, r in seen.items() if r.is_assignment_deadline}
    assert due == ({(4, 3), (4, 4)} | {(w, d) for w in range(5, 9) for d in (3, 4)}
                   | {(w, d) for w in range(9, 15) for d in (2, 3, 4)})


def test_supply_functions(spark):
    df = spark.createDataFrame([(100, 80), (80, 100), (0, 5), (84, 80)], "made int, asked int")
    out = df.withColumns(supply_balance("made", "asked"))
    out = out.withColumn("risk", supply_risk("food_surplus_pct", "food_shortage_qty"))
    assert [tuple(r)[2:] for r in out.collect()] == [
        (80, 20, 20.0, 0, P.SURPLUS), (80, 0, 0.0, 20, P.SHORTAGE), (0, 0, 0.0, 5, P.BALANCED),
        (80, 4, 4.8, 0, P.BALANCED)]
    assert one(spark, [10, 50, 130], prepared_qty("v"), "int") == [10, 52, 136]
    assert one(spark, [10], prepared_qty("v", F.lit(P.SHORTAGE)), "int") == [8]


def test_load(spark):
    df = spark.createDataFrame([(90, 200), (160, 200), (5, 0), (None, 10)], "c int, cap int")
    got = df.select(load_pct("c", "cap").alias("l")).withColumn("f", threshold_flag("l"))
    assert [tuple(r) for r in got.collect()] == [(45.0, 0), (80.0, 1), (None, 0), (None, 0)]


def test_pulse_of_the_published_example(spark):
    args = [F.lit(x) for x in (85.0, 90.0, 220.0, "High")]
    parts = pulse_breakdown(*args)
    row = spark.range(1).select(
        pulse_index(*args).alias("i"), *[c.alias(n) for n, c in parts.items()]
    ).withColumn("s", pulse_level("i")).first()
    assert tuple(row) == (84.08, 29.75, 27.0, 18.33, 9.0, "High Congestion")


def test_pulse_limits(spark):
    high = [F.lit(x) for x in (400.0, 400.0, 9000.0, "High")]
    low = [F.lit(x) for x in (-400.0, 0.0, -5.0, "?")]
    row = spark.range(1).select(
        pulse_index(*high), pulse_index(*low), pulse_index(*high, clamp=False)).first()
    assert tuple(row) == (100.0, 0.0, 294.0)
    assert one(spark, ["Low", "Medium", "High", "x", None], workload_points("v")) == [
        30.0, 60.0, 90.0, 60.0, 60.0]


def test_fill(spark):
    got = spark.range(1).select(fill("a {x}% of {y}.", x=F.lit(2.5), y=F.lit(7))).first()[0]
    assert got == "a 2.5% of 7."


# known values of the t and rank-sum laws
@pytest.mark.parametrize("t,df,p", [
    (2.0, 10, 0.07338803477074), (1.0, 1, 0.5), (12.706204736432, 1, 0.05), (0.0, 5, 1.0),
    (1.9599639845, 1e9, 0.05), (-2.228138851964, 10, 0.05), (63.65674, 1, 0.01),
])
def test_t_tail(t, df, p):
    assert tails.t_two_sided(t, df) == pytest.approx(p, rel=1e-6)


@pytest.mark.parametrize("u,n1,n2,p", [
    (0, 3, 3, 0.1), (0, 5, 5, 2 / 252), (12.5, 5, 5, 1.0), (25, 5, 5, 2 / 252),
    (1, 4, 4, 4 / 70), (0, 1, 9, 0.2),
    # one of all subsets on either side, at any size
    (0, 5, 50_000, 2 / math.comb(50_005, 5)), (0, 8, 10**9, 2 / math.comb(10**9 + 8, 8)),
    (4 * 10**9, 8, 10**9, 1.0),
])
def test_rank_sum_tail(u, n1, n2, p):
    assert tails.u_two_sided(u, n1, n2) == pytest.approx(p)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.data())
def test_rank_sum_tail_by_enumeration(n1, n2, data):
    from itertools import combinations

    u = data.draw(st.integers(0, n1 * n2))
    ranks = range(1, n1 + n2 + 1)
    values = [sum(c) - n1 * (n1 + 1) // 2 for c in combinations(ranks, n1)]
    larger = max(u, n1 * n2 - u)
    p = min(1.0, 2 * sum(v >= larger for v in values) / len(values))
    assert tails.u_two_sided(u, n1, n2) == pytest.approx(p)


def test_read_day(spark):
    forms = ["2024-03-05", "03/05/2024", "15/03/2024", "3/5/2024 14:30", "2024/3/5", "20240305",
             "5 Mar 2024", "March 5, 2024", " 2024-03-05T08:00:00 ", "soon", "", None]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, d string")
    got = [r[0] for r in df.orderBy("i").select(read_day("d").cast("string")).collect()]
    day = "2024-03-05"
    assert got == [day, day, "2024-03-15", day, day, day, day, day, day, None, None, None]


def test_beta_tail_symmetry():
    for a, b, x in [(0.5, 3.0, 0.2), (40.0, 0.5, 0.9), (7.0, 7.0, 0.5)]:
        assert tails.beta_tail(a, b, x) + tails.beta_tail(b, a, 1 - x) == pytest.approx(1.0)
    assert math.isclose(tails.beta_tail(7.0, 7.0, 0.5), 0.5)
