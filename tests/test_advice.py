import json

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import compare
from tideline import presets as P
from tideline.catalogue import QUERIES
from tideline.operators.recommend import (
    expand_slots, explain_factors, listed_slots, recommend_prep, recommend_slots,
    recommend_study, score_crowd, score_demand, score_occupancy,
)


def scored(spark, loads, requested):
    """One context whose six slots have the given loads."""
    df = spark.createDataFrame([(1, requested, 0)], "ctx int, requested int, is_weekend int")
    values = F.array(*[F.lit(float(x)) for x in loads])
    return expand_slots(df).withColumn("predicted_load_pct", F.get(values, F.col("slot_ord")))


def test_expand_slots(spark):
    df = spark.createDataFrame([(1, 1, 99)], "ctx int, is_weekend int, starting_hour int")
    got = expand_slots(df).orderBy("slot_ord").collect()
    assert [r.starting_hour for r in got] == [8, 10, 12, 14, 17, 20]
    assert [r.is_peak_hour for r in got] == [0, 1, 0, 0, 1, 0]
    plain = expand_slots(df.withColumn("is_peak_hour", F.lit(7)), peak=None)
    assert {r.is_peak_hour for r in plain.collect()} == {7}


@pytest.mark.parametrize("hour,slot", [
    (9, "Late Morning"), (13, "Afternoon"), (18, "Evening Peak"), (8, "Morning"), (5, "Evening Peak"),
    (23, "Evening Peak"), (21, "Night"), (11, "Noon / Lunch"), (15, "Afternoon"),
])
def test_requested_slot(spark, hour, slot):
    out = recommend_slots(scored(spark, range(6), hour), ["ctx"], "requested").first()
    assert out.requested_slot == slot


def test_recommend_slots(spark):
    out = recommend_slots(scored(spark, [50, 20, 70, 20, 85.5, 90], 18), ["ctx"], "requested")
    row = out.first()
    assert (row.requested_load_pct, row.should_shift) == (85.5, True)
    assert row.status_summary == "High Overcrowding Warning"
    assert "(05:00 - 08:00 PM)" in row.action_verdict and "85.5%" in row.action_verdict
    best = listed_slots(out, ["ctx"]).orderBy("rank").collect()
    assert [(r["rank"], r.time_window, r.predicted_load_pct) for r in best] == [
        (1, "10:00 - 12:00 PM", 20.0), (2, "02:00 - 05:00 PM", 20.0), (3, "08:00 - 10:00 AM", 50.0)]
    assert best[0].capacity_reduction == "65.5% less crowded than requested time"
    assert {r.court_availability for r in best} == {P.COURT_OPEN}
    assert len(row.full_day_schedule) == 6


def test_recommend_slots_falls_back(spark):
    out = recommend_slots(scored(spark, [70, 71, 66, 67, 65, 99], 18), ["ctx"], 18)
    row = out.first()
    assert (row.status_summary, row.should_shift) == ("Moderate Demand Advisory", False)
    assert [s.predicted_load_pct for s in row.recommended] == [66.0, 67.0, 70.0]
    assert row.recommended[0].capacity_reduction == P.NO_SAVING_TEXT
    assert row.recommended[0].court_availability == P.COURT_BUSY
    calm = recommend_slots(scored(spark, [1, 2, 3, 4, 64.9, 6], 18), ["ctx"], 18).first()
    assert calm.status_summary == "Optimal Time Confirmed"


def test_recommend_study(spark):
    out = recommend_study(scored(spark, [60, 59.9, 99, 10, 10, 61], 16), ["ctx"])
    assert [s.time_window for s in out.first().recommended] == ["02:00 - 05:00 PM", "05:00 - 08:00 PM"]
    none = recommend_study(scored(spark, [99] * 6, 16), ["ctx"]).first()
    assert none.recommended == []


def test_scores(spark):
    df = spark.createDataFrame(
        [(-3.0, 0, 0.1), (119.96, 1, 0.5555), (160.0, 0, 0.2), (190.0, 0, 0.2)],
        "predicted_value double, predicted_class int, probability double")
    got = score_crowd(df).collect()
    assert [(r.predicted_visitor_count, r.predicted_load_pct, r.is_overcrowded, r.risk_label)
            for r in got] == [(0.0, 0.0, False, "Low"), (120.0, 60.0, True, "Moderate"),
                              (160.0, 80.0, True, "High"), (190.0, 95.0, True, "Severe")]
    seats = score_occupancy(df).collect()
    assert [(r.predicted_occupancy, r.study_space_availability) for r in seats][0] == (
        10.0, "Ample Seats Available")


def test_demand_and_prep(spark):
    df = spark.createDataFrame([(100.0, 119), (100.0, 89), (100.0, 100), (3.0, 0), (100.0, None)],
                               "predicted_value double, plan int")
    got = score_demand(df, plan="plan", category=None).collect()
    assert got[0].planned_prep_evaluation == (
        "Warning: Planned preparation (119) exceeds predicted demand (100) by 19 portions. High "
        "risk of food waste! Recommend reducing to ~105 portions.")
    assert got[1].planned_prep_evaluation.startswith("Alert: Planned preparation (89) is below")
    assert got[2].planned_prep_evaluation.startswith("Optimal")
    assert got[3].planned_prep_evaluation is None and got[3].predicted_orders_demand == 10.0
    assert got[4].planned_prep_evaluation is None
    prep = spark.createDataFrame(
        [(126, 100.0), (111, 100.0), (110, 100.0), (94, 100.0), (84, 100.0)],
        "plan int, predicted_orders_demand double")
    assert [(r.waste_risk, r.shortage_risk) for r in recommend_prep(prep, "plan").collect()] == [
        ("High", "Low"), ("Moderate", "Low"), ("Low", "Low"), ("Low", "Moderate"), ("Low", "High")]


def test_explanation_of_the_published_context(spark):
    df = spark.createDataFrame(
        [(1, 18, 4, 1, 0, 0, 130)],
        "id int, starting_hour int, classes_ending_near int, tournament_flag int, "
        "is_exam_week int, rain_flag int, sports_prev_crowd int")
    got = explain_factors(df, ["id"]).orderBy("ord").collect()
    assert [r.impact for r in got] == ["+35.0%", "+22.0%", "+28.0%", "+14.0%"]
    assert got[1].factor == "4 Academic Batches Dismissing Nearby"
    assert got[3].factor == "High Incoming Crowd Momentum (Previous Slot: 130 visitors)"
    known = spark.createDataFrame([("tournament_flag", 0.5)], "feature string, importance double")
    weights = {r.feature: r.importance_weight for r in explain_factors(df, ["id"], known).collect()}
    assert weights["tournament_flag"] == 0.5 and weights["is_peak_hour"] == 0.15


def test_explanation_rules(spark):
    df = spark.createDataFrame([(1, 8, 1, 1, 1), (2, 12, 0, 0, 0)],
                               "id int, starting_hour int, sports_event_flag int, "
                               "is_exam_week int, rain_flag int")
    got = explain_factors(df, ["id"])
    assert sorted(r.impact for r in got.where("id = 1").collect()) == [
        "+16.5%", "-12.0%", "-18.0%", "-19.5%"]
    assert got.where("id = 2").count() == 0


def test_contexts_are_sorted_after_the_shuffle(spark):
    # slots of a whole part of a file in one sort grow with that part
    days = recommend_study(scored(spark, range(6), 18), ["ctx"])
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "Aggregate" not in below and "Sort " not in below


def test_the_query_ranks_the_offers_and_lists_the_day(spark, tmp_path):
    rows = [(k, "n", k % 25, 0.0, "s") for k in range(1, 60)]
    df = spark.createDataFrame(
        rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    df.write.parquet(f"{tmp_path}/customer.parquet")
    got = QUERIES["recommend_slots"](spark, str(tmp_path)).where("c_custkey = 7").first()
    loads = [(7 * 37 + h * 113) % 1000 / 10 for h in (8, 10, 12, 14, 17, 20)]
    day, best = json.loads(got.full_day_schedule), json.loads(got.recommended)
    assert (got.requested_hour, [s["load"] for s in day]) == (14, loads)
    asked = loads[3]
    others = [x for i, x in enumerate(loads) if i != 3]
    want = sorted([x for x in others if x < asked] or others)[:3]
    assert [s["predicted_load_pct"] for s in best] == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    ok, text, _ = compare(spark, con, "recommend_slots", str(tmp_path))
    assert ok, text
