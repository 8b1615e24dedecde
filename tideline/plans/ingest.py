"""From an uploaded table to the canonical observation table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tideline import presets as P
from tideline.functions.banding import availability, pulse_level, risk_level, slot_of_hour
from tideline.functions.calendar import calendar_columns, peak_flag, read_day, semester_week
from tideline.functions.facility import (
    load_pct, prepared_qty, pulse_index, supply_balance, supply_risk, threshold_flag,
)
from tideline.functions.numbers import half_even, whole
from tideline.functions.text import event_columns, matches, parse_hour, supply_text, workload_level
from tideline.operators.mapping import (
    coalesce_derived, coerce_numeric, default_columns, fill_all, map_categories, map_columns,
)
from tideline.operators.ordering import sequence_features


def _absent(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add the columns ``df`` does not have yet."""
    new = {n: c for n, c in columns.items() if n not in df.columns}
    return df.withColumns(new) if new else df


def clean_calendar(
    df: DataFrame, today: str | datetime.date, first_day: Column, timed: bool = False
) -> DataFrame:
    """Date, slot, hour, weekday and week.

    With ``timed`` the hour is read from the slot text and replaces a given hour.
    """
    df = default_columns(df, {"date": str(today)})
    out = df.withColumn("_day", read_day("date"))
    if timed:
        out = out.withColumn("starting_hour", parse_hour("time_slot"))
        out = out.withColumn("time_slot", slot_of_hour("starting_hour"))
    out = coerce_numeric(out, {"starting_hour": P.NUMBER_DEFAULTS["starting_hour"]})
    supplied = {"day_of_week", "is_weekend"} & set(df.columns)
    made = calendar_columns("_day")
    out = out.withColumns({n: c for n, c in made.items() if n not in supplied})
    out = out.withColumn("semester_week", semester_week("_day", first_day))
    return _absent(
        out,
        {"time_slot": slot_of_hour("starting_hour"), "is_peak_hour": peak_flag("starting_hour")},
    ).drop("_day")


def clean_academics(df: DataFrame) -> DataFrame:
    """Stage, workload, classes and the exam flags read from the stage text."""
    if "semester_stage" in df.columns:
        exam = matches("semester_stage", P.STAGE_PATTERN)
    else:
        exam = F.lit(0)
    out = _absent(
        df, {c: exam for c in ("is_exam_week", "is_midterm", "is_assignment_deadline")}
    )
    if "semester_stage" in df.columns:
        out = map_categories(out, "semester_stage", P.STAGE_RECODE)
    if "academic_workload" in df.columns:
        out = out.withColumn("academic_workload", workload_level("academic_workload"))
    out = default_columns(out, {c: P.COLUMN_DEFAULTS[c] for c in
                                ("semester_stage", "academic_workload")})
    return coerce_numeric(out, {"classes_ending_near": P.NUMBER_DEFAULTS["classes_ending_near"]})


def clean_events(df: DataFrame) -> DataFrame:
    df = default_columns(df, {"event_type": P.COLUMN_DEFAULTS["event_type"]})
    made = event_columns("event_type")
    out = df
    if "campus_event_flag" in df.columns:
        out = coerce_numeric(out, {"campus_event_flag": 0})
    return _absent(out, {n: c for n, c in made.items() if n != "event_type"}).withColumn(
        "event_type", made["event_type"]
    )


def clean_supply(df: DataFrame, reported: bool) -> DataFrame:
    """Preparation, balance and supply label; ``reported`` labels are kept."""
    asked, label = "food_orders_demand", "food_risk_category"
    if reported:
        df = df.withColumn(label, supply_text(label))
    made = prepared_qty(asked, label if reported else None)
    df = _absent(df, {"food_prepared_qty": made})
    df = df.withColumn("food_prepared_qty", whole("food_prepared_qty"))
    df = df.withColumns(supply_balance("food_prepared_qty", asked))
    if reported:
        return df
    return df.withColumn(label, supply_risk("food_surplus_pct", "food_shortage_qty"))


# --- Fixed values: table-wide columns (name, source, digits of the mean or None for the peak) ---
HISTORY = [
    ("sports_hist_avg_crowd", "sports_visitor_count", 1),
    ("sports_hist_peak_crowd", "sports_visitor_count", None),
    ("food_hist_demand", "food_orders_demand", 1),
    ("library_hist_avg_occupancy", "library_occupancy", 1),
    ("library_hist_peak_occupancy", "library_occupancy", None),
]


def upload_facts(df: DataFrame, today: str | datetime.date) -> dict:
    """What the cleaning needs to know of the whole upload, from one pass."""
    have = set(df.columns)
    given = lambda c, expr, other: expr if c in have else F.lit(other)
    looks_timed = F.bool_or(F.col("time_slot").cast("string").rlike("[:-]"))
    aggs = {
        "rows": F.count("*"),
        "first_day": given("date", F.min(read_day("date")), str(today)),
        "unread_days": given(
            "date", F.count_if(F.col("date").isNotNull() & read_day("date").isNull()), 0
        ),
        "timed": given("time_slot", F.coalesce(looks_timed, F.lit(False)), False),
        "reported": given("food_risk_category", F.count("food_risk_category") > 0, False),
        "indexed": given("campus_pulse_index", F.count("campus_pulse_index") > 0, False),
    }
    for name, source, digits in HISTORY:
        default = P.NUMBER_DEFAULTS[source]
        value = whole(source, default) if source in have else F.lit(default)
        aggs[name] = F.max(value) if digits is None else half_even(F.avg(value), digits)
    return df.agg(*[e.alias(n) for n, e in aggs.items()]).first().asDict()


# --- Fixed values: lag columns and what they lag ---
LAGS = {
    "sports_prev_crowd": "sports_visitor_count",
    "food_prev_orders": "food_orders_demand",
    "library_prev_occupancy": "library_occupancy",
}


def ingest(
    raw: DataFrame,
    order: Sequence[str] = ("date", "starting_hour"),
    today: str | datetime.date | None = None,
    label: str = P.IMPORT_LABEL,
    keep: Sequence[str] = (),
    parse: str | bool = "auto",
    prefix: str = P.IMPORT_PREFIX,
) -> DataFrame:
    """Map, complete, derive, number and label an uploaded table.

    ``order`` says what stands for the row order of a file: the lags and the
    record ids follow it, so it should be total.  ``today`` dates an upload that
    has no date column.  ``keep`` names extra columns
    (after header normalisation) that ``order`` may use.  Rows beyond that are
    those of the canonical schema.
    """
    today = today or datetime.date.today()
    aliases = {**P.COLUMN_ALIASES, **{k: [k] for k in keep}}
    df = map_columns(raw, aliases)
    facts = upload_facts(df, today) if df.columns else {"rows": 0}
    if not facts["rows"]:
        raise ValueError("the uploaded table has no rows of data")
    timed = facts["timed"] if parse == "auto" else bool(parse) and "time_slot" in df.columns
    first_day = F.lit(facts["first_day"]).cast("date")

    df = clean_cells(df, today, first_day, timed)
    df = df.withColumns({name: F.lit(facts[name]) for name, _, _ in HISTORY})

    # one range shuffle gives the record numbers and the previous rows
    absent = {n: c for n, c in LAGS.items() if n not in df.columns}
    df = sequence_features(df, order, "_rn", absent)
    df = df.withColumns({n: F.coalesce(n, c) for n, c in absent.items()})
    df = df.withColumn("record_id", F.format_string(f"{prefix}-%04d", F.col("_rn")))

    df = derive_cells(df, facts["reported"], facts["indexed"], label)
    return conform(df, keep)


def clean_cells(
    df: DataFrame, today: str | datetime.date, first_day: Column, timed: bool
) -> DataFrame:
    """Calendar, academics, events, constants and counts; each row by itself."""
    df = clean_events(clean_academics(clean_calendar(df, today, first_day, timed)))
    constants = {c: v for c, v in P.COLUMN_DEFAULTS.items() if c not in ("event_type",)}
    df = default_columns(df, constants)
    counts = ("sports_visitor_count", "food_orders_demand", "library_occupancy")
    return coerce_numeric(df, {c: P.NUMBER_DEFAULTS[c] for c in counts})


def derive_cells(df: DataFrame, reported: bool, indexed: bool, label: str) -> DataFrame:
    """Loads, supply, index and levels after ``clean_cells``; each row by itself.

    ``reported`` supply labels are kept; a supplied index has gaps of 50.
    """
    # loads from counts and capacities where none were supplied
    for load, count, capacity in (
        ("sports_load_pct", "sports_visitor_count", "sports_capacity"),
        ("library_load_pct", "library_occupancy", "library_capacity"),
    ):
        df = coalesce_derived(df, load, load_pct(count, capacity))
    crowded = threshold_flag("sports_load_pct")
    df = coalesce_derived(df, "sports_overcrowded_flag", crowded, 0)
    df = clean_supply(df, reported)
    index = pulse_index(
        "sports_load_pct", "library_load_pct", "food_orders_demand", "academic_workload",
        clamp=False,
    )
    if indexed:
        index = F.lit(50.0)
    df = coalesce_derived(df, "campus_pulse_index", index, 2)
    return df.withColumns(
        {
            "sports_risk_level": risk_level("sports_load_pct"),
            "library_high_demand_flag": threshold_flag("library_load_pct"),
            "study_space_availability": availability("library_load_pct"),
            "campus_activity_status": pulse_level("campus_pulse_index"),
            "data_source_label": F.lit(label),
        }
    )


def conform(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical columns in order and type, without NULLs."""
    schema = T.StructType.fromDDL(P.OBSERVATION_SCHEMA)
    typed = df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema],
        *[F.col(k) for k in keep if k not in schema.names],
    )
    return fill_all(typed)
