"""Calendar and clock features as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tideline.functions.numbers import clip, col
from tideline.presets import PEAK_HOURS


# --- Fixed values: ways of writing a day, tried in this order after yyyy-MM-dd ---
DAY_FORMATS = [
    "M/d/yyyy[ H:mm[:ss]]", "M-d-yyyy[ H:mm[:ss]]", "d/M/yyyy[ H:mm[:ss]]", "d-M-yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]", "yyyyMMdd", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy",
]


def read_day(c: str | Column) -> Column:
    """A date from text in any of the usual forms, month first where both fit; else NULL."""
    text = F.trim(col(c).cast("string"))
    tried = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in DAY_FORMATS]
    return F.coalesce(text.try_cast("date"), *tried)


def calendar_columns(day: str | Column) -> dict[str, Column]:
    """Day name, weekday number (Monday is 0), weekend flag, month, date text."""
    d = F.to_date(col(day))
    number = F.weekday(d)
    return {
        "date": F.date_format(d, "yyyy-MM-dd"),
        "day_of_week": F.date_format(d, "EEEE"),
        "day_of_week_num": number,
        "is_weekend": (number >= 5).cast("int"),
        "month": F.month(d),
    }


def peak_flag(hour: str | Column, preset: str = "ingest", weekend: str | Column | None = None):
    """1 in the peak hours of ``preset``; some presets add hours on weekends."""
    always, on_weekend = PEAK_HOURS[preset]
    h = col(hour)
    hit = h.isin(always)
    if on_weekend and weekend is not None:
        hit = hit | ((F.coalesce(col(weekend), F.lit(0)) != 0) & h.isin(on_weekend))
    return F.coalesce(hit, F.lit(False)).cast("int")


def semester_week(day: str | Column, first_day: Column, weeks: int = 16) -> Column:
    """1-based week since ``first_day``, limited to 1..weeks."""
    days = F.datediff(F.to_date(col(day)), first_day)
    return clip(F.floor(days / 7) + 1, 1, weeks).cast("int")


def cyclic(c: str | Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of the position in a cycle."""
    angle = col(c) * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def academic_calendar(week: str | Column, weekday: str | Column) -> dict[str, Column]:
    """Stage, workload and flags that follow from semester week and weekday."""
    w, d = col(week), col(weekday)
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("int")
    deadline = (
        ((w == 4) & d.isin(3, 4))
        | (w.between(5, 8) & d.isin(3, 4))
        | (w.between(9, 14) & d.isin(2, 3, 4))
    )
    return {
        "semester_stage": F.when(w <= 4, "Early").when(w <= 8, "Mid").when(w <= 14, "Late")
        .otherwise("Finals"),
        "academic_workload": F.when(w <= 4, "Low").when(w.isin(8, 13, 14) | (w >= 15), "High")
        .otherwise("Medium"),
        "is_exam_week": flag((w == 8) | (w >= 15)),
        "is_midterm": flag(w == 8),
        "is_assignment_deadline": flag(deadline),
    }
