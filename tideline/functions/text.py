"""Readings of free text: headers, hours, stages, workload, events, supply risk."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tideline import presets as P
from tideline.functions.numbers import col


def normal_name(name: str) -> str:
    """One header, lower-cased, with every run of other signs as one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", str(name).strip().lower()).strip("_")


def normal_text(c: str | Column) -> Column:
    """``normal_name`` for a text column."""
    return F.trim(F.regexp_replace(F.lower(F.trim(col(c))), "[^a-z0-9]+", "_"), F.lit("_"))


def parse_hour(c: str | Column, default: int = 14) -> Column:
    """The digits in front of the first colon, ``default`` if there are none."""
    digits = F.regexp_extract(col(c).cast("string"), P.HOUR_PATTERN, 1)
    return F.coalesce(digits.try_cast("int"), F.lit(default))


def matches(c: str | Column, pattern: str) -> Column:
    """1 where the lower-cased text contains ``pattern``, 0 also for NULL."""
    return F.coalesce(F.lower(col(c).cast("string")).rlike(pattern), F.lit(False)).cast("int")


def workload_level(c: str | Column, null_level: str = "High") -> Column:
    """Low up to 2, Medium up to 4, else High; level names are kept, other text is Medium.

    A missing value is ``null_level``.
    """
    text = F.trim(col(c).cast("string"))
    score = text.try_cast("double")
    named = F.initcap(F.lower(text))
    return (
        F.when(col(c).isNull(), null_level)
        .when(score <= 2, "Low")
        .when(score <= 4, "Medium")
        .when(score.isNotNull(), "High")
        .when(named.isin(list(P.WORKLOAD_POINTS)), named)
        .otherwise("Medium")
    )


def workload_code(c: str | Column) -> Column:
    """Level of a 1-5 code; any other number is Medium."""
    v = col(c)
    return F.when(v.isin(1, 2), "Low").when(v == 5, "High").otherwise("Medium")


def event_columns(c: str | Column) -> dict[str, Column]:
    """Event name without NULLs and the flags and attendance read from it."""
    name = F.coalesce(F.nullif(col(c).cast("string"), F.lit("nan")), F.lit("None"))
    sports = matches(name, P.SPORTS_EVENT_PATTERN)
    cultural = matches(name, P.CULTURAL_EVENT_PATTERN)
    either = F.greatest(sports, cultural)
    return {
        "event_type": name,
        "sports_event_flag": sports,
        "tournament_flag": sports,
        "cultural_major_event_flag": cultural,
        "campus_event_flag": either,
        "expected_event_attendance": either * F.lit(P.EVENT_ATTENDANCE),
    }


def supply_text(c: str | Column) -> Column:
    """Supply label behind a code or a text; unknown text is kept."""
    key = F.lower(F.trim(col(c).cast("string")))
    out = F.when(key.isNull(), P.BALANCED)
    for label, texts in P.RISK_TEXTS.items():
        out = out.when(key.isin(texts), label)
    return out.otherwise(col(c).cast("string"))
