"""Value -> label by ascending cut points; each band includes its lower end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tideline.functions.numbers import col
from tideline.presets import AVAILABILITY_BAND, PULSE_BAND, RISK_BAND, SLOT_CUTS, SLOT_ORDER

TOP = object()


def band(c: str | Column, cuts: Sequence[float], labels: Sequence, null_label=TOP) -> Column:
    """Label of the band that holds ``c``.

    A missing value gets the last label unless ``null_label`` names another.
    """
    if len(labels) != len(cuts) + 1 or list(cuts) != sorted(cuts):
        raise ValueError("need ascending cuts and one label more than cuts")
    value = col(c)
    out = F.when(value.isNull(), F.lit(labels[-1] if null_label is TOP else null_label))
    for cut, label in zip(cuts, labels):
        out = out.when(value < F.lit(cut), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def risk_level(c: str | Column) -> Column:
    return band(c, *RISK_BAND)


def availability(c: str | Column) -> Column:
    return band(c, *AVAILABILITY_BAND)


def pulse_level(c: str | Column) -> Column:
    return band(c, *PULSE_BAND)


def slot_of_hour(c: str | Column) -> Column:
    return band(c, SLOT_CUTS, SLOT_ORDER)
