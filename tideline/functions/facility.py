"""Load, supply balance and the composite pulse index as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from tideline import presets as P
from tideline.functions.numbers import clip, col, half_even, ratio


def load_pct(count: str | Column, capacity: str | Column, digits: int = 1) -> Column:
    """Count as a percentage of capacity; no capacity gives NULL."""
    return half_even(ratio(count, capacity) * 100, digits)


def threshold_flag(c: str | Column, limit: float = P.HIGH_LOAD) -> Column:
    return F.coalesce(col(c) >= F.lit(limit), F.lit(False)).cast("int")


def prepared_qty(demand: str | Column, risk: str | Column | None = None) -> Column:
    """Portions to prepare: less than the demand where a shortage is reported."""
    factor = F.lit(P.SAFE_PREP)
    if risk is not None:
        factor = F.when(col(risk) == P.SHORTAGE, P.SHORT_PREP).otherwise(factor)
    return half_even(col(demand) * factor, 0).try_cast("int")


def supply_balance(prepared: str | Column, demand: str | Column) -> dict[str, Column]:
    """Sold, surplus, surplus in percent of the preparation, shortage."""
    made, asked = col(prepared), col(demand)
    sold = F.least(made, asked)
    surplus = F.greatest(F.lit(0), made - sold)
    return {
        "food_sold_qty": sold,
        "food_surplus_qty": surplus,
        "food_surplus_pct": half_even(ratio(surplus, F.greatest(F.lit(1), made)) * 100, 1),
        "food_shortage_qty": F.greatest(F.lit(0), asked - made),
    }


def supply_risk(
    surplus_pct: str | Column,
    shortage: str | Column,
    max_surplus: float = P.SURPLUS_PCT,
    max_shortage: float = P.SHORTAGE_QTY,
) -> Column:
    return (
        F.when(col(surplus_pct) > max_surplus, P.SURPLUS)
        .when(col(shortage) > max_shortage, P.SHORTAGE)
        .otherwise(P.BALANCED)
    )


def workload_points(level: str | Column) -> Column:
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in P.WORKLOAD_POINTS.items())
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(level)), F.lit(P.WORKLOAD_UNKNOWN))


def pulse_parts(
    sports: str | Column,
    library: str | Column,
    food: str | Column,
    workload: str | Column,
    ceiling: float | Column = P.FOOD_CEILING,
    weights: dict[str, float] = P.PULSE_WEIGHTS,
) -> dict[str, Column]:
    """The four weighted contributions to the index, not rounded."""
    ceiling = ceiling if isinstance(ceiling, Column) else F.lit(float(ceiling))
    food_load = clip(ratio(food, ceiling) * 100, 0.0, 100.0)
    scores = {
        "sports": col(sports),
        "library": col(library),
        "food": food_load,
        "workload": workload_points(workload),
    }
    return {name: F.lit(weights[name]) * score for name, score in scores.items()}


def pulse_index(*facilities, clamp: bool = True, **options) -> Column:
    """Weighted sum of sports load, library load, food load and workload points."""
    sports, library, food, workload = pulse_parts(*facilities, **options).values()
    total = sports + library + food + workload
    return half_even(clip(total, 0.0, 100.0) if clamp else total, 2)


def pulse_breakdown(*facilities, **options) -> dict[str, Column]:
    return {
        f"{name}_contribution": half_even(part, 2)
        for name, part in pulse_parts(*facilities, **options).items()
    }
