"""Sentences with values in them."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def fill(template: str, **values: Column) -> Column:
    """``template`` with each ``{name}`` replaced by a column's text."""
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece.startswith("{") and piece.endswith("}"):
            parts.append(values[piece[1:-1]].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
