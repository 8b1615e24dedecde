"""Queries over the given tables, one per operator, with a SQL text that must agree."""

from tideline.catalogue.registry import QUERIES, SQL_TEXTS  # noqa: F401
from tideline.catalogue import (  # noqa: F401
    tables, cleaning, features, facility, listing, spread, timeline, association, learning,
    grouping, advice, live,
)
