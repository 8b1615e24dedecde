"""All SQL comparisons, on request: TIDELINE_ORACLE=<folder> (see tests/oracle.py)."""

import os

import pytest

from oracle import compare, connect
from tideline.catalogue import QUERIES, SQL_TEXTS

FOLDER = os.environ.get("TIDELINE_ORACLE")
QUICK = ["observations", "trend_by_slot", "describe_gaps", "transition_matrix", "corr_pairwise",
         "confusion_matrix", "recommended_slots", "supply_balance"]


def test_every_sql_text_has_a_query():
    assert set(SQL_TEXTS) <= set(QUERIES)
    assert len(SQL_TEXTS) >= 120


@pytest.mark.parametrize("name", sorted(SQL_TEXTS) if FOLDER else QUICK)
def test_query_agrees_with_sql(spark, sf, name):
    folder = FOLDER or sf
    ok, text, _ = compare(spark, connect(folder), name, folder)
    assert ok, text
