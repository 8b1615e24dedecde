"""Every query of the subpackage that SQL can state, against DuckDB."""

import os

import pytest

from oracle import canonical, connect
from tideline.llm.queries import QUERIES, SQL_TEXTS

FOLDER = os.environ.get("TIDELINE_ORACLE")


@pytest.mark.parametrize("name", sorted(SQL_TEXTS))
def test_query_agrees_with_sql(spark, sf, name):
    folder = FOLDER or sf
    df = QUERIES[name](spark, folder)
    want = connect(folder).execute(SQL_TEXTS[name])
    names = [d[0] for d in want.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(
        names, want.fetchall()
    )
