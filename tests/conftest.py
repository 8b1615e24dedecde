import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
           "spark.ui.enabled": "false", "spark.default.parallelism": "4"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Collected rows as plain tuples, sorted."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        key = lambda r: tuple((v is None, str(type(v)), v) for v in r)
        return sorted((tuple(r) for r in picked.collect()), key=key)

    return collect
