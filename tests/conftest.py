import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldtally.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect as a sorted list of tuples; NULL sorts first."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(type(x)), x) for x in r])


@pytest.fixture
def plan():
    """Text of the physical plan, after running it when it is adaptive."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
