import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortspark.session import HOT_ROWS_CONF, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", 4, **{"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def small_limit(spark):
    """Treat groups above 40 rows as hot, so that the split path runs."""
    spark.conf.set(HOT_ROWS_CONF, "40")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


def rows(df, *order):
    """Rows as tuples; sorted by repr unless an order is given."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=repr)
