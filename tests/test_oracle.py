"""Every registered query gives what its SQL gives."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences
from checks.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, SMALL), con, oracle_sql()[name]) == []


def test_every_query_has_sql():
    """The training-data operators have their own tests; some of them SQL cannot express."""
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    result = entry(spark)
    assert result.columns == [
        "category",
        "total_orders",
        "units_sold",
        "total_revenue",
        "revenue_share_pct",
    ]
    assert result.count() == 6
