"""Every registered query against its SQL, on whole (small) tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from procurelens import registry
from tests.compare import connect, difference
from tests.conftest import SMALLEST

QUERIES, STATEMENTS = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALLEST)


def test_every_analytic_has_sql():
    """Operators of the optional part have SQL where it can state them; their own tests cover the rest."""
    assert set(registry.all_queries()) <= set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALLEST), con, STATEMENTS[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
