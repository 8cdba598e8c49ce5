"""Queries over a whole order, with the order cut into one, a few and many ranges."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.compare import connect, difference
from tests.conftest import SMALLEST


@pytest.fixture(params=[1, 3, 30])
def ranges(spark, request):
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


@pytest.mark.parametrize("name", [
    "vendor_spend_ranking", "vendor_pareto_count", "opp_tail_spend", "price_volume_effect"])
def test_matches_sql(spark, ranges, name):
    result = driver.queries()[name](spark, SMALLEST)
    assert difference(result, connect(SMALLEST), driver.oracle_sql()[name]) is None
