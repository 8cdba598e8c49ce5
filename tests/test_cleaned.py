"""Analytics over cleaned staging: defects arrive, copies do not, and staging is cleaned once."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import oracle.cleaned
from procurelens import registry
from procurelens.plans import cleaned, spend
from procurelens.sources import order_lines, tables
from procurelens.sources.schemas import all_text
from tests.conftest import SMALLEST

QUERIES = registry.all_queries()


def test_the_same_analytics_in_sql():
    assert registry.ON_CLEANED == oracle.cleaned.NAMES


def test_defects_reach_the_analytics(spark):
    found = QUERIES["cleaned_spend_readiness"](spark, SMALLEST).first().asDict()
    assert all(found.values()), found
    whole, kept = (QUERIES[n](spark, SMALLEST).first()["total_spend"] for n in ("spend_kpis", "cleaned_spend_kpis"))
    assert 0 < kept < whole
    mapped, left = order_lines.purchase_orders(spark, SMALLEST), registry.cleaned_model(spark, SMALLEST).fact
    per_status = [{tuple(r) for r in df.groupBy("po_status").agg(F.count_distinct("po_line_id")).collect()}
                  for df in (mapped, left)]
    assert per_status[0] == per_status[1]  # spellings are folded, and every line id is left
    assert left.count() < mapped.count() and left.distinct().count() == left.count()
    assert QUERIES["cleaned_spend_reconciliation"](spark, SMALLEST).collect() != QUERIES["spend_reconciliation"](
        spark, SMALLEST).collect()


def test_staging_is_cleaned_once(spark):
    tables.release(spark)
    for name in ("cleaned_spend_kpis", "cleaned_delivery_overall", "cleaned_fc_monthly_series"):
        QUERIES[name](spark, SMALLEST).collect()
    folder = Path(tables.working_folder(spark).removeprefix("file:"))
    assert len(list(folder.glob("cleaned-lines-*"))) == 1


def test_filters_reach_the_cleaned_table(spark):
    model = registry.cleaned_model(spark, SMALLEST)
    plan = spend.by_category(model)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(po_status)" in plan and "currency" not in plan and "lineitem" not in plan


def test_a_repeated_key_of_a_dimension_fails(spark):
    vendors = order_lines.staging_dimension(order_lines.vendors(spark, SMALLEST))
    model = cleaned.model_from_staging(vendors=lambda: vendors.unionAll(vendors.limit(1)))
    with pytest.raises(PySparkException):
        model.vendors.collect()


def test_empty_staging(spark):
    columns = ["po_line_id", "po_id", "vendor_id", "product_id", "department_id", "order_date", "expected_delivery_date",
               "actual_delivery_date", "quantity", "unit_price", "currency", "po_status"]
    model = cleaned.model_from_staging(fact=lambda: spark.createDataFrame([], all_text(columns)))
    assert model.fact.count() == 0 and spend.kpis(model).first()["po_count"] == 0
