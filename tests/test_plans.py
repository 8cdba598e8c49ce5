"""Physical plans: what has to hold however large the tables are."""

from __future__ import annotations

import re

import pytest

from procurelens import registry
from procurelens.plans import cleaning, pricing, spend, vendor
from procurelens.sources import order_lines
from procurelens.sources.tables import working_set
from tests.conftest import SMALLEST


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def parts(spark):
    return order_lines.procurement_model(spark, SMALLEST)


def test_line_filters_and_columns_reach_the_scan(spark, parts):
    stored = working_set(parts.fact, "plan-test")
    plan = physical(spend.by_category(type(parts)(fact=stored, products=parts.products)))
    assert re.search(r"PushedFilters: \[.*EqualTo\(po_status,Completed\)", plan)
    for schema in re.findall(r"ReadSchema: struct<([^>]*)", plan):
        assert "order_date" not in schema and "po_line_id" not in schema


def test_lines_are_aggregated_before_names_are_joined(parts):
    plan = physical(spend.by_category(parts))
    assert plan.index("product_category") < plan.index("partial_sum")


@pytest.mark.parametrize("query", [spend.by_category, spend.kpis, vendor.concentration,
                                   vendor.top_by_category, spend.monthly])
def test_no_cartesian_no_python_no_line_window(parts, query):
    plan = physical(query(parts))
    assert "CartesianProduct" not in plan and "Python" not in plan
    lines = plan[plan.rfind("HashAggregate"):]
    assert "Window" not in lines


def test_top_k_per_group_is_limited_before_the_shuffle(parts):
    assert "WindowGroupLimit" in physical(vendor.top_by_category(parts))


def test_unused_tables_are_not_opened(spark):
    plan = physical(pricing.price_points(order_lines.procurement_model(spark, SMALLEST, "brand")))
    assert "customer.parquet" not in plan


@pytest.mark.parametrize("name, pushed", [
    ("spend_by_category", r"EqualTo\(o_orderstatus,F\)"), ("spend_kpis", r"EqualTo\(o_orderstatus,F\)"),
    ("spend_ordered_by_year", r"In\(o_orderstatus, \[(F,O|O,F)\]\)"), ("open_aging", r"In\(o_orderstatus, \[(F,O|O,F)\]\)"),
    ("delivery_overall", r"EqualTo\(o_orderstatus,F\)")])
def test_statuses_reach_the_scan_of_the_headers(spark, name, pushed):
    plan = physical(registry.all_queries()[name](spark, SMALLEST))
    assert re.search(rf"PushedFilters: \[[^\]]*{pushed}", plan)
    assert "REPARTITION_BY" not in plan


@pytest.mark.parametrize("name, unread", [
    ("dq_missing_counts", ["customer"]), ("dq_invalid_values", ["customer", "part", "orders"]),
    ("dq_domain_profile", ["customer", "part"]), ("dq_malformed_dates", ["customer"]),
    ("dq_delivery_before_order", ["customer", "part"]), ("dq_conditional_nulls", ["customer", "part"]),
    ("dq_table_counts", ["customer", "part", "orders"]), ("dq_status_mix", ["customer", "part"])])
def test_audits_open_only_tables_they_use(spark, name, unread):
    plan = physical(registry.all_queries()[name](spark, SMALLEST))
    assert not [table for table in unread if f"{table}.parquet" in plan]


def test_cleaning_reads_staging_once(spark):
    staging = order_lines.staging_lines(spark, SMALLEST)
    result = cleaning.clean_fact(staging)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert final.count("lineitem.parquet") == 1 and "ReusedExchange" in final
