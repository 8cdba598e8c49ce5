"""Named analytics on hand-made lines: one trap per test."""

from __future__ import annotations

import shutil
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from procurelens.params import ForecastParams, OpportunityParams, PriceParams, ScoreWeights
from procurelens.plans import (
    cleaning,
    delivery,
    forecast,
    open_orders,
    opportunity,
    pricing,
    quality,
    savings_model,
    spend,
    vendor,
)
from procurelens.sources import schemas, tables
from procurelens.sources.calendar import build_calendar, covering_calendar
from procurelens.sources.model import ProcurementModel
from procurelens.sources.schemas import PAIRS_EXPORT, all_text
from tests.conftest import day, line, one, rows

COLUMNS = list(quality.LINE_COLUMNS)


def staged(spark, *overrides):
    """Staging rows; each dict overrides a sound line."""
    sound = dict(zip(COLUMNS, ("L1", "PO1", "V1", "P1", "D1", "2025-02-01", "2025-02-20",
                               "2025-02-13", "5", "10.00", "USD", "Completed")))
    return spark.createDataFrame(
        [tuple({**sound, **o}[c] for c in COLUMNS) for o in overrides], all_text(COLUMNS))


def test_cleaning_keeps_the_sound_version(spark):
    staging = staged(
        spark, {}, {},                                            # exact copy
        {"po_line_id": "L2"}, {"po_line_id": "L2", "unit_price": ""},          # blank price
        {"po_line_id": "L3", "order_date": "2025-02-10"},
        {"po_line_id": "L3", "order_date": "2025-02-10", "actual_delivery_date": "2025-02-08"},
        {"po_line_id": "L4", "quantity": None, "order_date": "2024-13-45"},    # unique: stays
        {"po_line_id": "L5", "quantity": "1"}, {"po_line_id": "L5", "quantity": "2"},
        {"po_line_id": "L6", "unit_price": ""},
        {"po_line_id": "L6", "unit_price": "", "quantity": ""})                # all faulty
    clean = cleaning.clean_fact(staging)
    assert rows(clean, "po_line_id", "quantity", "unit_price", "order_date") == rows(
        spark.createDataFrame([
            ("L1", Decimal("5"), Decimal("10"), day("2025-02-01")),
            ("L2", Decimal("5"), Decimal("10"), day("2025-02-01")),
            ("L3", Decimal("5"), Decimal("10"), day("2025-02-10")),
            ("L4", None, Decimal("10"), None),
            ("L5", Decimal("1"), Decimal("10"), day("2025-02-01")),
            ("L5", Decimal("2"), Decimal("10"), day("2025-02-01")),
            ("L6", Decimal("5"), None, day("2025-02-01")),
        ], "a string, b decimal(10,2), c decimal(10,2), d date"))
    again = cleaning.clean_fact(clean.select(*[F.col(c).cast("string") for c in COLUMNS]))
    assert rows(again) == rows(clean)
    assert rows(quality.id_collisions(staging), "po_line_id") == [
        ("L2",), ("L3",), ("L5",), ("L6",)]


def test_cleaning_folds_spellings(spark):
    staging = staged(spark, *[
        {"po_line_id": f"L{i}", "currency": c, "po_status": s} for i, (c, s) in enumerate(
            [("usd", "completed"), (" USD", "COMPLETED"), ("US Dollar", "Completed "),
             ("Usd", "Canceled"), ("USD", "OPEN")])])
    clean = cleaning.clean_fact(staging)
    assert rows(clean.select("currency").distinct()) == [("USD",)]
    assert rows(clean, "po_line_id", "po_status") == [
        ("L0", "Completed"), ("L1", "Completed"), ("L2", "Completed"), ("L3", "Cancelled"),
        ("L4", "Open")]


def test_a_hot_line_id_is_reduced_before_the_shuffle(spark):
    staging = spark.range(2000).select(*[
        (F.col("id").cast("string") if c == "po_id" else F.lit({
            "po_line_id": "hot", "order_date": "2025-01-01", "expected_delivery_date": "2025-01-02",
            "quantity": "", "unit_price": "1"}.get(c, "x"))).alias(c) for c in COLUMNS])
    assert rows(cleaning.clean_fact(staging), "po_line_id", "po_id") == [("hot", "0")]


def test_audit_counts(spark):
    staging = staged(spark, {}, {"unit_price": " "}, {"quantity": None}, {"unit_price": "-1"},
                     {"quantity": "0"}, {"order_date": "2024-13-45"}, {"order_date": ""},
                     {"actual_delivery_date": "2025-01-01"})
    assert rows(quality.missing_counts(staging)) == [
        ("expected_delivery_date", 0), ("quantity", 1), ("unit_price", 1)]
    assert one(quality.invalid_values(staging)) == {
        "negative_unit_price": 1, "zero_or_negative_quantity": 1}
    assert rows(quality.malformed_dates(staging))[1] == ("expected_delivery_date", 0)
    assert ("order_date", 1) in rows(quality.malformed_dates(staging))
    assert one(quality.delivery_before_order(staging)) == {"delivery_before_order": 1}


def test_undated_lines_count_in_totals_only(model):
    m = model([line(1), line(2, order=None, price="7"), line(3, order="2025-03-01", price="20"),
               line(4, price="0"), line(5, quantity=None), line(6, status="Open")])
    assert one(spend.kpis(m))["total_spend"] == 37
    assert one(spend.reconciliation(m))["spend_with_missing_order_date"] == 7
    assert one(spend.reconciliation_check(m))["pass"]
    assert rows(spend.yearly(m), "order_year", "yoy_pct_change") == [(2024, None), (2025, 100.0)]
    assert one(spend.readiness(m)) == {
        "completed_lines": 5, "missing_qty_or_price": 1, "zero_or_negative_qty": 0,
        "zero_or_negative_price": 1, "missing_order_date": 1}


def test_empty_fact(model):
    m = model([line(1, status="Cancelled")])
    assert one(spend.kpis(m))["avg_po_value"] is None
    assert one(delivery.overall(m))["on_time_pct"] is None
    assert rows(vendor.spend_ranking(m)) == []
    assert rows(pricing.index_bands(pricing.PriceBase.build(m))) == []


def test_po_value_median(model):
    m = model([line(1, po="A", price="1"), line(2, po="A", price="2"), line(3, po="B", price="10")])
    assert one(spend.po_value_stats(m)) == {
        "po_count": 2, "mean_po_value": 6.5, "median_po_value": Decimal("6.5")}


def test_vendor_ranking_with_ties(model):
    m = model([line(1, "V1"), line(2, "V2"), line(3, "V3", price="20")])
    got = vendor.spend_ranking(m)
    assert rows(got, "spend_rank", "cumulative_pct") == [(1, 50.0), (2, 75.0), (3, 100.0)]
    assert one(vendor.concentration(m))["top1_pct"] == 50.0
    assert one(vendor.pareto_count(m))["vendors_to_threshold"] == 3


def test_delivery_population_and_lateness(model):
    m = model([line(1), line(2, actual="2024-01-23"), line(3, actual="2024-02-09"),
               line(4, expected=None), line(5, actual="2024-01-09"),
               line(6, order=None, price="0"), line(7, vendor="V2", status="Open", actual=None)])
    got = one(delivery.overall(m))
    assert (got["delivery_lines"], got["on_time_pct"], got["avg_days_late"],
            got["max_days_late"]) == (4, 50.0, 11.5, 20)
    assert sum(r[1] for r in rows(delivery.lateness_buckets(m))) == 4
    card = {r["vendor_id"]: r for r in delivery.scorecard(m).collect()}
    assert card["V2"]["on_time_pct"] is None and card["V2"]["spend"] is None
    assert card["V1"]["delivery_lines"] == 4 and card["V1"]["spend"] == 50
    never_late = one(delivery.overall(model([line(1)])))
    assert never_late["avg_days_late"] is None


def test_calendar_gap(model):
    m = model([line(1), line(2, expected="2026-02-01", actual="2026-01-15")])
    assert one(delivery.calendar_gap(m))["lines_lost"] == 1
    assert len(rows(delivery.by_month(m))) == 2


def test_open_aging(model):
    m = model([line(i, status="Open", expected=e, actual=None) for i, e in enumerate(
        ["2025-12-31", "2025-12-30", "2025-11-30", "2025-09-30", "2025-01-01", None])]
        + [line(9, actual="2025-12-31")])
    full = dict(r[:2] for r in rows(open_orders.aging(m, date(2025, 12, 31), True)))
    assert [full[k] for k in sorted(full)] == [1, 1, 1, 1, 1]
    by_data = dict(r[:2] for r in rows(open_orders.aging(m)))
    assert sum(by_data.values()) == 4 and "0. Not yet due" not in by_data
    assert one(open_orders.overdue_concentration(m))["top_pct"] == 100.0
    assert len(rows(open_orders.largest_overdue(m, date(2025, 12, 31), 2))) == 2


LOOSE = PriceParams(min_lines=2, pair_min_lines=1)


@pytest.fixture
def priced(model):
    m = model([line(1, "V1", "P1", price="8"), line(2, "V2", "P1", price="12", quantity="3"),
               line(3, "V1", "P1", price="10", order="2025-01-01"),
               line(4, "V1", "P2", price="5"), line(5, "V2", "P1", price="99", status="Open")])
    return m, pricing.PriceBase.build(m)


def test_benchmark_and_variance(priced):
    m, base = priced
    benchmarks = {r["product_id"]: (r["benchmark_price"], r["product_lines"])
                  for r in base.products.collect()}
    assert benchmarks == {"P1": (10, 3), "P2": (5, 1)}
    ppv = one(pricing.ppv_overall(base, LOOSE))
    assert (ppv["net_ppv"], ppv["unfavorable_ppv"], ppv["favorable_ppv"]) == (4, 6, -2)
    assert ppv["net_ppv"] == ppv["unfavorable_ppv"] + ppv["favorable_ppv"]
    assert one(pricing.coverage(base, LOOSE))["lines_in_thin_products"] == 1
    by_vendor = {r["vendor_id"]: r["price_index"]
                 for r in pricing.ppv_by_vendor(base, m, LOOSE).collect()}
    assert by_vendor == {"V1": 0.9, "V2": 1.2}
    line_level = pricing.price_base(m)
    assert one(line_level.agg(F.sum("ppv").alias("s")))["s"] == 4


def test_vendor_effect_needs_a_contested_product(priced):
    m, base = priced
    got = {r["vendor_id"]: r for r in pricing.vendor_effect(base, m, LOOSE).collect()}
    assert got["V1"]["products_compared"] == 1
    assert got["V2"]["products_above_high"] == 1 and got["V1"]["products_below_low"] == 1


def test_year_adjusted_and_volume(priced):
    m, base = priced
    got = {r["vendor_id"]: r["net_ppv_year_median"]
           for r in pricing.year_adjusted(base, m, LOOSE).collect()}
    assert got == {"V1": Decimal("-2"), "V2": Decimal("6")}  # medians 10 (2024) and 10 (2025)
    tiers = rows(pricing.volume_effect(m, base, LOOSE), "qty_tier", "lines")
    assert tiers == [(1, 1), (2, 1), (3, 1)]


def test_opportunity_end_to_end(priced, spark):
    m, _ = priced
    params = OpportunityParams(min_lines=1, pair_min_lines=1, as_of=date(2025, 12, 31))
    base = opportunity.OpportunityBase.build(m, params)
    got = one(opportunity.summary(base))
    assert (got["flagged_pairs"], got["gap_ceiling"], got["savings_low"]) == (
        1, Decimal("6.00"), Decimal("1.50"))
    metrics = opportunity.vendor_metrics(base)
    assert one(metrics.agg(F.sum("spend_share").alias("s")))["s"] == pytest.approx(1.0)
    pairs, vendors = opportunity.export_pairs(base), opportunity.export_scorecard(base)
    assert {r["flagged_products"] for r in vendors.collect()} == {0, 1}
    assert all(r["pass"] for r in savings_model.checks(base, pairs, vendors).collect())
    thin = opportunity.OpportunityBase.build(m, OpportunityParams(min_lines=2, pair_min_lines=1))
    failed = savings_model.checks(thin, pairs, opportunity.export_scorecard(thin)).where("NOT pass")
    assert rows(failed, "check", "difference") == [("total_spend", -5.0)]  # P2 is too thin to score
    tracker = spark.createDataFrame(
        [("Vendor V2 | Product P1", "Realized", Decimal("2")), ("gone", "Rejected", Decimal("0"))],
        "key string, status string, realized_savings decimal(18,2)")
    assert rows(savings_model.tracker_variance(tracker, pairs, params), "key", "variance") == [
        ("Vendor V2 | Product P1", Decimal("-1.0000")), ("gone", None)]
    with pytest.raises(Exception, match="flagged pairs: key .* is no key: 2 rows"):
        savings_model.tracker_variance(tracker, pairs.union(pairs), params).collect()
    months = spend.months_in_data(m)
    switched = {(r["scenario"], r["metric"]): r["value"]
                for r in savings_model.scenarios(pairs, vendors, months, params).collect()}
    assert {s for s, _ in switched} == {"Low", "Base", "High"}
    assert [switched[s, "selected"] for s in ("Low", "Base", "High")] == [1.5, 3.0, 4.5]
    assert switched["High", "low"] == switched["Low", "selected"] == 1.5
    span = one(months)["months"]
    assert switched["High", "annualised"] == pytest.approx(4.5 * 12 / span)
    path = tables.working_path(spark, "test-export")
    tables.write_export(pairs, path)
    assert rows(tables.read_export(spark, path, PAIRS_EXPORT)) == rows(pairs)
    assert len(rows(opportunity.headlines(base))) == 10


def test_one_vendor_has_no_score(model):
    m = model([line(i, price=str(10 + i)) for i in range(3)])
    base = opportunity.OpportunityBase.build(m, OpportunityParams(min_lines=1, pair_min_lines=1))
    assert rows(opportunity.scorecard(base), "score_rank", "composite_score") == [(1, None)]


def series(spark, values, start="2024-01-01"):
    first = day(start)
    data = [(date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1),
             None if v is None else Decimal(v), i + 1) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "month_start date, ordered_spend decimal(18,2), idx int")


def test_forecast_methods(spark):
    base = forecast.ForecastBase.from_series(series(spark, range(1, 25)))
    by_key = {(r["train_end"], r["horizon"]): r for r in base.forecasts.collect()}
    assert sorted({k[0] for k in by_key}) == [12, 18, 24]
    early, late = by_key[12, 1], by_key[24, 6]
    assert (early["naive_last"], early["ma3"], early["ma6"], early["mean_all"],
            early["seasonal_naive"], early["seasonal_growth"], early["actual"]) == (
        12, 11, 9.5, 6.5, 1, None, 13)
    assert late["target_month"] == day("2026-06-01") and late["purpose"] == "final"
    assert late["seasonal_naive"] == 18
    assert late["seasonal_growth"] == pytest.approx(18 * sum(range(19, 25)) / sum(range(7, 13)))
    months = {r["method"]: r["months"] for r in forecast.accuracy_pooled(base).collect()}
    assert months["ma6"] == 12 and months["seasonal_growth"] == 6
    chosen = one(forecast.select_method(base))
    assert chosen["method"] == "naive_last"  # seasonal_growth was not tested at every origin
    final = forecast.final_forecast(base).collect()
    assert all(r["low_band"] <= r["forecast"] <= r["high_band"] for r in final)
    explicit = forecast.forecasts(series(spark, range(1, 25)),
                                  ForecastParams(origins=(12, 18, 24)))
    assert rows(explicit) == rows(base.forecasts)


def test_forecast_with_a_gap_month(spark):
    values = [10] * 24
    values[22] = None
    got = forecast.forecasts(series(spark, values)).where("train_end = 24 AND horizon = 1")
    row = one(got)
    assert row["naive_last"] == 10 and row["ma3"] is None and row["ma6"] is None


def test_series_uses_month_arithmetic(model):
    m = model([line(1), line(2, order="2024-04-02", status="Open", actual=None),
               line(3, order=None)])
    got = forecast.monthly_series(m)
    assert rows(got, "idx", "ordered_spend") == [
        (1, Decimal("10")), (2, None), (3, None), (4, Decimal("10"))]
    assert one(forecast.series_checks(got))["months_if_no_gaps"] == 4


def test_calendar(spark):
    days = build_calendar(spark, date(2024, 1, 1), date(2025, 12, 31))
    assert days.count() == 731
    last = {r["date"]: r for r in days.where("date >= '2025-12-29'").collect()}
    assert last[day("2025-12-29")]["week"] == 1
    block = build_calendar(spark, date(2025, 12, 29), date(2025, 12, 29), "block")
    assert one(block)["week"] == 52


def test_calendar_covers_the_data(model, spark):
    m = model([line(1, order="2024-03-10"), line(2, order="2002-02-03"), line(3, order=None)])
    covered = covering_calendar(m.fact, "order_date")
    assert one(covered.agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n"))) == {
        "a": day("2002-01-01"), "b": day("2024-03-31"), "n": 8126}
    assert covering_calendar(m.fact.limit(0), "order_date").collect() == []
    whole = ProcurementModel(fact=m.fact, calendar=covered)
    assert rows(spend.yearly(whole), "order_year", "spend") == [(2002, Decimal("10")), (2024, Decimal("10"))]
    assert one(spend.reconciliation_check(whole))["pass"]


@pytest.mark.parametrize("clean, row", [
    (cleaning.clean_vendor, (" V1", "Vendor", "Tools", "North", "2020-01-01", "Active")),
    (cleaning.clean_product, ("P1 ", "Saw", "Tools", "Hand", "9", "Each")),
    (cleaning.clean_department, ("D1", "Ops", "Core")),
    (cleaning.clean_calendar, ("2024-01-01", "2024", "Q1", "1", "January", "2024-01", "1", "Monday"))])
def test_cleaned_dimensions_have_unique_keys(spark, clean, row):
    schema = {6: schemas.VENDORS if row[0] == " V1" else schemas.PRODUCTS, 3: schemas.DEPARTMENTS, 8: schemas.CALENDAR}[len(row)]
    staged = spark.createDataFrame([row], all_text(schema.names))
    assert clean(staged).count() == 1
    again = spark.createDataFrame([row, (f" {row[0].strip()}  ", *row[1:])], all_text(schema.names))
    with pytest.raises(Exception, match="is no key: 2 rows"):
        clean(again).collect()


def test_working_sets_are_found_again_until_the_files_change(spark, tmp_path):
    path = str(tmp_path / "t")

    def plan():
        return spark.read.schema("x long").parquet(path).where("x > 1").groupBy("x").count()

    spark.range(5).withColumnRenamed("id", "x").write.parquet(path)
    first = tables.kept_set(plan(), "numbers")
    assert tables.kept_set(plan(), "numbers").inputFiles() == first.inputFiles()
    other = spark.read.schema("x long").parquet(path).where("x > 2").groupBy("x").count()
    assert tables.kept_set(other, "numbers").count() == 2
    spark.range(9).withColumnRenamed("id", "x").write.mode("overwrite").parquet(path)
    second = tables.kept_set(plan(), "numbers")
    assert second.inputFiles() != first.inputFiles() and second.count() == 7
    folder = Path(tables.working_folder(spark))
    assert list(folder.glob("numbers-*"))
    shutil.rmtree(second.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])  # gone by other hands
    assert tables.kept_set(plan(), "numbers").count() == 7
    tables.release(spark)
    assert not folder.exists()
    assert tables.kept_set(plan(), "numbers").count() == 7


def test_price_reports_share_one_set_of_points(priced, spark):
    m, _ = priced
    tables.release(spark)
    for report in (pricing.ppv_overall, pricing.index_bands, pricing.top_variation):
        report(pricing.PriceBase.build(m), LOOSE).collect()
    folder = Path(tables.working_folder(spark))
    assert len(list(folder.glob("price-points-*"))) == len(list(folder.glob("benchmarks-*"))) == 1


def test_parameters_validate():
    with pytest.raises(ValueError):
        ScoreWeights(on_time=0.5)
    with pytest.raises(ValueError):
        ForecastParams(horizon=13)
    with pytest.raises(ValueError):
        OpportunityParams(scenario="Best")
