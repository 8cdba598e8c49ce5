"""Every named analytic as ``(spark, folder) -> DataFrame`` over the driver tables.

Results are normalised for comparison: decimals become double, dates text,
integers bigint. The brand is the product wherever pairs or benchmarks need
enough lines per product; elsewhere a product is a part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType

from .params import OpportunityParams
from .plans import (
    cleaned,
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
from .sources import order_lines as source
from .sources import tables
from .sources.model import ProcurementModel
from .sources.schemas import PAIRS_EXPORT

Query = Callable[..., DataFrame]
EXPECTED, DEPARTMENT = "expected_delivery_date", "department_id"
OPPORTUNITY = OpportunityParams(as_of=source.REPORT_DATE)
COMPARED_YEARS = (1999, 2000)
#: Analytics that are also registered over the cleaned lines, where defects are left to meet.
ON_CLEANED = (
    "spend_readiness", "spend_kpis", "spend_yoy", "spend_by_category", "spend_by_department", "spend_reconciliation",
    "spend_reconciliation_check", "spend_completed_vs_open", "spend_status_lines_by_month",
    "vendor_spend_ranking", "vendor_top3_by_category", "delivery_readiness", "delivery_overall", "vendor_delivery_scorecard",
    "open_aging", "open_overdue_by_vendor", "price_coverage", "ppv_overall", "ppv_by_vendor", "price_volume_effect",
    "opp_summary", "opp_scorecard", "opp_scenarios", "fc_monthly_series", "fc_final",
)


def present(df: DataFrame) -> DataFrame:
    def plain(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("long")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def _on_model(plan: Callable[[ProcurementModel], DataFrame], grain: str = "part",
              need: tuple[str, ...] = ()) -> Query:
    return lambda spark, folder, model_of=source.procurement_model: plan(model_of(spark, folder, grain, need))


def _on_staging(plan: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """``columns``: those the plan reads, if it does not read all."""
    named = columns or quality.LINE_COLUMNS
    return lambda spark, folder: plan(source.staging_lines(spark, folder, named))


def _on_prices(plan: Callable[..., DataFrame], with_model: bool = False) -> Query:
    def run(spark: SparkSession, folder: str, model_of=source.procurement_model) -> DataFrame:
        model = model_of(spark, folder, "brand")
        base = pricing.PriceBase.build(model)
        return plan(base, model) if with_model else plan(base)

    return run


def _opportunity_base(spark: SparkSession, folder: str,
                      model_of=source.procurement_model) -> opportunity.OpportunityBase:
    model = model_of(spark, folder, "brand", (EXPECTED,))
    return opportunity.OpportunityBase.build(model, OPPORTUNITY)


def _on_opportunity(plan: Callable[[opportunity.OpportunityBase], DataFrame]) -> Query:
    return lambda spark, folder, *model_of: plan(_opportunity_base(spark, folder, *model_of))


def _on_exports(plan: Callable[..., DataFrame]) -> Query:
    """Plans that start from the two exported tables."""
    def run(spark: SparkSession, folder: str, *model_of) -> DataFrame:
        base = _opportunity_base(spark, folder, *model_of)
        pairs = tables.kept_set(opportunity.export_pairs(base), "export-pairs")
        vendors = tables.kept_set(opportunity.export_scorecard(base), "export-vendors")
        return plan(base, pairs, vendors)

    return run


def _on_series(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder, model_of=source.procurement_model: plan(
        forecast.monthly_series(model_of(spark, folder)))


def _on_forecast(plan: Callable[[forecast.ForecastBase], DataFrame]) -> Query:
    return lambda spark, folder, model_of=source.procurement_model: plan(
        forecast.ForecastBase.build(model_of(spark, folder)))


def cleaned_model(spark: SparkSession, folder: str, grain: str = "part",
                  need: Iterable[str] = ()) -> ProcurementModel:
    """Staging with its defects, cleaned: the same model as ``source.procurement_model``, whatever is needed of it."""
    def dimension(name: str):
        return lambda: _staged_dimensions(spark, folder, grain)[name]

    return cleaned.model_from_staging(
        fact=lambda: source.staging_lines(spark, folder, grain=grain),
        **{name: dimension(name) for name in ("vendors", "products", "departments", "calendar")})


def _staged_dimensions(spark: SparkSession, folder: str, grain: str = "part") -> dict[str, DataFrame]:
    return {
        "vendors": source.staging_dimension(source.vendors(spark, folder)),
        "products": source.staging_dimension(source.products(spark, folder, grain)),
        "departments": source.staging_dimension(source.departments(spark, folder)),
        "calendar": source.staging_dimension(source.calendar(spark, folder)),
    }


def dimension_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dimension_checks(_staged_dimensions(spark, folder), {
        "vendors": {"vendor_start_date": "date"},
        "products": {"standard_cost": "decimal(10,2)"},
        "calendar": {"date": "date", "year": "int", "month": "int", "week": "int"},
    })


def _clean_dim(name: str, clean: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: clean(_staged_dimensions(spark, folder)[name])


def _order_days(spark: SparkSession, folder: str) -> DataFrame:
    orders = source.open_table(spark, folder, "orders")
    return orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count("o_orderkey").alias("orders"))


def clean_date(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned calendar with the orders placed on each day."""
    days = cleaning.clean_calendar(_staged_dimensions(spark, folder)["calendar"])
    return days.join(_order_days(spark, folder), "date", "left").fillna({"orders": 0})


def week_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per seven-day block and ISO week, the two week definitions side by side."""
    blocks = source.calendar(spark, folder, "block").select(
        "date", "year", F.col("week").alias("week_block"))
    iso = source.calendar(spark, folder).select("date", F.col("week").alias("iso_week"))
    days = blocks.join(iso, "date").join(_order_days(spark, folder), "date")
    return days.groupBy("year", "week_block", "iso_week").agg(F.sum("orders").alias("orders"))


def calendar_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Days without any order between the first and the last order day."""
    return quality.calendar_gaps(_order_days(spark, folder))


def collision_survivors(staging: DataFrame) -> DataFrame:
    return cleaning.clean_fact(staging).groupBy("po_line_id").agg(
        F.count(F.lit(1)).alias("rows_kept"))


def badness_profile(staging: DataFrame) -> DataFrame:
    return cleaning.deduplicate(cleaning.with_badness(staging)).groupBy("badness_score").agg(
        F.count(F.lit(1)).alias("lines"))


def staging_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Write staging as CSV, read it back as text, profile it."""
    path = tables.working_path(spark, "staging-csv")
    tables.write_staging(source.staging_lines(spark, folder), path)
    staged = tables.read_staging(spark, path, list(quality.LINE_COLUMNS))
    clean = quality.p.clean_text
    return staged.groupBy(clean("po_status").alias("po_status"),
                          clean("currency").alias("currency")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(quality.p.is_missing("quantity")).alias("missing_quantity"),
        F.sum(quality.p.parse_decimal("unit_price")).alias("price_sum"))


def cleaned_table(spark: SparkSession, folder: str) -> DataFrame:
    """Rebuild the cleaned table partitioned by order month and read it back."""
    path = tables.working_path(spark, "cleaned")
    fact = cleaning.clean_fact(source.staging_lines(spark, folder)).withColumn(
        "order_month", F.date_format("order_date", "yyyy-MM"))
    tables.write_table(fact, path, "order_month")
    return tables.read_table(spark, path, fact.schema).groupBy("order_month").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"))


def export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Export the flagged pairs, reload them typed, add the lookup key."""
    path = tables.working_path(spark, "export")
    tables.write_export(opportunity.export_pairs(_opportunity_base(spark, folder)), path)
    return savings_model.with_key(tables.read_export(spark, path, PAIRS_EXPORT))


def _tracker(pairs: DataFrame) -> DataFrame:
    """A tracker as a buyer would keep it, derived from the flagged pairs."""
    done = F.col("lines") >= 12
    realised = F.when(done, F.round(F.col("gap_to_median") * F.lit(0.4).cast("decimal(4,1)"), 2))
    return savings_model.with_key(pairs).select(
        "key", F.when(done, "Realized").otherwise("Negotiating").alias("status"),
        F.coalesce(realised, F.lit(0)).cast("decimal(18,2)").alias("realized_savings"))


def _checks(base, pairs, vendors) -> DataFrame:
    return savings_model.checks(base, pairs, vendors).withColumn(
        "difference", F.round("difference", 6))


def _metrics(base) -> DataFrame:
    scored = opportunity.scored_vendors(base)
    return scored.select(*[
        F.round(c, 9).alias(c) if c.startswith("s_") else F.col(c)
        for c in scored.columns if c != "composite"])


def _lower_case_matrix(model: ProcurementModel) -> DataFrame:
    matrix = spend.affinity_matrix(model)
    return matrix.withColumnsRenamed({c: c.lower() for c in matrix.columns})


def thin_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage by part: most parts have too few lines for a stable median."""
    base = pricing.PriceBase.build(source.procurement_model(spark, folder))
    return pricing.coverage(base, pricing.PriceParams(min_lines=10))


def all_queries() -> dict[str, Query]:
    dates, everything = (EXPECTED,), (EXPECTED, DEPARTMENT)
    raw: dict[str, Query] = {
        # data quality
        "dq_exact_duplicates": _on_staging(quality.exact_duplicates),
        "dq_missing_counts": _on_staging(
            quality.missing_counts, "unit_price", "quantity", EXPECTED),
        "dq_invalid_values": _on_staging(
            quality.invalid_values, "unit_price", "quantity"),
        "dq_domain_profile": _on_staging(
            quality.domain_profile, "currency", "po_status"),
        "dq_malformed_dates": _on_staging(
            quality.malformed_dates, *quality.DATE_COLUMNS),
        "dq_delivery_before_order": _on_staging(
            quality.delivery_before_order, "order_date", "actual_delivery_date"),
        "dq_id_collisions": _on_staging(quality.id_collisions),
        "dq_orphan_keys": _on_model(quality.orphan_keys, need=(DEPARTMENT,)),
        "dq_dimension_checks": dimension_checks,
        "dq_calendar_gaps": calendar_gaps,
        "dq_conditional_nulls": _on_staging(
            quality.conditional_nulls, "po_status", "actual_delivery_date"),
        "dq_table_counts": _on_staging(
            quality.table_counts, "po_id"),
        "dq_status_mix": _on_staging(
            quality.status_mix, "po_status"),
        # cleaning, sources and sinks
        "clean_dedup": _on_staging(cleaning.deduplicate),
        "clean_badness": _on_staging(badness_profile),
        "clean_collisions": _on_staging(collision_survivors),
        "clean_fact": _on_staging(cleaning.clean_fact),
        "clean_department": _clean_dim("departments", cleaning.clean_department),
        "clean_vendor": _clean_dim("vendors", cleaning.clean_vendor),
        "clean_product": _clean_dim("products", cleaning.clean_product),
        "clean_date": clean_date,
        "build_calendar": week_blocks,
        "io_staging_csv": staging_csv,
        "io_cleaned_table": cleaned_table,
        "io_export_roundtrip": export_roundtrip,
        # spend
        "spend_readiness": _on_model(spend.readiness),
        "spend_kpis": _on_model(spend.kpis),
        "spend_yoy": _on_model(spend.yearly),
        "spend_monthly": _on_model(spend.monthly),
        "spend_by_department": _on_model(spend.by_department, need=(DEPARTMENT,)),
        "spend_by_category": _on_model(spend.by_category),
        "spend_top_subcategories": _on_model(spend.top_subcategories),
        "spend_category_year": _on_model(spend.category_by_year),
        "spend_reconciliation": _on_model(spend.reconciliation),
        "spend_reconciliation_check": _on_model(spend.reconciliation_check),
        "spend_completed_vs_open": _on_model(spend.completed_vs_open),
        "spend_ordered_by_year": _on_model(spend.ordered_by_year),
        "spend_po_value_stats": _on_model(spend.po_value_stats),
        "spend_dept_category_affinity": _on_model(spend.department_category_affinity,
                                                  need=(DEPARTMENT,)),
        "spend_affinity_matrix": _on_model(_lower_case_matrix, need=(DEPARTMENT,)),
        "spend_status_lines_by_month": _on_model(spend.status_lines_by_month),
        # vendors, delivery, open lines
        "delivery_readiness": _on_model(delivery.readiness, need=dates),
        "vendor_spend_ranking": _on_model(vendor.spend_ranking),
        "vendor_concentration": _on_model(vendor.concentration),
        "vendor_top3_by_category": _on_model(vendor.top_by_category),
        "vendor_cross_category": _on_model(vendor.cross_category),
        "product_vendor_count_distribution": _on_model(vendor.vendor_count_distribution),
        "single_source_products": _on_model(vendor.single_source_products),
        "delivery_overall": _on_model(delivery.overall, need=dates),
        "vendor_delivery_scorecard": _on_model(delivery.scorecard, need=dates),
        "delivery_by_category": _on_model(
            lambda m: delivery.delivery_by(m, "product_category"), need=dates),
        "delivery_by_department": _on_model(
            lambda m: delivery.delivery_by(m, "department"), need=everything),
        "delivery_by_region": _on_model(lambda m: delivery.delivery_by(m, "region"), need=dates),
        "delivery_lateness_buckets": _on_model(delivery.lateness_buckets, need=dates),
        "delivery_by_month": _on_model(delivery.by_month, need=dates),
        "delivery_calendar_gap": _on_model(delivery.calendar_gap, need=dates),
        "open_aging": _on_model(open_orders.aging, need=dates),
        "open_overdue_by_vendor": _on_model(open_orders.overdue_by_vendor, need=dates),
        "open_overdue_concentration": _on_model(open_orders.overdue_concentration, need=dates),
        "vendor_pareto_count": _on_model(vendor.pareto_count),
        "vendor_weak_delivery_share": _on_model(delivery.weak_share, need=dates),
        "vendor_on_time_spread": _on_model(delivery.on_time_spread, need=dates),
        # pricing
        "price_base": _on_model(pricing.price_base, "brand"),
        "price_coverage": _on_prices(pricing.coverage),
        "price_coverage_thin": thin_coverage,
        "price_lines_per_product": _on_model(pricing.lines_per_product, "brand"),
        "price_top_variation": _on_prices(pricing.top_variation),
        "price_index_bands": _on_prices(pricing.index_bands),
        "price_benchmark_comparison": _on_prices(pricing.benchmark_comparison),
        "price_median_vs_standard": _on_prices(pricing.median_vs_standard),
        "ppv_overall": _on_prices(pricing.ppv_overall),
        "ppv_standard_cost": _on_prices(pricing.ppv_standard_cost),
        "ppv_by_vendor": _on_prices(pricing.ppv_by_vendor, with_model=True),
        "ppv_by_category": _on_prices(pricing.ppv_by_category),
        "price_vendor_effect": _on_prices(pricing.vendor_effect, with_model=True),
        "price_volume_effect": _on_prices(lambda b, m: pricing.volume_effect(m, b), True),
        "price_time_effect": _on_prices(pricing.time_effect),
        "price_candidates": _on_prices(pricing.candidates, with_model=True),
        "price_year_adjusted": _on_prices(pricing.year_adjusted, with_model=True),
        # opportunity
        "opp_params_check": _on_opportunity(
            lambda b: opportunity.weights_check(b.params, b)),
        "opp_price_base": _on_prices(pricing.priced_pairs),
        "opp_delivery_base": _on_model(delivery.delivery_base, need=dates),
        "opp_reconciliation": _on_opportunity(opportunity.reconciliation),
        "opp_flagged_pairs": _on_opportunity(lambda b: b.flagged().select(
            "product_id", "vendor_id", "lines", "spend", "bench_spend", "gap")),
        "opp_summary": _on_opportunity(opportunity.summary),
        "opp_by_vendor": _on_opportunity(opportunity.by_vendor),
        "opp_by_category": _on_opportunity(opportunity.by_category),
        "opp_reliability_adjusted": _on_opportunity(opportunity.reliability_adjusted),
        "opp_vendor_metrics": _on_opportunity(_metrics),
        "opp_scorecard": _on_opportunity(opportunity.scorecard),
        "opp_quadrants": _on_opportunity(opportunity.quadrants),
        "opp_quadrant_vendors": _on_opportunity(opportunity.quadrant_vendors),
        "opp_open_aging": _on_model(
            lambda m: opportunity.open_aging(m, OPPORTUNITY), need=dates),
        "opp_open_largest": _on_model(
            lambda m: opportunity.open_largest(m, OPPORTUNITY), need=dates),
        "opp_tail_spend": _on_model(opportunity.tail_spend),
        "opp_headlines": _on_opportunity(opportunity.headlines),
        "opp_export_scorecard": _on_opportunity(opportunity.export_scorecard),
        "opp_export_pairs": _on_opportunity(opportunity.export_pairs),
        "opp_min_vendors_sensitivity": _on_opportunity(
            opportunity.min_vendors_sensitivity),
        "opp_price_delivery_corr": _on_opportunity(opportunity.price_delivery_correlation),
        "opp_scenarios": _on_exports(lambda b, p, v: savings_model.scenarios(
            p, v, spend.months_in_data(b.model), b.params)),
        "opp_tracker_variance": _on_exports(
            lambda b, p, v: savings_model.tracker_variance(_tracker(p), p, b.params)),
        "opp_checks": _on_exports(_checks),
        # forecast
        "fc_monthly_series": _on_series(lambda s: s),
        "fc_series_checks": _on_series(forecast.series_checks),
        "fc_yearly_totals": _on_series(forecast.yearly_totals),
        "fc_changes": _on_series(forecast.changes),
        "fc_seasonal_profile": _on_series(forecast.seasonal_profile),
        "fc_seasonality_corr": _on_series(
            lambda s: forecast.seasonality_correlation(s, *COMPARED_YEARS)),
        "fc_forecasts": _on_forecast(lambda b: b.forecasts.drop("actual")),
        "fc_backtest_detail": _on_forecast(forecast.backtest_detail),
        "fc_accuracy": _on_forecast(forecast.accuracy),
        "fc_accuracy_pooled": _on_forecast(forecast.accuracy_pooled),
        "fc_final": _on_forecast(forecast.final_forecast),
        "fc_final_all_methods": _on_forecast(forecast.final_all_methods),
        "fc_select_method": _on_forecast(forecast.select_method),
        "fc_band_coverage": _on_forecast(forecast.band_coverage),
    }
    return {name: _presented(query) for name, query in raw.items()} | {
        f"cleaned_{name}": _presented(raw[name], cleaned_model) for name in ON_CLEANED}


def _presented(query: Query, *model_of) -> Query:
    return lambda spark, folder: present(query(spark, folder, *model_of))
