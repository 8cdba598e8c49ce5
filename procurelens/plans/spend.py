"""Spend: how much, when, by whom, on what.

Completed-only spend of the last one or two months is incomplete, because those
orders are not delivered yet; ``completed_vs_open`` and ``ordered_by_year`` show it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import populations as pop
from ..functions.measures import month_number, percent_change, ratio
from ..operators.joins import describe, with_scalar
from ..operators.median import exact_median
from ..operators.ranking import top_k
from ..operators.reshape import open_pivot
from ..operators.shares import share_of_total
from ..sources.model import ProcurementModel
from ..sources.tables import kept_set


def spend_sum(alias: str = "spend") -> Column:
    return F.sum(pop.line_spend()).alias(alias)


def spend_by(model: ProcurementModel, *keys: str) -> DataFrame:
    """Eligible spend per id. Names are joined to this small result, not to the lines."""
    return model.lines(pop.eligible_spend(), pop.COMPLETED).groupBy(*keys).agg(spend_sum())


def _dated(lines: DataFrame, model: ProcurementModel, *columns: str) -> DataFrame:
    """Attach calendar columns by order date; undated lines drop out here."""
    days = model.calendar.select(F.col("date").alias("order_date"), *columns)
    return lines.join(days, "order_date")


def readiness(model: ProcurementModel) -> DataFrame:
    """How many Completed lines the validity rule touches, by reason."""
    quantity, price = F.col("quantity"), F.col("unit_price")
    return model.lines(pop.has_status(pop.COMPLETED), pop.COMPLETED).agg(
        F.count(F.lit(1)).alias("completed_lines"),
        F.count_if(quantity.isNull() | price.isNull()).alias("missing_qty_or_price"),
        F.count_if(quantity <= 0).alias("zero_or_negative_qty"),
        F.count_if(price <= 0).alias("zero_or_negative_price"),
        F.count_if(F.col("order_date").isNull()).alias("missing_order_date"))


def kpis(model: ProcurementModel) -> DataFrame:
    """Headline figures. Vendors are active by purchases, not by their status field."""
    return (model.lines(pop.eligible_spend(), pop.COMPLETED)
            .agg(spend_sum("total_spend"), F.count_distinct("po_id").alias("po_count"),
                 F.count_distinct("vendor_id").alias("active_vendors"))
            .withColumn("avg_po_value", ratio("total_spend", "po_count")))


def yearly(model: ProcurementModel) -> DataFrame:
    """Spend per order year with the change on the year before."""
    per_day = spend_by(model, "order_date")
    per_year = (_dated(per_day, model, "year").groupBy(F.col("year").alias("order_year"))
                .agg(F.sum("spend").alias("spend")))
    previous = F.lag("spend").over(Window.orderBy("order_year"))  # one row per year
    return (per_year.withColumn("prior_year_spend", previous)
            .withColumn("yoy_pct_change", percent_change("spend", "prior_year_spend")))


def monthly(model: ProcurementModel) -> DataFrame:
    lines = model.lines(pop.eligible_spend(), pop.COMPLETED)
    return (_dated(lines, model, "year_month").groupBy("year_month")
            .agg(spend_sum(), F.count_distinct("po_id").alias("po_count")))


def by_department(model: ProcurementModel) -> DataFrame:
    named = describe(spend_by(model, "department_id"), model.departments, "department_id",
                     ["department", "group"])
    grouped = named.groupBy("department", "group").agg(F.sum("spend").alias("spend"))
    return share_of_total(grouped, "spend")


def _by_product(model: ProcurementModel, *columns: str) -> DataFrame:
    named = describe(spend_by(model, "product_id"), model.products, "product_id", columns)
    return named.groupBy(*columns).agg(F.sum("spend").alias("spend"))


def by_category(model: ProcurementModel) -> DataFrame:
    return share_of_total(_by_product(model, "product_category"), "spend")


def top_subcategories(model: ProcurementModel, n: int = 10) -> DataFrame:
    grouped = _by_product(model, "product_category", "subcategory")
    return top_k(grouped, n, [F.desc("spend"), F.asc("product_category"), F.asc("subcategory")])


def category_by_year(model: ProcurementModel) -> DataFrame:
    per_key = spend_by(model, "product_id", "order_date")
    named = describe(_dated(per_key, model, "year"), model.products, "product_id",
                     ["product_category"])
    return (named.groupBy("product_category", F.col("year").alias("order_year"))
            .agg(F.sum("spend").alias("spend")))


def reconciliation(model: ProcurementModel) -> DataFrame:
    """Total spend and the part that no time-based result can contain."""
    undated = F.when(F.col("order_date").isNull(), pop.line_spend()).otherwise(0)
    return model.lines(pop.eligible_spend(), pop.COMPLETED).agg(
        spend_sum("total_spend"), F.sum(undated).alias("spend_with_missing_order_date"))


def reconciliation_check(model: ProcurementModel, tolerance: float = 0.01) -> DataFrame:
    """Yearly spend plus undated spend against the total."""
    totals = reconciliation(model)
    dated = yearly(model).agg(F.sum("spend").alias("dated_spend"))
    summed = with_scalar(totals, dated).select(
        "total_spend", (F.col("dated_spend") + F.col("spend_with_missing_order_date"))
        .alias("sum_of_parts"))
    gap = F.col("sum_of_parts") - F.col("total_spend")
    return summed.select("total_spend", "sum_of_parts", gap.alias("difference"),
                         (F.abs(gap) <= tolerance).alias("pass"))


def completed_vs_open(model: ProcurementModel) -> DataFrame:
    def spend_when(status: str, alias: str) -> Column:
        return F.sum(F.when(pop.has_status(status), pop.line_spend()).otherwise(0)).alias(alias)

    per_day = model.lines(pop.ordered_spend(), pop.COMPLETED, pop.OPEN).groupBy("order_date").agg(
        spend_when(pop.COMPLETED, "completed"), spend_when(pop.OPEN, "open"))
    return _dated(per_day, model, "year_month").groupBy("year_month").agg(
        F.sum("completed").alias("completed_spend"), F.sum("open").alias("open_spend"))


def ordered_by_year(model: ProcurementModel) -> DataFrame:
    per_day = model.lines(pop.ordered_spend(), pop.COMPLETED, pop.OPEN).groupBy("order_date").agg(spend_sum())
    return _dated(per_day, model, "year").groupBy("year").agg(
        F.sum("spend").alias("ordered_spend"))


def po_value_stats(model: ProcurementModel) -> DataFrame:
    """Mean and median value of a purchase order."""
    values = spend_by(model, "po_id").select(F.col("spend").cast("decimal(18,4)").alias("value"))
    per_po = kept_set(values, "po-values")
    mean = per_po.agg(F.count(F.lit(1)).alias("po_count"), F.sum("value").alias("_sum"))
    median = exact_median(per_po, [], "value", "median_po_value")
    return with_scalar(mean, median).select(
        "po_count", ratio("_sum", "po_count").alias("mean_po_value"), "median_po_value")


def department_category_affinity(model: ProcurementModel) -> DataFrame:
    """What each department buys: category spend as a share of the department's."""
    per_key = describe(spend_by(model, "department_id", "product_id"), model.products,
                       "product_id", ["product_category"])
    named = describe(
        per_key.groupBy("department_id", "product_category").agg(F.sum("spend").alias("spend")),
        model.departments, "department_id", ["department"])
    grouped = named.groupBy("department", "product_category").agg(F.sum("spend").alias("spend"))
    return share_of_total(grouped, "spend", "pct_of_department", by="department")


def affinity_matrix(model: ProcurementModel) -> DataFrame:
    """``department_category_affinity`` with one column per category that occurs."""
    return open_pivot(department_category_affinity(model), "department", "product_category",
                      F.first("pct_of_department"))


def months_in_data(model: ProcurementModel) -> DataFrame:
    """Calendar months from the first to the last order that counts as spend, as one row."""
    dated = model.lines(pop.eligible_spend(), pop.COMPLETED)
    span = month_number(F.max("order_date")) - month_number(F.min("order_date")) + 1
    return dated.agg(span.alias("months"))


def status_lines_by_month(model: ProcurementModel) -> DataFrame:
    """Lines ordered per month and how many of them are still open."""
    per_day = model.fact.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(pop.has_status(pop.OPEN)).alias("open"))
    return _dated(per_day, model, "year_month").groupBy("year_month").agg(
        F.sum("lines").alias("total_lines"), F.sum("open").alias("open_lines"))
