"""Open lines past their expected date.

A pipeline view, not a delivery KPI. ``as_of`` is a date, or None for the latest
Completed delivery in the data (a lower bound for the true snapshot date).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import populations as pop
from ..functions.measures import band, day_literal, percent
from ..operators.joins import describe, with_scalar
from ..operators.ranking import top_k
from ..sources.model import ProcurementModel
from ..sources.tables import kept_set

# Aging buckets by days past the expected date.
NOT_DUE = (("<=", 0, "0. Not yet due"),)
AGING = (("<=", 30, "1. 1-30 days overdue"), ("<=", 90, "2. 31-90 days overdue"),
         ("<=", 180, "3. 91-180 days overdue"))
AGING_REST = "4. 180+ days overdue"


def _with_as_of(model: ProcurementModel, lines: DataFrame, as_of: date | None) -> DataFrame:
    if as_of is not None:
        return lines.withColumn("as_of", day_literal(as_of))
    latest = model.lines(pop.has_status(pop.COMPLETED), pop.COMPLETED).agg(
        F.max("actual_delivery_date").alias("as_of"))
    return with_scalar(lines, latest)


def _overdue_days():
    return F.datediff(F.col("as_of"), F.col("expected_delivery_date"))


def aging(model: ProcurementModel, as_of: date | None = None,
          include_not_due: bool = False) -> DataFrame:
    """Lines and spend per aging bucket, with or without lines not due yet.

    One pass reduces the lines to due days - a calendar's worth of rows - which
    also carry the latest delivery for an ``as_of`` taken from the data.
    """
    open_line, completed = pop.open_with_due_date(), pop.has_status(pop.COMPLETED)
    per_day = model.lines(open_line | completed, pop.COMPLETED, pop.OPEN).groupBy("expected_delivery_date").agg(
        F.count_if(open_line).alias("open_lines"),
        F.sum(F.when(open_line, pop.line_spend())).alias("open_spend"),
        F.max(F.when(completed, F.col("actual_delivery_date"))).alias("_latest"))
    latest = F.max("_latest").over(Window.partitionBy())
    due = per_day.withColumn("as_of", latest if as_of is None else day_literal(as_of)).where(
        F.col("open_lines") > 0)
    if not include_not_due:
        due = due.where(F.col("expected_delivery_date") < F.col("as_of"))
    rules = (*NOT_DUE, *AGING) if include_not_due else AGING
    bucket = band(_overdue_days(), rules, AGING_REST).alias("bucket")
    return due.groupBy(bucket).agg(F.sum("open_lines").alias("open_lines"),
                                   F.sum("open_spend").alias("open_spend"))


def _overdue_per_vendor(model: ProcurementModel, as_of: date | None) -> DataFrame:
    """One pass over the lines, reduced to vendors and due days; only that is read again for ``as_of``."""
    open_line, completed = pop.valid_open(), pop.has_status(pop.COMPLETED)
    if as_of is None:
        lines = model.lines(open_line | completed, pop.COMPLETED, pop.OPEN)
    else:
        lines = model.lines(open_line, pop.OPEN)
    per_day = lines.groupBy("vendor_id", "expected_delivery_date").agg(
        F.count_if(open_line).alias("lines"),
        F.sum(F.when(open_line, pop.line_spend())).alias("spend"),
        F.max(F.when(completed, F.col("actual_delivery_date"))).alias("_latest"))
    if as_of is None:
        per_day = kept_set(per_day, "open-due-days")
        per_day = with_scalar(per_day, per_day.agg(F.max("_latest").alias("as_of")))
    else:
        per_day = per_day.withColumn("as_of", day_literal(as_of))
    overdue = per_day.where((F.col("lines") > 0) & (F.col("expected_delivery_date") < F.col("as_of")))
    return overdue.groupBy("vendor_id").agg(
        F.sum("lines").alias("overdue_open_lines"), F.sum("spend").alias("open_spend_overdue"))


def overdue_by_vendor(model: ProcurementModel, as_of: date | None = None,
                      n: int = 10) -> DataFrame:
    named = describe(_overdue_per_vendor(model, as_of), model.vendors, "vendor_id",
                     ["vendor_name"])
    return top_k(named, n, [F.desc("open_spend_overdue"), F.asc("vendor_id")]).select(
        "vendor_id", "vendor_name", "overdue_open_lines", "open_spend_overdue")


def overdue_concentration(model: ProcurementModel, as_of: date | None = None,
                          n: int = 10) -> DataFrame:
    """Share of overdue open spend held by the ``n`` largest vendors."""
    totals = kept_set(_overdue_per_vendor(model, as_of), "overdue-vendors")
    order = [F.desc("open_spend_overdue"), F.asc("vendor_id")]
    leading = top_k(totals, n, order).agg(F.sum("open_spend_overdue").alias("top_spend"))
    whole = totals.agg(F.sum("open_spend_overdue").alias("overdue_spend"))
    return with_scalar(leading, whole).select(
        "top_spend", "overdue_spend", percent("top_spend", "overdue_spend").alias("top_pct"))


def largest_overdue(model: ProcurementModel, as_of: date | None = None, n: int = 25) -> DataFrame:
    """The largest overdue open lines of known vendors and products."""
    lines = _with_as_of(model, model.lines(pop.valid_open(), pop.OPEN), as_of).where(
        pop.overdue_open(F.col("as_of"))).select(
            "po_id", "po_line_id", "vendor_id", "product_id", "expected_delivery_date",
            _overdue_days().alias("days_overdue"), pop.line_spend().alias("line_value"))
    known = (lines.join(model.vendors.select("vendor_id", "vendor_name"), "vendor_id")
             .join(model.products.select("product_id", "product_name"), "product_id"))
    order = [F.desc("line_value"), F.asc("po_line_id"), F.asc("expected_delivery_date"),
             F.asc("vendor_id"), F.asc("product_id")]
    return top_k(known, n, order).select(
        "po_id", "po_line_id", "vendor_name", "product_name", "expected_delivery_date",
        "days_overdue", "line_value")
