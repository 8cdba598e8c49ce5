"""Delivery reliability at PO-line grain.

Delivery KPIs use their own population (valid dates, not valid amounts), and
delivery months come from the delivery date itself, never from a join to a
calendar that may end too early.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import populations as pop
from ..functions.measures import band, days_late, percent, ratio, year_month
from ..operators.joins import describe
from ..operators.shares import share_of_total
from ..params import WEAK_ON_TIME
from ..sources.model import ProcurementModel
from ..sources.tables import kept_set
from .vendor import VENDOR_COLUMNS

# Lateness buckets by days after the expected date.
LATENESS = (("<=", 0, "1. On time or early"), ("<=", 3, "2. 1-3 days late"),
            ("<=", 7, "3. 4-7 days late"), ("<=", 14, "4. 8-14 days late"))
LATENESS_REST = "5. 15+ days late"


def delivery_counts() -> list[Column]:
    """Additive delivery measures; every delivery KPI derives from these."""
    late = days_late() > 0
    return [
        F.count(F.lit(1)).alias("delivery_lines"),
        F.count_if(~late).alias("on_time_lines"),
        F.count_if(late).alias("late_lines"),
        F.sum(F.when(late, days_late()).otherwise(0)).alias("late_days"),
    ]


def rolled_up() -> list[Column]:
    return [F.sum(c).alias(c)
            for c in ("delivery_lines", "on_time_lines", "late_lines", "late_days")]


def on_time_pct(scale: int | None = None) -> Column:
    return percent("on_time_lines", "delivery_lines", scale)


def avg_days_late(scale: int | None = None) -> Column:
    """Mean over late lines only; NULL when nothing was late."""
    return ratio("late_days", "late_lines", scale)


def delivery_base(model: ProcurementModel) -> DataFrame:
    """Additive delivery measures per vendor."""
    return model.lines(pop.eligible_delivery(), pop.COMPLETED).groupBy("vendor_id").agg(*delivery_counts())


def readiness(model: ProcurementModel) -> DataFrame:
    ordered, actual = F.col("order_date"), F.col("actual_delivery_date")
    return model.lines(pop.has_status(pop.COMPLETED), pop.COMPLETED).agg(
        F.count(F.lit(1)).alias("completed_lines"),
        F.count_if(F.col("expected_delivery_date").isNull()).alias("missing_expected"),
        F.count_if(actual.isNull()).alias("missing_actual"),
        F.count_if(actual < ordered).alias("delivery_before_order"),
        F.count_if(pop.plausible_delivery()).alias("valid_delivery_lines"))


def overall(model: ProcurementModel) -> DataFrame:
    measured = model.lines(pop.eligible_delivery(), pop.COMPLETED).agg(
        *delivery_counts(), F.max(days_late()).alias("max_days_late"))
    return measured.select("delivery_lines", on_time_pct().alias("on_time_pct"),
                           avg_days_late().alias("avg_days_late"), "max_days_late")


def vendor_position(model: ProcurementModel) -> DataFrame:
    """Spend and delivery measures per vendor from one pass over Completed lines.

    The two populations stay separate: each measure counts only its own lines,
    and a vendor without any has NULL there.
    """
    counted, late = pop.plausible_delivery(), days_late() > 0
    return model.lines(pop.has_status(pop.COMPLETED), pop.COMPLETED).groupBy("vendor_id").agg(
        F.sum(F.when(pop.valid_amount(), pop.line_spend())).alias("spend"),
        F.nullif(F.count_if(counted), F.lit(0)).alias("delivery_lines"),
        F.count_if(counted & ~late).alias("on_time_lines"),
        F.count_if(counted & late).alias("late_lines"),
        F.sum(F.when(counted & late, days_late()).otherwise(0)).alias("late_days"))


def scorecard(model: ProcurementModel) -> DataFrame:
    """All vendors with spend share and delivery side by side."""
    combined = model.vendors.select("vendor_id", *VENDOR_COLUMNS).join(
        vendor_position(model), "vendor_id", "left")
    shared = share_of_total(kept_set(combined, "vendor-scorecard"), "spend", "pct_of_spend")
    return shared.select("vendor_id", *VENDOR_COLUMNS, "spend", "pct_of_spend", "delivery_lines",
                         on_time_pct().alias("on_time_pct"),
                         avg_days_late().alias("avg_days_late"))


def delivery_by(model: ProcurementModel, label: str) -> DataFrame:
    """Delivery KPIs by ``product_category``, ``department`` or ``region``."""
    key, dim = {
        "product_category": ("product_id", model.products),
        "department": ("department_id", model.departments),
        "region": ("vendor_id", model.vendors),
    }[label]
    per_id = model.lines(pop.eligible_delivery(), pop.COMPLETED).groupBy(key).agg(*delivery_counts())
    grouped = describe(per_id, dim, key, [label]).groupBy(label).agg(*rolled_up())
    return grouped.select(label, "delivery_lines", on_time_pct().alias("on_time_pct"),
                          avg_days_late().alias("avg_days_late"))


def lateness_buckets(model: ProcurementModel) -> DataFrame:
    bucket = band(days_late(), LATENESS, LATENESS_REST).alias("bucket")
    counted = (model.lines(pop.eligible_delivery(), pop.COMPLETED).groupBy(bucket)
               .agg(F.count(F.lit(1)).alias("delivery_lines")))
    return share_of_total(counted, "delivery_lines", "pct_of_lines")


def by_month(model: ProcurementModel) -> DataFrame:
    month = year_month("actual_delivery_date").alias("delivery_month")
    grouped = (model.lines(pop.eligible_delivery(), pop.COMPLETED).groupBy(month).agg(*delivery_counts()))
    return grouped.select("delivery_month", "delivery_lines", on_time_pct().alias("on_time_pct"))


def calendar_gap(model: ProcurementModel) -> DataFrame:
    """Delivery lines an inner join to the calendar would lose."""
    per_day = (model.lines(pop.eligible_delivery(), pop.COMPLETED)
               .groupBy(F.col("actual_delivery_date").alias("date"))
               .agg(F.count(F.lit(1)).alias("lines")))
    lost = per_day.join(model.calendar.select("date"), "date", "left_anti")
    return lost.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("lines_lost"),
                    F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def weak_share(model: ProcurementModel, cutoff: float = WEAK_ON_TIME) -> DataFrame:
    """Vendors under an on-time cutoff and the spend that depends on them."""
    rated = vendor_position(model).where(F.col("spend").isNotNull())
    return weak_share_of(rated.select("spend", on_time_pct().alias("on_time_pct")), cutoff)


def weak_share_of(vendors: DataFrame, cutoff: float = WEAK_ON_TIME) -> DataFrame:
    weak = F.col("on_time_pct") < cutoff
    return vendors.agg(
        F.count_if(weak).alias("vendors"),
        F.sum(F.when(weak, F.col("spend")).otherwise(0)).alias("spend"),
        F.sum("spend").alias("_total"),
    ).select("vendors", "spend", percent("spend", "_total").alias("pct_of_spend"))


def on_time_spread(model: ProcurementModel) -> DataFrame:
    """Range and sample deviation of vendor on-time rates."""
    rates = delivery_base(model).select(on_time_pct().alias("rate"))
    return rates.agg(
        F.count("rate").alias("vendors"), F.min("rate").alias("min_on_time_pct"),
        F.max("rate").alias("max_on_time_pct"),
        F.round(F.stddev_samp("rate"), 6).alias("stddev_on_time_pct"))
