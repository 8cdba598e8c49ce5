"""Opportunity sizing, supplier scorecard, quadrants and tail spend.

Everything here is a candidate for investigation. The gap of a flagged pair is a
ceiling; the recovery rates and the scorecard weights are assumptions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import populations as pop
from ..functions.measures import band, percent, ratio
from ..operators.joins import describe, with_scalar
from ..operators.ranking import ordered_position, top_k
from ..operators.shares import minmax_score, share_of_total
from ..params import OpportunityParams, PriceParams, ScoreWeights
from ..sources.model import ProcurementModel
from ..sources.schemas import PAIRS_EXPORT, SCORECARD_EXPORT
from ..sources.tables import conform, kept_set
from . import open_orders
from .delivery import avg_days_late, delivery_base, on_time_pct
from .pricing import PriceBase, comparable_pairs, priced_pairs
from .vendor import VENDOR_COLUMNS

DEFAULTS = OpportunityParams()

# Labels of the bands and segments.
ABOVE, AT, BELOW = "Above benchmark", "At benchmark", "Below benchmark"
WEAK, MID, STRONG = "Weak (<70%)", "Mid (70-85%)", "Strong (85%+)"
HEAD, TAIL = "Head (top 80% of spend)", "Tail (bottom 20% of spend)"


@dataclass(frozen=True)
class OpportunityBase:
    """Working sets: all product-vendor pairs, and delivery counts per vendor."""

    model: ProcurementModel
    pairs: DataFrame
    delivery: DataFrame
    params: OpportunityParams = DEFAULTS

    @classmethod
    def build(cls, model: ProcurementModel,
              params: OpportunityParams = DEFAULTS) -> OpportunityBase:
        return cls(model, kept_set(priced_pairs(PriceBase.build(model)), "pairs"),
                   kept_set(delivery_base(model), "delivery"), params)

    def flagged(self) -> DataFrame:
        """Pairs with enough lines whose price index exceeds the flag."""
        limits = PriceParams(min_lines=self.params.min_lines,
                             pair_min_lines=self.params.pair_min_lines)
        return comparable_pairs(self.pairs, limits).where(
            ratio("spend", "bench_spend") > self.params.high)


def price_band(index: str | Column, params: OpportunityParams = DEFAULTS) -> Column:
    return band(index, ((">", params.high, ABOVE), ("<", params.low, BELOW)), AT)


def delivery_band(rate: str | Column, params: OpportunityParams = DEFAULTS) -> Column:
    return band(rate, (("<", params.weak, WEAK), (">=", params.strong, STRONG)), MID)


def weights_check(params: OpportunityParams, base: OpportunityBase) -> DataFrame:
    """The weight total (always 1: the dataclass enforces it) beside the vendors it scores."""
    return vendor_metrics(base).agg(F.count(F.lit(1)).alias("vendors")).withColumn(
        "weight_total", F.lit(params.weights.total))


def reconciliation(base: OpportunityBase) -> DataFrame:
    """Totals that have to tie to the spend and delivery analyses."""
    spend = base.pairs.agg(F.sum("spend").alias("total_spend"))
    delivery = base.delivery.agg(*[F.sum(c).alias(c) for c in (
        "delivery_lines", "on_time_lines", "late_lines", "late_days")])
    return with_scalar(spend, delivery).select(
        "total_spend", "delivery_lines", on_time_pct(1).alias("on_time_pct"),
        avg_days_late(1).alias("avg_days_late"))


def _money(value: str | Column, alias: str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, 2).alias(alias)


def _at_rate(value: str, rate: float) -> Column:
    return F.col(value) * F.lit(rate).cast("decimal(4,2)")


def summary(base: OpportunityBase) -> DataFrame:
    """Flagged pairs, the gap ceiling and the three recovery scenarios."""
    found = base.flagged().agg(
        F.count(F.lit(1)).alias("flagged_pairs"),
        F.count_distinct("vendor_id").alias("vendors"),
        F.count_distinct("product_id").alias("products"),
        F.sum("spend").alias("_spend"), F.sum("gap").alias("_gap"))
    total = base.pairs.agg(F.sum("spend").alias("_total"))
    rates = base.params.rates
    return with_scalar(found, total).select(
        "flagged_pairs", "vendors", "products",
        _money("_spend", "spend_in_flagged_pairs"), _money("_gap", "gap_ceiling"),
        _money(_at_rate("_gap", rates.low), "savings_low"),
        _money(_at_rate("_gap", rates.base), "savings_base"),
        _money(_at_rate("_gap", rates.high), "savings_high"),
        percent("_gap", "_total", 2).alias("ceiling_pct_of_total_spend"))


def _gap_sums(base: OpportunityBase, count: str) -> list[Column]:
    gap = F.sum("gap")
    rate = F.lit(base.params.rates.base).cast("decimal(4,2)")
    return [F.count(F.lit(1)).alias(count), F.round(F.sum("spend"), 2).alias("spend"),
            F.round(gap, 2).alias("gap_ceiling"), F.round(gap * rate, 2).alias("savings_base")]


def by_vendor(base: OpportunityBase) -> DataFrame:
    """Vendors with the largest gap, next to their punctuality."""
    sums = base.flagged().groupBy("vendor_id").agg(*_gap_sums(base, "flagged_products"))
    named = describe(sums, base.model.vendors, "vendor_id", ["vendor_name"]).join(
        base.delivery, "vendor_id")
    order = [F.desc("gap_ceiling"), F.asc("vendor_id")]
    return top_k(named, base.params.top_vendors, order).select(
        "vendor_id", "vendor_name", "flagged_products", "spend", "gap_ceiling", "savings_base",
        on_time_pct(1).alias("on_time_pct"))


def by_category(base: OpportunityBase) -> DataFrame:
    named = describe(base.flagged(), base.model.products, "product_id", ["product_category"])
    return named.groupBy("product_category").agg(*_gap_sums(base, "flagged_pairs"))


def reliability_adjusted(base: OpportunityBase) -> DataFrame:
    """Base savings without vendors whose premium may be buying reliability."""
    rated = base.flagged().join(base.delivery, "vendor_id").where(
        on_time_pct() < base.params.strong)
    return rated.agg(F.sum("gap").alias("_gap")).select(
        _money(_at_rate("_gap", base.params.rates.base), "savings_base_excl_reliable_vendors"))


def vendor_metrics(base: OpportunityBase) -> DataFrame:
    """Per vendor: spend, share, price index, delivery, both bands.

    Vendors without a single delivery line cannot be scored and are left out.
    """
    priced = base.pairs.where(F.col("product_lines") >= base.params.min_lines).groupBy(
        "vendor_id").agg(F.sum("spend").alias("spend"), F.sum("bench_spend").alias("_bench"))
    rated = priced.join(base.delivery, "vendor_id").select(
        "vendor_id", "spend", ratio("spend", "_bench").alias("price_index"),
        on_time_pct().alias("on_time_pct"),
        F.coalesce(avg_days_late(), F.lit(0.0)).alias("avg_days_late"))
    settled = kept_set(rated, "vendor-metrics")
    total = settled.agg(F.sum("spend").alias("_total"))
    return with_scalar(settled, total).select(
        "vendor_id", "spend", ratio("spend", "_total").alias("spend_share"), "price_index",
        "on_time_pct", "avg_days_late",
        price_band("price_index", base.params).alias("price_band"),
        delivery_band("on_time_pct", base.params).alias("delivery_band"))


def scored(metrics: DataFrame, weights: ScoreWeights = ScoreWeights()) -> DataFrame:
    """Min-max scores (0-100, 100 = best) and the weighted composite."""
    scores = minmax_score(metrics, {
        "s_ontime": ("on_time_pct", "high"), "s_late": ("avg_days_late", "low"),
        "s_price": ("price_index", "low"), "s_conc": ("spend_share", "low")})
    composite = (F.col("s_ontime") * weights.on_time + F.col("s_late") * weights.late
                 + F.col("s_price") * weights.price + F.col("s_conc") * weights.concentration)
    return scores.withColumn("composite", composite)


def scored_vendors(base: OpportunityBase) -> DataFrame:
    return scored(vendor_metrics(base), base.params.weights)


def scorecard(base: OpportunityBase) -> DataFrame:
    """Vendors ranked by composite score (ties share a rank)."""
    placed = ordered_position(scored_vendors(base), "composite", ["vendor_id"])
    named = describe(placed, base.model.vendors, "vendor_id", ["vendor_name"])
    return named.select(
        F.col("tie_rank").alias("score_rank"), "vendor_id", "vendor_name",
        F.round("composite", 1).alias("composite_score"),
        F.round(F.col("spend").cast("double") / 1e6, 2).alias("spend_millions"),
        F.round(F.col("spend_share") * 100.0, 2).alias("spend_share_pct"),
        F.round("on_time_pct", 1).alias("on_time_pct"),
        F.round("avg_days_late", 1).alias("avg_days_late"),
        F.round("price_index", 4).alias("price_index"), "price_band", "delivery_band")


def quadrants_of(metrics: DataFrame) -> DataFrame:
    grouped = metrics.groupBy("price_band", "delivery_band").agg(
        F.count(F.lit(1)).alias("vendors"), F.sum("spend").alias("spend"))
    total = metrics.agg(F.sum("spend").alias("_total"))
    return with_scalar(grouped, total).select(
        "price_band", "delivery_band", "vendors", _money("spend", "spend"),
        percent("spend", "_total", 1).alias("pct_of_spend"))


def quadrants(base: OpportunityBase) -> DataFrame:
    """Price band against delivery band."""
    return quadrants_of(vendor_metrics(base))


def quadrant_vendors(base: OpportunityBase, price: str = ABOVE,
                     delivery: str = WEAK) -> DataFrame:
    """The vendors of one cell, by default dear and unpunctual."""
    cell = vendor_metrics(base).where(
        (F.col("price_band") == price) & (F.col("delivery_band") == delivery))
    return describe(cell, base.model.vendors, "vendor_id", ["vendor_name"]).select(
        "vendor_id", "vendor_name", _money("spend", "spend"),
        F.round("price_index", 4).alias("price_index"),
        F.round("on_time_pct", 1).alias("on_time_pct"))


def open_aging(model: ProcurementModel, params: OpportunityParams = DEFAULTS) -> DataFrame:
    """Aging of open lines at the reference date, including lines not due yet."""
    return open_orders.aging(model, params.as_of, include_not_due=True)


def open_largest(model: ProcurementModel, params: OpportunityParams = DEFAULTS) -> DataFrame:
    return open_orders.largest_overdue(model, params.as_of, params.top_open_lines)


def tail_spend_of(totals: DataFrame, threshold: float) -> DataFrame:
    """Split ``(vendor_id, spend)`` into the head that reaches ``threshold`` and the tail."""
    placed = ordered_position(totals, "spend", ["vendor_id"], running=["spend"])
    before = ratio(F.col("running_spend") - F.col("spend"), "total_spend")
    return placed.groupBy(F.when(before >= threshold, TAIL).otherwise(HEAD).alias("segment")).agg(
        F.count(F.lit(1)).alias("vendors"), F.sum("spend").alias("_spend"),
        F.max("total_spend").alias("_total"),
    ).select("segment", "vendors", _money("_spend", "spend"),
             percent("_spend", "_total", 1).alias("pct_of_spend"),
             _money(F.col("_spend") / F.col("vendors"), "avg_spend_per_vendor"))


def tail_spend(model: ProcurementModel, params: OpportunityParams = DEFAULTS) -> DataFrame:
    totals = model.lines(pop.eligible_spend(), pop.COMPLETED).groupBy("vendor_id").agg(
        F.sum(pop.line_spend()).alias("spend"))
    return tail_spend_of(totals, params.tail_share)


def headline_row(base: OpportunityBase) -> DataFrame:
    """All headline figures as one row."""
    weak, dear = F.col("delivery_band") == WEAK, F.col("price_band") == ABOVE

    def spend_if(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("spend")).otherwise(0))

    vendors = vendor_metrics(base).agg(
        F.count_if(weak).alias("weak_vendors"),
        spend_if(weak).alias("_weak_spend"), F.sum("spend").alias("_spend"),
        F.count_if(weak & dear).alias("dear_weak_vendors"),
        spend_if(weak & dear).alias("_dear_weak_spend"))
    gaps = base.flagged().agg(F.count(F.lit(1)).alias("flagged_pairs"),
                              F.coalesce(F.sum("gap"), F.lit(0)).alias("_gap"))
    total = base.pairs.agg(F.sum("spend").alias("_total"))
    rates = base.params.rates
    return with_scalar(with_scalar(total, gaps), vendors).select(
        _money("_total", "total_spend"), "flagged_pairs", _money("_gap", "gap_ceiling"),
        _money(_at_rate("_gap", rates.low), "savings_low"),
        _money(_at_rate("_gap", rates.base), "savings_base"),
        _money(_at_rate("_gap", rates.high), "savings_high"), "weak_vendors",
        percent("_weak_spend", "_spend", 2).alias("weak_spend_pct"), "dear_weak_vendors",
        _money("_dear_weak_spend", "dear_weak_spend"))


# Wording of the headline metrics, by column of ``headline_row``.
HEADLINES = {
    "total_spend": "Total completed spend ($)",
    "flagged_pairs": "Flagged vendor-product pairs (count)",
    "gap_ceiling": "Price-leakage ceiling ($)",
    "savings_low": "Savings low, 25% realization ($)",
    "savings_base": "Savings base, 50% realization ($)",
    "savings_high": "Savings high, 75% realization ($)",
    "weak_vendors": "Vendors under 70% on-time (count)",
    "weak_spend_pct": "Spend with vendors under 70% on-time (% of spend)",
    "dear_weak_vendors": "Vendors above benchmark AND under 70% on-time (count)",
    "dear_weak_spend": "Spend with those vendors ($)",
}


def headlines(base: OpportunityBase) -> DataFrame:
    """The headline figures as ``(metric, value)`` rows."""
    entries = F.array(*[
        F.struct(F.lit(label).alias("metric"), F.col(column).cast("double").alias("value"))
        for column, label in HEADLINES.items()])
    return headline_row(base).select(F.explode(entries).alias("e")).select("e.*")


def export_scorecard(base: OpportunityBase) -> DataFrame:
    """One row per scored vendor, also those without a flagged pair."""
    gaps = base.flagged().groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("flagged_products"), F.sum("gap").alias("gap_ceiling"))
    full = describe(scored_vendors(base), base.model.vendors, "vendor_id",
                    VENDOR_COLUMNS).join(gaps, "vendor_id", "left")
    return conform(full.select(
        *VENDOR_COLUMNS, "spend", (F.col("spend_share") * 100.0).alias("spend_share_pct"),
        "price_index", "on_time_pct", "avg_days_late", "price_band", "delivery_band",
        F.col("composite").alias("composite_score"),
        F.coalesce("flagged_products", F.lit(0)).alias("flagged_products"),
        F.coalesce("gap_ceiling", F.lit(0)).alias("gap_ceiling")), SCORECARD_EXPORT)


def export_pairs(base: OpportunityBase) -> DataFrame:
    """One row per flagged pair."""
    named = describe(describe(base.flagged(), base.model.vendors, "vendor_id", ["vendor_name"]),
                     base.model.products, "product_id", ["product_name", "product_category"])
    rated = named.join(base.delivery, "vendor_id")
    return conform(rated.select(
        "vendor_name", "product_name", "product_category", "lines", "spend",
        ratio("spend", "bench_spend").alias("price_index"),
        F.col("gap").alias("gap_to_median"), on_time_pct().alias("vendor_on_time_pct")),
        PAIRS_EXPORT)


def min_vendors_sensitivity(base: OpportunityBase) -> DataFrame:
    """Gap by how many vendors stand behind the median, with the scenarios.

    A median over two vendors is a midpoint, so its gaps are weak evidence.
    """
    sourcing = base.pairs.groupBy("product_id").agg(F.count("vendor_id").alias("n_vendors"))
    least = base.params.min_vendors
    segment = F.when(F.col("n_vendors") >= least, f"{least}+ vendors").otherwise(
        f"under {least} vendors")
    grouped = base.flagged().join(sourcing, "product_id").groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("flagged_pairs"), F.sum("gap").alias("gap"))
    rates = base.params.rates
    return share_of_total(grouped, "gap", "pct_of_gap").select(
        "segment", "flagged_pairs", _money("gap", "gap_ceiling"),
        _money(_at_rate("gap", rates.low), "savings_low"),
        _money(_at_rate("gap", rates.base), "savings_base"),
        _money(_at_rate("gap", rates.high), "savings_high"), "pct_of_gap")


def price_delivery_correlation(base: OpportunityBase) -> DataFrame:
    """Pearson r between vendor price index and on-time rate."""
    return correlation_of(vendor_metrics(base))


def correlation_of(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count(F.lit(1)).alias("vendors"),
        F.round(F.corr("price_index", "on_time_pct"), 6).alias("pearson_r"))
