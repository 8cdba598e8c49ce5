"""Supplier concentration and sourcing structure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import populations as pop
from ..functions.measures import percent
from ..operators.joins import describe, with_scalar
from ..operators.ranking import ordered_position, top_k
from ..operators.shares import share_of_total
from ..params import PARETO_SHARE
from ..sources.model import ProcurementModel
from ..sources.tables import kept_set
from .spend import spend_by, spend_sum

VENDOR_COLUMNS = ("vendor_name", "vendor_category", "region")


def spend_ranking(model: ProcurementModel) -> DataFrame:
    """Vendors by spend with their share and the cumulative share.

    Equal spend is ordered by a hash of the vendor id, one row at a time.
    """
    totals = model.lines(pop.eligible_spend(), pop.COMPLETED).groupBy("vendor_id").agg(
        spend_sum(), F.count_distinct("po_id").alias("po_count"),
        F.count(F.lit(1)).alias("line_count"))
    known = describe(totals, model.vendors, "vendor_id", VENDOR_COLUMNS)
    placed = ordered_position(known, "spend", ["vendor_id"], running=["spend"])
    return placed.select(
        F.col("position").alias("spend_rank"), "vendor_id", *VENDOR_COLUMNS, "po_count",
        "line_count", "spend",
        percent("spend", "total_spend").alias("pct_of_total"),
        percent("running_spend", "total_spend").alias("cumulative_pct"))


def concentration_of(totals: DataFrame, top: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """Top-n shares and the Herfindahl-Hirschman index of ``(vendor_id, spend)``.

    Only the ``max(top)`` largest vendors are ever ordered; the rest enters
    through two sums.
    """
    value = F.col("spend").cast("double")
    largest = top_k(totals, max(top), [F.desc("spend"), F.asc("vendor_id")]).agg(
        F.sort_array(F.collect_list("spend"), asc=False).alias("_largest"))  # max(top) values
    whole = totals.agg(F.sum("spend").alias("_total"), F.sum(value * value).alias("_squares"))

    def leading(n: int):
        zero = F.lit(0).cast(totals.schema["spend"].dataType)
        summed = F.aggregate(F.slice("_largest", 1, n), zero.cast("decimal(38,4)"),
                             lambda acc, x: (acc + x).cast("decimal(38,4)"))
        return percent(summed, "_total").alias(f"top{n}_pct")

    total = F.col("_total").cast("double")
    return with_scalar(whole, largest).select(
        *[leading(n) for n in top],
        F.round(F.try_divide(F.col("_squares"), total * total) * 10000, 6).alias("hhi"))


def concentration(model: ProcurementModel) -> DataFrame:
    return concentration_of(spend_by(model, "vendor_id"))


def top_by_category(model: ProcurementModel, k: int = 3) -> DataFrame:
    """Leading ``k`` vendors of every product category (RANK: ties share a place)."""
    by_category = describe(spend_by(model, "product_id", "vendor_id"), model.products,
                           "product_id", ["product_category"])
    per_vendor = by_category.groupBy("product_category", "vendor_id").agg(
        F.sum("spend").alias("spend"))
    named = describe(per_vendor, model.vendors, "vendor_id", ["vendor_name"])
    per_name = kept_set(
        named.groupBy("product_category", "vendor_name").agg(F.sum("spend").alias("spend")),
        "category-vendor")
    totals = per_name.groupBy("product_category").agg(F.sum("spend").alias("_total"))
    leaders = top_k(per_name, k, [F.desc("spend")], by=["product_category"], method="rank",
                    out="rank_in_category")
    return leaders.join(totals, "product_category").select(
        "product_category", "rank_in_category", "vendor_name", "spend",
        percent("spend", "_total").alias("pct_of_category"))


def cross_category(model: ProcurementModel) -> DataFrame:
    """Completed lines whose product lies outside the vendor's own category."""
    pairs = (model.lines(pop.has_status(pop.COMPLETED), pop.COMPLETED).groupBy("product_id", "vendor_id")
             .agg(F.count(F.lit(1)).alias("lines")))
    named = describe(describe(pairs, model.products, "product_id", ["product_category"]),
                     model.vendors, "vendor_id", ["vendor_category"])
    foreign = F.when(F.col("vendor_category") != F.col("product_category"), F.col("lines"))
    return named.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("completed_lines"),
        F.coalesce(F.sum(foreign), F.lit(0)).alias("cross_category_lines"))


def _product_sourcing(model: ProcurementModel) -> DataFrame:
    pairs = spend_by(model, "product_id", "vendor_id")
    return pairs.groupBy("product_id").agg(
        F.count("vendor_id").alias("n_vendors"), F.min("vendor_id").alias("vendor_id"),
        F.sum("spend").alias("spend"))


def vendor_count_distribution(model: ProcurementModel) -> DataFrame:
    """How many products have one, two, three ... vendors, and their spend."""
    counted = kept_set(
        _product_sourcing(model).groupBy("n_vendors").agg(
            F.count(F.lit(1)).alias("products"), F.sum("spend").alias("spend")),
        "vendor-counts")
    return share_of_total(counted, "spend", "pct_of_spend")


def single_source_products(model: ProcurementModel, n: int = 10) -> DataFrame:
    """Largest products bought from exactly one vendor."""
    single = _product_sourcing(model).where(F.col("n_vendors") == 1)
    named = describe(describe(single, model.products, "product_id",
                              ["product_name", "product_category"]),
                     model.vendors, "vendor_id", ["vendor_name"])
    return top_k(named, n, [F.desc("spend"), F.asc("product_id")]).select(
        "product_id", "product_name", "product_category", "vendor_name", "spend")


def pareto_count(model: ProcurementModel, threshold: float = PARETO_SHARE) -> DataFrame:
    """How many of the largest vendors it takes to reach a share of spend."""
    placed = ordered_position(spend_by(model, "vendor_id"), "spend", ["vendor_id"],
                              running=["spend"])
    before = F.col("running_spend") - F.col("spend")
    reached = F.try_divide(before.cast("double"), F.col("total_spend").cast("double"))
    return placed.agg(F.count(F.lit(1)).alias("vendors"),
                      F.count_if(reached < threshold).alias("vendors_to_threshold"))
