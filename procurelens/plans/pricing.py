"""Price variance against the product median.

The benchmark of a product is the median unit price over all eligible lines.
``price_index`` is price / benchmark (spend-weighted for groups), PPV is
(price - benchmark) * quantity; positive means paid above the median. A price
gap is a reason to investigate, not a confirmed overpayment.

Scale: the benchmark is constant per product, so a sum of ``benchmark *
quantity`` equals the benchmark times the summed quantity. Lines are therefore
reduced to *price points* (product, vendor, order year, price) once, and every
report joins the benchmark to aggregates, never to lines. All money stays
decimal up to the final ratio.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import populations as pop
from ..functions.measures import band, percent, ratio
from ..operators.joins import describe
from ..operators.median import exact_median
from ..operators.ranking import tile_totals, top_k
from ..params import PriceParams
from ..sources.model import ProcurementModel
from ..sources.tables import kept_result, kept_set

# Bands of the line price index.
INDEX_BANDS = (("<", 0.50, "1. below 0.50"), ("<", 0.80, "2. 0.50-0.80"),
               ("<", 0.95, "3. 0.80-0.95"), ("<=", 1.05, "4. 0.95-1.05 (near median)"),
               ("<=", 1.20, "5. 1.05-1.20"), ("<=", 2.00, "6. 1.20-2.00"))
INDEX_BANDS_REST = "7. above 2.00"

PRODUCT_COLUMNS = ("product_name", "product_category", "standard_cost", "unit_of_measure")
DEFAULTS = PriceParams()


def price_points(model: ProcurementModel) -> DataFrame:
    """Eligible lines per product, vendor, order year and exact price."""
    return model.lines(pop.eligible_spend(), pop.COMPLETED).groupBy(
        "product_id", "vendor_id", F.year("order_date").alias("order_year"), "unit_price",
    ).agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"))


def point_spend() -> Column:
    return F.col("unit_price") * F.col("quantity")


def benchmarks(points: DataFrame, *keys: str) -> DataFrame:
    """Median price and line count per product (or per further ``keys``)."""
    return exact_median(points, ["product_id", *keys], "unit_price", "benchmark_price",
                        weight="lines", count_out="product_lines")


@dataclass(frozen=True)
class PriceBase:
    """Working sets behind all price reports.

    ``points``: see ``price_points``; ``products``: one row per product with benchmark,
    line count and the descriptive columns. Both are written once per version of the
    lines, however many reports are built on them, and joins go by their real size.
    """

    points: DataFrame
    products: DataFrame

    @classmethod
    def build(cls, model: ProcurementModel) -> PriceBase:
        points = kept_set(price_points(model), "price-points")
        named = model.products.select("product_id", *PRODUCT_COLUMNS)
        return cls(points, kept_result(lambda: benchmarks(points).join(named, "product_id"),
                                       "benchmarks", points, named))

    def covered(self, params: PriceParams) -> DataFrame:
        """Products with enough lines for a stable median."""
        return self.products.where(F.col("product_lines") >= params.min_lines)

    def totals(self, *keys: str) -> DataFrame:
        """Lines, quantity and spend of the points, by ``keys``."""
        return self.points.groupBy(*keys).agg(
            F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"),
            F.sum(point_spend()).alias("spend"))


def bench_spend() -> Column:
    return (F.col("benchmark_price") * F.col("quantity")).alias("bench_spend")


def price_base(model: ProcurementModel) -> DataFrame:
    """Line-level working set: every eligible line with its benchmark measures.

    The benchmark table is written, so Spark broadcasts it only if its
    measured size allows and otherwise merges by product with skew handling.
    """
    benchmarked = PriceBase.build(model).products
    lines = model.lines(pop.eligible_spend(), pop.COMPLETED).select(
        "po_line_id", "vendor_id", "product_id", "order_date", "quantity", "unit_price",
        pop.line_spend().alias("line_spend"))
    joined = lines.join(benchmarked.select(
        "product_id", "benchmark_price", "product_lines", "standard_cost"), "product_id")
    over = F.col("unit_price") - F.col("benchmark_price")
    return joined.select(
        "*", ratio("unit_price", "benchmark_price").alias("price_index"),
        (over * F.col("quantity")).alias("ppv"),
        bench_spend().alias("benchmark_spend"),
        ((F.col("unit_price") - F.col("standard_cost")) * F.col("quantity")).alias("std_ppv"))


def coverage(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    per_product = base.totals("product_id").join(
        base.products.select("product_id", "product_lines"), "product_id")
    thin = F.when(F.col("product_lines") < params.min_lines, F.col("lines")).otherwise(0)
    return per_product.agg(
        F.sum("lines").alias("valid_completed_lines"), F.sum("spend").alias("total_spend"),
        F.count(F.lit(1)).alias("products"), F.sum(thin).alias("lines_in_thin_products"))


def lines_per_product(model: ProcurementModel, params: PriceParams = DEFAULTS) -> DataFrame:
    """Is the median stable enough? One pass, no benchmark needed."""
    counted = model.lines(pop.eligible_spend(), pop.COMPLETED).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"))
    known = counted.join(model.products.select("product_id"), "product_id")
    return known.agg(
        F.min("n").alias("min_lines"), F.max("n").alias("max_lines"),
        F.sum("n").alias("_sum"), F.count("n").alias("_products"),
        F.count_if(F.col("n") < params.min_lines).alias("products_below_min"),
    ).select("min_lines", "max_lines", ratio("_sum", "_products").alias("avg_lines"),
             "products_below_min")


def top_variation(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    """Products whose prices vary most (coefficient of variation)."""
    price, weight = F.col("unit_price"), F.col("lines").cast("decimal(18,0)")
    moments = base.points.groupBy("product_id").agg(
        F.sum("lines").alias("lines"), F.count_distinct("vendor_id").alias("vendors"),
        F.min("unit_price").alias("min_price"), F.max("unit_price").alias("max_price"),
        F.sum(price * weight).alias("_sum"), F.sum(price * price * weight).alias("_squares"))
    joined = moments.join(base.covered(params).select(
        "product_id", "product_name", "product_category", "benchmark_price"), "product_id")
    n, total = F.col("lines").cast("double"), F.col("_sum").cast("double")
    mean = total / n
    variance = F.try_divide(F.col("_squares").cast("double") - total * mean, n - 1)
    deviation = F.sqrt(F.greatest(variance, F.lit(0.0)))
    measured = joined.select(
        "product_id", "product_name", "product_category", "lines", "vendors", "benchmark_price",
        "min_price", "max_price",
        ratio("max_price", "benchmark_price", 2).alias("max_to_median"),
        F.round(F.try_divide(deviation, mean), 3).alias("cv"))
    return top_k(measured, params.variation_n, [F.desc("cv"), F.asc("product_id")])


def _priced_points(base: PriceBase, params: PriceParams, *columns: str) -> DataFrame:
    return base.points.join(base.covered(params).select(
        "product_id", "benchmark_price", *columns), "product_id")


def index_bands(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    bucket = band(ratio("unit_price", "benchmark_price"), INDEX_BANDS, INDEX_BANDS_REST)
    return _priced_points(base, params).groupBy(bucket.alias("price_index_band")).agg(
        F.sum("lines").alias("lines"), F.sum(point_spend()).alias("spend"))


def benchmark_comparison(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    """Spend against the median benchmark and against standard cost."""
    per_product = base.totals("product_id").join(base.covered(params), "product_id")
    cost = F.col("standard_cost")
    unusable = F.when(cost.isNull() | (cost <= 0), F.col("lines")).otherwise(0)
    summed = per_product.agg(
        F.sum("spend").alias("_spend"), F.sum(bench_spend()).alias("_bench"),
        F.sum(cost * F.col("quantity")).alias("_std"),
        F.sum(unusable).alias("lines_without_usable_standard"))
    return summed.select(
        ratio("_spend", "_bench", 4).alias("spend_to_median_index"),
        ratio("_spend", "_std", 4).alias("spend_to_standard_index"),
        "lines_without_usable_standard")


def median_vs_standard(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    """Products whose median is furthest from the standard cost."""
    quotient = ratio("benchmark_price", "standard_cost")
    measured = base.covered(params).select(
        "product_id", "product_name", "unit_of_measure", "standard_cost",
        F.col("benchmark_price").alias("median_price"),
        F.round(quotient, 3).alias("median_to_standard"), F.abs(quotient - 1).alias("_gap"))
    order = [F.desc_nulls_last("_gap"), F.asc("product_id")]
    return top_k(measured, params.variation_n, order).drop("_gap")


def variance_sums(variance: Column) -> list[Column]:
    """Net, unfavourable (> 0) and favourable (< 0) sums of a variance column."""
    return [F.sum(variance).alias("net"),
            F.sum(F.when(variance > 0, variance).otherwise(0)).alias("unfavorable"),
            F.sum(F.when(variance < 0, variance).otherwise(0)).alias("favorable")]


def _ppv() -> Column:
    return (F.col("unit_price") - F.col("benchmark_price")) * F.col("quantity")


def ppv_overall(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    summed = _priced_points(base, params).agg(
        *variance_sums(_ppv()), F.sum(point_spend()).alias("spend"))
    return summed.select(
        F.col("net").alias("net_ppv"), F.col("unfavorable").alias("unfavorable_ppv"),
        F.col("favorable").alias("favorable_ppv"), "spend",
        percent("unfavorable", "spend", 2).alias("unfavorable_ppv_pct_of_spend"))


def ppv_standard_cost(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    """The same totals against standard cost, where there is a usable one."""
    priced = _priced_points(base, params, "standard_cost").where(F.col("standard_cost") > 0)
    variance = (F.col("unit_price") - F.col("standard_cost")) * F.col("quantity")
    summed = priced.agg(*variance_sums(variance), F.sum(point_spend()).alias("spend"))
    return summed.select(
        F.col("net").alias("net_std_ppv"), F.col("unfavorable").alias("unfavorable_std_ppv"),
        F.col("favorable").alias("favorable_std_ppv"),
        percent("unfavorable", "spend", 2).alias("unfavorable_std_ppv_pct_of_spend"))


def _ppv_by(priced: DataFrame, key: str) -> DataFrame:
    return priced.groupBy(key).agg(
        F.sum("lines").alias("lines"), F.sum(point_spend()).alias("spend"),
        F.sum(bench_spend()).alias("_bench"), *variance_sums(_ppv()),
    ).select(key, "lines", "spend", ratio("spend", "_bench", 4).alias("price_index"),
             F.col("net").alias("net_ppv"), F.col("unfavorable").alias("unfavorable_ppv"))


def ppv_by_vendor(base: PriceBase, model: ProcurementModel,
                  params: PriceParams = DEFAULTS) -> DataFrame:
    return describe(_ppv_by(_priced_points(base, params), "vendor_id"), model.vendors,
                    "vendor_id", ["vendor_name"])


def ppv_by_category(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    return _ppv_by(_priced_points(base, params, "product_category"), "product_category")


def priced_pairs(base: PriceBase) -> DataFrame:
    """Every product-vendor pair with spend, benchmark spend and the net gap."""
    pairs = base.totals("product_id", "vendor_id").join(base.products.select(
        "product_id", "product_lines", "benchmark_price"), "product_id")
    return pairs.select(
        "product_id", "vendor_id", "product_lines", "lines", "quantity", "spend", bench_spend(),
        (F.col("spend") - F.col("benchmark_price") * F.col("quantity")).alias("gap"))


def comparable_pairs(pairs: DataFrame, params: PriceParams) -> DataFrame:
    """Pairs with enough lines, on products with a stable median."""
    return pairs.where((F.col("product_lines") >= params.min_lines)
                       & (F.col("lines") >= params.pair_min_lines))


def vendor_effect(base: PriceBase, model: ProcurementModel,
                  params: PriceParams = DEFAULTS) -> DataFrame:
    """On how many of its contested products is a vendor dear or cheap?

    Contested: at least two vendors with enough lines each.
    """
    pairs = comparable_pairs(priced_pairs(base), params).select(
        "product_id", "vendor_id", ratio("spend", "bench_spend").alias("index"))
    contested = (pairs.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") >= 2).select("product_id"))
    compared = pairs.join(contested, "product_id", "left_semi")
    counted = compared.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("products_compared"),
        F.count_if(F.col("index") > params.high).alias("products_above_high"),
        F.count_if(F.col("index") < params.low).alias("products_below_low"))
    return describe(counted, model.vendors, "vendor_id", ["vendor_name"]).withColumn(
        "pct_products_above_high", percent("products_above_high", "products_compared", 1))


def volume_effect(model: ProcurementModel, base: PriceBase,
                  params: PriceParams = DEFAULTS) -> DataFrame:
    """Price index by quantity tier: do larger orders get lower prices?

    Tiles are per product by quantity; ties follow a hash of line id and price.
    """
    lines = model.lines(pop.eligible_spend(), pop.COMPLETED).select(
        "product_id", "po_line_id", "quantity", "unit_price")
    covered = lines.join(base.covered(params).select("product_id"), "product_id", "left_semi")
    per_product = tile_totals(
        covered, params.tiers, ["product_id"], "quantity", ["po_line_id", "unit_price"],
        {"quantity_sum": F.col("quantity"), "spend": pop.line_spend()}, "qty_tier")
    per_product = per_product.withColumnRenamed("quantity_sum", "quantity")
    priced = per_product.join(base.products.select("product_id", "benchmark_price"), "product_id")
    return priced.groupBy("qty_tier").agg(
        F.sum("lines").alias("lines"), F.sum("quantity").alias("_quantity"),
        F.sum("spend").alias("_spend"), F.sum(bench_spend()).alias("_bench"),
    ).select("qty_tier", "lines", ratio("_quantity", "lines").alias("avg_quantity"),
             ratio("_spend", "_bench", 4).alias("price_index"))


def time_effect(base: PriceBase, params: PriceParams = DEFAULTS) -> DataFrame:
    """Price index per order year; drift would distort a multi-year median."""
    per_year = base.totals("product_id", "order_year").where(F.col("order_year").isNotNull())
    priced = per_year.join(base.covered(params), "product_id")
    return priced.groupBy("order_year").agg(
        F.sum("lines").alias("lines"), F.sum("spend").alias("_spend"),
        F.sum(bench_spend()).alias("_bench"),
    ).select("order_year", "lines", ratio("_spend", "_bench", 4).alias("price_index"))


def candidates(base: PriceBase, model: ProcurementModel,
               params: PriceParams = DEFAULTS) -> DataFrame:
    """Vendor-product pairs priced above the benchmark, largest net PPV first."""
    pairs = comparable_pairs(priced_pairs(base), params).withColumn(
        "_index", ratio("spend", "bench_spend"))
    dear = pairs.where(F.col("_index") > params.high)
    named = describe(dear, model.vendors, "vendor_id", ["vendor_name"]).join(
        base.products.select("product_id", "product_name", "product_category"), "product_id")
    order = [F.desc("gap"), F.asc("product_id"), F.asc("vendor_id")]
    return top_k(named, params.candidates_n, order).select(
        "vendor_id", "vendor_name", "product_id", "product_name", "product_category", "lines",
        "spend", F.round("_index", 4).alias("price_index"), F.col("gap").alias("net_ppv"))


def year_adjusted(base: PriceBase, model: ProcurementModel,
                  params: PriceParams = DEFAULTS) -> DataFrame:
    """Vendor price index under the overall median and under the median of the year."""
    covered = base.covered(params).select("product_id", "benchmark_price")
    dated = base.points.where(F.col("order_year").isNotNull()).join(
        covered.select("product_id"), "product_id", "left_semi")
    yearly = benchmarks(dated, "order_year").select(
        "product_id", "order_year", F.col("benchmark_price").alias("_bench_year"))
    grouped = dated.groupBy("vendor_id", "product_id", "order_year").agg(
        F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"),
        F.sum(point_spend()).alias("spend"))
    priced = grouped.join(yearly, ["product_id", "order_year"]).join(covered, "product_id")
    per_vendor = priced.groupBy("vendor_id").agg(
        F.sum("lines").alias("lines"), F.sum("spend").alias("spend"),
        F.sum(bench_spend()).alias("_bench"),
        F.sum(F.col("_bench_year") * F.col("quantity")).alias("_bench_of_year"))
    return describe(per_vendor, model.vendors, "vendor_id", ["vendor_name"]).select(
        "vendor_id", "vendor_name", "lines", "spend",
        ratio("spend", "_bench", 4).alias("price_index_overall_median"),
        ratio("spend", "_bench_of_year", 4).alias("price_index_year_median"),
        (F.col("spend") - F.col("_bench_of_year")).alias("net_ppv_year_median"))
