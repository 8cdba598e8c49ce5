"""Scenario model, savings tracker and reconciliation on top of the exports.

Works on the two exported tables (scorecard and flagged pairs), whose rows are
rounded to cents, so totals may differ from the unrounded analysis by cents.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import percent, ratio
from ..operators.joins import unique_rows, with_scalar
from ..operators.reshape import reconcile, scalar_metrics, unpivot_metrics
from ..params import OpportunityParams
from . import opportunity as opp
from .opportunity import OpportunityBase

DEFAULTS = OpportunityParams()


def pair_key(vendor: str = "vendor_name", product: str = "product_name"):
    return F.concat_ws(" | ", F.col(vendor), F.col(product))


def with_key(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("key", pair_key())


def scenario_rates(spark: SparkSession, params: OpportunityParams = DEFAULTS) -> DataFrame:
    """The scenarios a reader can switch between: ``scenario, rate``."""
    return spark.createDataFrame([(name, Decimal(str(rate))) for name, rate in params.rates.items()],
                                 "scenario string, rate decimal(4,2)")


def scenario_row(pairs: DataFrame, scorecard: DataFrame,
                 params: OpportunityParams = DEFAULTS) -> DataFrame:
    """All figures that no switch changes, as one row."""
    gap = F.col("gap_to_median")
    unreliable = F.when(F.col("vendor_on_time_pct") < params.strong, gap).otherwise(0)
    nothing = F.lit(0)
    summed = pairs.agg(F.coalesce(F.sum(gap), nothing).alias("gap_ceiling"),
                       F.coalesce(F.sum(unreliable), nothing).alias("_unreliable"),
                       F.count(F.lit(1)).alias("flagged_pairs"))
    spend = scorecard.agg(F.sum("spend").alias("total_spend"),
                          F.count(F.lit(1)).alias("vendors"))
    rates = dict(params.rates.items())

    def at(column: str, scenario: str):
        return F.col(column) * F.lit(rates[scenario]).cast("decimal(4,2)")

    return with_scalar(summed, spend).select(
        "gap_ceiling", at("gap_ceiling", "Low").alias("low"),
        at("gap_ceiling", "Base").alias("base"), at("gap_ceiling", "High").alias("high"),
        at("_unreliable", "Base").alias("reliability_adjusted_base"), "_unreliable",
        percent("gap_ceiling", "total_spend").alias("ceiling_pct_of_spend"),
        "total_spend", "vendors", "flagged_pairs")


SCENARIO_METRICS = ("gap_ceiling", "low", "base", "high", "selected", "reliability_adjusted",
                    "annualised", "ceiling_pct_of_spend")


def scenarios(pairs: DataFrame, scorecard: DataFrame, months: DataFrame,
              params: OpportunityParams = DEFAULTS) -> DataFrame:
    """The model at every position of the scenario switch: ``scenario, metric, value``.

    ``selected``, ``reliability_adjusted`` and ``annualised`` follow the switch; ``months`` is
    the one-row span of the data, by which savings are brought to a year.
    """
    rates = F.broadcast(scenario_rates(pairs.sparkSession, params))  # a row for each scenario
    row = with_scalar(scenario_row(pairs, scorecard, params), months).crossJoin(rates)
    row = row.withColumn("selected", F.col("gap_ceiling") * F.col("rate")).withColumns({
        "reliability_adjusted": F.col("_unreliable") * F.col("rate"),
        "annualised": ratio(F.col("selected") * 12, "months")})
    return unpivot_metrics(row, ["scenario"], SCENARIO_METRICS)


def tracker_variance(tracker: DataFrame, pairs: DataFrame,
                     params: OpportunityParams = DEFAULTS) -> DataFrame:
    """Expected and realised savings per tracked pair.

    ``tracker`` has ``key, status, realized_savings``. A key that is no flagged
    pair keeps its row with NULL expectations. Pairs are looked up by key, so a key that
    stands for two of them is an error.
    """
    rate = F.lit(dict(params.rates.items())[params.scenario]).cast("decimal(4,2)")
    looked_up = tracker.join(unique_rows(with_key(pairs), ["key"], "flagged pairs"), "key", "left")
    expected = F.col("gap_to_median") * rate
    return looked_up.select(
        "key", "vendor_name", "product_name", "product_category", "gap_to_median",
        "vendor_on_time_pct", expected.alias("expected_savings"), "status", "realized_savings",
        (F.col("realized_savings") - expected).alias("variance"))


def checks(base: OpportunityBase, pairs: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Export-based figures against the unrounded analysis, within the tolerance."""
    adjusted = opp.reliability_adjusted(base).select(
        F.coalesce("savings_base_excl_reliable_vendors", F.lit(0))
        .alias("reliability_adjusted_base"))
    expected = scalar_metrics(
        with_scalar(opp.headline_row(base), adjusted),
        ["total_spend", "flagged_pairs", "gap_ceiling", "savings_low", "savings_base",
         "savings_high", "reliability_adjusted_base", "dear_weak_vendors", "dear_weak_spend"])
    cell = (F.col("price_band") == opp.ABOVE) & (F.col("delivery_band") == opp.WEAK)
    cells = scorecard.agg(F.count_if(cell).alias("dear_weak_vendors"),
                          F.sum(F.when(cell, F.col("spend")).otherwise(0))
                          .alias("dear_weak_spend"))
    row = scenario_row(pairs, scorecard, base.params).withColumnsRenamed(
        {"low": "savings_low", "base": "savings_base", "high": "savings_high"})
    actual = scalar_metrics(
        with_scalar(row, cells),
        ["total_spend", "flagged_pairs", "gap_ceiling", "savings_low", "savings_base",
         "savings_high", "reliability_adjusted_base", "dear_weak_vendors", "dear_weak_spend"])
    return reconcile(expected, actual, base.params.tolerance)
