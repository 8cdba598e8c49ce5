"""Monthly spend forecast with backtests.

Six simple baselines on ordered spend (Completed + Open) by order month. The band
around the final forecast is plus/minus the backtest MAE: a rough range, not a
statistical interval.

Only the first step touches the lines. A monthly series has at most one row per
calendar month, so windows over it are small whatever the size of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import populations as pop
from ..functions.measures import month_number
from ..operators.joins import with_scalar
from ..operators.reshape import month_spine, open_pivot, unpivot_metrics
from ..params import ForecastParams
from ..sources.model import ProcurementModel

DEFAULTS = ForecastParams()
METHODS = ("naive_last", "ma3", "ma6", "mean_all", "seasonal_naive", "seasonal_growth")


def _by_month():
    return Window.orderBy("idx")


def monthly_totals(model: ProcurementModel) -> DataFrame:
    month = F.trunc("order_date", "month").alias("month_start")
    return (model.lines(pop.ordered_spend() & F.col("order_date").isNotNull(),
                        pop.COMPLETED, pop.OPEN)
            .groupBy(month).agg(F.sum(pop.line_spend()).cast("decimal(18,2)")
                                .alias("ordered_spend")))


def monthly_series(model: ProcurementModel) -> DataFrame:
    """Dense series ``month_start, ordered_spend, idx``; a month without orders is NULL."""
    return month_spine(monthly_totals(model), "month_start", "ordered_spend")


def series_checks(series: DataFrame) -> DataFrame:
    months = series.where(F.col("ordered_spend").isNotNull())
    span = month_number(F.max("month_start")) - month_number(F.min("month_start")) + 1
    return months.agg(
        F.count(F.lit(1)).alias("months"), F.min("month_start").alias("first_month"),
        F.max("month_start").alias("last_month"), span.alias("months_if_no_gaps"))


def yearly_totals(series: DataFrame) -> DataFrame:
    return series.groupBy(F.year("month_start").alias("year")).agg(
        F.sum("ordered_spend").alias("ordered_spend"))


def changes(series: DataFrame, season: int = 12) -> DataFrame:
    """Change on the previous month and on the same month a year earlier, in percent."""
    def change(lag: int) -> Column:
        before = F.lag("ordered_spend", lag).over(_by_month()).cast("double")
        now = F.col("ordered_spend").cast("double")
        return F.round((F.try_divide(now, before) - 1) * 100.0, 1)

    return series.select("month_start", "ordered_spend", change(1).alias("mom_pct"),
                         change(season).alias("yoy_pct"))


def relative_levels(series: DataFrame) -> DataFrame:
    """Each month relative to the monthly average of its own year."""
    year = F.year("month_start")
    own = Window.partitionBy(year)
    average = (F.sum("ordered_spend").over(own).cast("double")
               / F.count("ordered_spend").over(own))
    return series.select(year.alias("yr"), F.month("month_start").alias("mo"),
                         F.try_divide(F.col("ordered_spend").cast("double"), average)
                         .alias("rel"))


def seasonal_profile(series: DataFrame) -> DataFrame:
    """Relative level per calendar month, one column ``rel_<year>`` per year of the series."""
    return open_pivot(relative_levels(series), "mo", "yr", F.round(F.max("rel"), 3), "rel_{}")


def seasonality_correlation(series: DataFrame, first: int, second: int) -> DataFrame:
    """Do two years move together? Correlation for all months and per half-year."""
    levels = relative_levels(series)
    paired = (levels.where(F.col("yr") == first).select("mo", F.col("rel").alias("a"))
              .join(levels.where(F.col("yr") == second).select("mo", F.col("rel").alias("b")),
                    "mo"))
    half = F.when(F.col("mo") <= 6, "H1").otherwise("H2")
    parts = paired.select("a", "b", F.explode(F.array(F.lit("all"), half)).alias("part"))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("months"),
                                     F.round(F.corr("a", "b"), 6).alias("correlation"))


def forecasts(series: DataFrame, params: ForecastParams = DEFAULTS) -> DataFrame:
    """All methods for every origin and horizon, with the actual where it is known.

    A method is NULL where its window is incomplete: a moving average needs all
    its months, the growth factor needs both half-years. The series is dense, so
    every look back or ahead is a fixed number of rows and one pass suffices.
    """
    value = F.col("ordered_spend").cast("double")
    in_order, whole = _by_month(), Window.partitionBy()

    def complete_sum(length: int) -> Column:
        frame = _by_month().rowsBetween(1 - length, 0)
        full = F.count("ordered_spend").over(frame) == length
        return F.when(full, F.sum("ordered_spend").over(frame).cast("double"))

    past = _by_month().rowsBetween(Window.unboundedPreceding, 0)
    all_past = F.when(F.count("ordered_spend").over(past) == F.col("idx"),
                      F.sum("ordered_spend").over(past).cast("double") / F.col("idx"))
    steps = F.array(*[
        F.struct(F.lit(h).alias("horizon"),
                 F.lag(value, params.season - h).over(in_order).alias("seasonal_naive"),
                 F.lead(value, h).over(in_order).alias("actual"))
        for h in range(1, params.horizon + 1)])
    state = series.select(
        F.col("idx").alias("train_end"), "month_start", value.alias("naive_last"),
        (complete_sum(params.short_window) / params.short_window).alias("ma3"),
        (complete_sum(params.long_window) / params.long_window).alias("ma6"),
        all_past.alias("mean_all"), complete_sum(params.long_window).alias("_recent"),
        F.max("idx").over(whole).alias("_last"), steps.alias("_steps"))
    state = state.withColumn(
        "_earlier", F.lag("_recent", params.season).over(Window.orderBy("train_end")))

    end = F.col("train_end")
    if params.origins:
        final, chosen = end == params.origins[-1], end.isin(*params.origins)
    else:
        final = end == F.col("_last")
        chosen = final | (F.col("_last") - end).isin(*params.holdback)
    grid = state.where(chosen).select(
        "*", F.when(final, "final").otherwise("backtest").alias("purpose"),
        F.explode("_steps").alias("_step")).select("*", "_step.*")
    return grid.select(
        "purpose", "train_end", "horizon", (end + F.col("horizon")).alias("target_idx"),
        F.add_months("month_start", F.col("horizon")).alias("target_month"),
        "naive_last", "ma3", "ma6", "mean_all", "seasonal_naive",
        F.try_divide(F.col("seasonal_naive") * F.col("_recent"), F.col("_earlier"))
        .alias("seasonal_growth"), "actual")


@dataclass(frozen=True)
class ForecastBase:
    """The monthly series and its forecasts (a few dozen rows each)."""

    series: DataFrame
    forecasts: DataFrame
    params: ForecastParams = DEFAULTS

    @classmethod
    def build(cls, model: ProcurementModel, params: ForecastParams = DEFAULTS) -> ForecastBase:
        return cls.from_series(monthly_series(model), params)

    @classmethod
    def from_series(cls, series: DataFrame, params: ForecastParams = DEFAULTS) -> ForecastBase:
        return cls(series, forecasts(series, params), params)


def _millions(*columns: str) -> list[Column]:
    return [F.round(F.col(c).cast("double") / 1e6, 2).alias(f"{c}_m") for c in columns]


def _with_actual(base: ForecastBase) -> DataFrame:
    return base.forecasts.where((F.col("purpose") == "backtest") & F.col("actual").isNotNull())


def backtest_detail(base: ForecastBase) -> DataFrame:
    """Actual and forecasts per holdout month, in millions."""
    return _with_actual(base).select("train_end", "horizon", "target_month",
                                     *_millions("actual", *METHODS))


def _errors(base: ForecastBase) -> DataFrame:
    long = unpivot_metrics(_with_actual(base), ["train_end", "horizon", "target_idx", "actual"],
                           METHODS, "method", "forecast")
    return long.where(F.col("forecast").isNotNull()).withColumn(
        "error", F.col("forecast") - F.col("actual"))


def _accuracy(errors: DataFrame, *keys: str) -> DataFrame:
    """MAPE, WAPE, signed bias (positive: too high) and MAE."""
    size = F.abs("error")
    return errors.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("months"),
        F.round(F.avg(F.try_divide(size, F.col("actual"))) * 100.0, 2).alias("mape_pct"),
        F.round(F.try_divide(F.sum(size), F.sum("actual")) * 100.0, 2).alias("wape_pct"),
        F.round(F.avg(F.try_divide(F.col("error"), F.col("actual"))) * 100.0, 2)
        .alias("bias_pct"),
        F.round(F.avg(size), 2).alias("mae"))


def accuracy(base: ForecastBase) -> DataFrame:
    return _accuracy(_errors(base), "train_end", "method")


def accuracy_pooled(base: ForecastBase) -> DataFrame:
    """Across origins. A method missing at one origin covers fewer months."""
    return _accuracy(_errors(base), "method")


def select_method(base: ForecastBase) -> DataFrame:
    """Lowest pooled WAPE among the methods tested at every backtest origin."""
    tested = _errors(base).groupBy("method").agg(
        F.count_distinct("train_end").alias("_tested"))
    origins = base.forecasts.where(F.col("purpose") == "backtest").agg(
        F.count_distinct("train_end").alias("_origins"))
    everywhere = with_scalar(tested, origins).where(F.col("_tested") == F.col("_origins"))
    return (accuracy_pooled(base).join(everywhere.select("method"), "method", "left_semi")
            .orderBy("wape_pct", "method").limit(1)
            .select("method", "months", "wape_pct", "mae"))


def _final(base: ForecastBase) -> DataFrame:
    return base.forecasts.where(F.col("purpose") == "final")


def final_forecast(base: ForecastBase) -> DataFrame:
    """The selected method on all data, with its pooled MAE as a band."""
    long = unpivot_metrics(
        _final(base).where(F.col(base.params.selected).isNotNull()),
        ["horizon", "target_month"], [base.params.selected], "method", "forecast")
    banded = long.join(accuracy_pooled(base).select("method", "mae"), "method")
    value, mae = F.col("forecast"), F.col("mae")
    return banded.select(
        "horizon", "target_month", "method", F.round(value, 2).alias("forecast"),
        F.round(value - mae, 2).alias("low_band"), F.round(value + mae, 2).alias("high_band"))


def final_all_methods(base: ForecastBase) -> DataFrame:
    return _final(base).select("horizon", "target_month", *_millions(*METHODS))


def band_coverage(base: ForecastBase) -> DataFrame:
    """How many holdout actuals lie inside forecast plus/minus MAE, per method."""
    judged = _errors(base).join(accuracy_pooled(base).select("method", "mae"), "method")
    inside = F.abs("error") <= F.col("mae")
    return judged.groupBy("method").agg(
        F.count(F.lit(1)).alias("months"), F.count_if(inside).alias("inside_band"))
