"""Unpivoting, month spines and reconciliation frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import month_index


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
                    key: str = "metric", value: str = "value") -> DataFrame:
    """One row per (id, metric). All metrics are brought to double first."""
    typed = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return typed.unpivot(list(ids), list(metrics), key, value)


def open_pivot(df: DataFrame, row: str, column: str, value: Column, name: str = "{}") -> DataFrame:
    """One column per value of ``column`` that occurs, in order; a missing one is called ``none``.

    ``df`` is an aggregate whose ``column`` has few values; they are measured first, so no
    value can be left out because a list does not know it.
    """
    key = F.coalesce(F.col(column).cast("string"), F.lit("none"))
    values = [r["_key"] for r in df.select(key.alias("_key"), F.col(column).alias("_by")).distinct()
              .orderBy("_by", "_key").collect()]
    wide = df.withColumn("_key", key).groupBy(row).pivot("_key", values).agg(value)
    return wide.select(row, *[F.col(f"`{v}`").alias(name.format(v)) for v in values])


def month_spine(df: DataFrame, month: str, value: str) -> DataFrame:
    """Dense monthly series ``month_start, value, idx`` from the first to the last month.

    A month without rows appears with a NULL value, and ``idx`` comes from month
    arithmetic, so a gap shifts nothing. ``df`` has at most one row per month,
    which bounds the unpartitioned window by the calendar.
    """
    following = F.lead(month).over(Window.orderBy(month))
    until = F.coalesce(F.add_months(following, -1), F.col(month))
    first = F.min(month).over(Window.partitionBy())
    filled = df.where(F.col(month).isNotNull()).select(
        F.col(month).alias("_own"), F.col(value), first.alias("_first"),
        F.sequence(month, until, F.expr("interval 1 month")).alias("_months"))
    return filled.select("*", F.explode("_months").alias("_month")).select(
        F.col("_month").alias(month),
        F.when(F.col("_month") == F.col("_own"), F.col(value)).alias(value),
        month_index("_month", "_first").alias("idx"))


def reconcile(expected: DataFrame, actual: DataFrame, tolerance: float) -> DataFrame:
    """Compare two ``(check, value)`` frames; a missing side fails the check."""
    left = expected.select("check", F.col("value").cast("double").alias("expected"))
    right = actual.select("check", F.col("value").cast("double").alias("actual"))
    joined = left.join(right, "check", "full")
    difference = F.col("actual") - F.col("expected")
    return joined.select(
        "check", "expected", "actual", difference.alias("difference"),
        F.coalesce(F.abs(difference) <= tolerance, F.lit(False)).alias("pass"))


def scalar_metrics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn a one-row frame into ``(check, value)`` rows."""
    return unpivot_metrics(df, [], columns, "check", "value")
