"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _with_parts(days: DataFrame, week: str) -> DataFrame:
    if week not in ("iso", "block"):
        raise ValueError("week must be 'iso' or 'block'")
    number = (F.weekofyear("date") if week == "iso"
              else F.floor((F.dayofyear("date") - 1) / 7).cast("int") + 1)
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.concat(F.lit("Q"), F.quarter("date").cast("string")).alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        number.alias("week"),
        F.date_format("date", "EEEE").alias("day_name"),
    )


def build_calendar(spark: SparkSession, start: date, end: date, week: str = "iso") -> DataFrame:
    """One row per day from ``start`` to ``end``.

    ``week`` is ``"iso"`` or ``"block"`` (seven-day blocks from 1 January). Choose
    ``end`` to cover delivery dates if deliveries are to be joined; otherwise an
    inner join silently drops the later ones.
    """
    days = spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    return _with_parts(days, week)


def covering_calendar(df: DataFrame, column: str, week: str = "iso") -> DataFrame:
    """One row per day from the first year to the last month that ``column`` has; none without dates.

    The range is an aggregate of one column, reduced to a row by every task, so no
    date can fall outside and nothing is fetched to the driver.
    """
    day = F.col(column).cast("date")
    bounds = df.agg(F.trunc(F.min(day), "year").alias("first"), F.last_day(F.max(day)).alias("last"))
    return _with_parts(bounds.select(F.explode(F.sequence("first", "last")).alias("date")), week)
