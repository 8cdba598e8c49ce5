"""Ratios, date distances and banding."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator: str | Column, denominator: str | Column, scale: int | None = None) -> Column:
    """Quotient as double, NULL on a zero denominator, optionally rounded.

    Sums stay decimal until here, so the operands are exact and the quotient
    does not depend on how the data was partitioned.
    """
    value = F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))
    return value if scale is None else F.round(value, scale)


def percent(part: str | Column, whole: str | Column, scale: int | None = None) -> Column:
    value = F.try_divide(as_col(part).cast("double") * 100.0, as_col(whole).cast("double"))
    return value if scale is None else F.round(value, scale)


def percent_change(new: str | Column, old: str | Column, scale: int | None = None) -> Column:
    return percent(as_col(new) - as_col(old), old, scale)


def days_late(expected: str = "expected_delivery_date",
              actual: str = "actual_delivery_date") -> Column:
    return F.datediff(F.col(actual), F.col(expected))


def month_number(day: str | Column) -> Column:
    """Months since year 0; differences count calendar month boundaries."""
    return F.year(as_col(day)) * 12 + F.month(as_col(day))


def month_index(day: str | Column, origin: str | Column) -> Column:
    """1-based position of a month in a series that starts at ``origin``."""
    return month_number(day) - month_number(origin) + 1


def year_month(day: str | Column) -> Column:
    return F.date_format(as_col(day), "yyyy-MM")


def day_literal(value: date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))


def band(value: str | Column, rules: Sequence[tuple[str, float, str]], otherwise: str) -> Column:
    """Label ``value`` by the first matching rule ``(operator, bound, label)``.

    ``operator`` is ``<``, ``<=``, ``>`` or ``>=``.
    """
    compare = {
        "<": lambda c, b: c < b,
        "<=": lambda c, b: c <= b,
        ">": lambda c, b: c > b,
        ">=": lambda c, b: c >= b,
    }
    column = as_col(value)
    chain = None
    for operator, bound, label in rules:
        test = compare[operator](column, F.lit(bound))
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return F.lit(otherwise) if chain is None else chain.otherwise(otherwise)
