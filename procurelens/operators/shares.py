"""Shares of a total and min-max scaling, without single-task windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import percent
from .joins import with_scalar


def share_of_total(df: DataFrame, value: str, out: str = "pct_of_total",
                   by: str | None = None) -> DataFrame:
    """Add ``value`` as a percentage of its total, overall or within ``by``.

    The total is a one-row (or one-row-per-group) aggregate joined back, so the
    work stays distributed. ``df`` is read twice: pass a working set, or an
    aggregate whose only measure is ``value`` so that Spark reuses its exchange.
    """
    if by is None:
        joined = with_scalar(df, df.agg(F.sum(value).alias("_total")))
    else:
        joined = df.join(df.groupBy(by).agg(F.sum(value).alias("_total")), by)
    return joined.withColumn(out, percent(value, "_total")).drop("_total")


def minmax_score(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Rescale columns to 0-100 across all rows.

    ``columns`` maps an output name to ``(input, best)`` where ``best`` is
    ``"high"`` or ``"low"``. The score is NULL when all rows are equal.
    """
    bounds = []
    for source in dict.fromkeys(source for source, _ in columns.values()):
        bounds += [F.min(source).alias(f"_min_{source}"), F.max(source).alias(f"_max_{source}")]
    scored = with_scalar(df, df.agg(*bounds))
    for out, (source, best) in columns.items():
        low, high = F.col(f"_min_{source}"), F.col(f"_max_{source}")
        distance = F.col(source) - low if best == "high" else high - F.col(source)
        scored = scored.withColumn(out, F.try_divide(distance * 100.0, high - low))
    return scored.select(*df.columns, *columns)
