"""Reference answers in SQL for the registered queries (run by DuckDB).

They state each result directly (sorts, windows, quantiles over whole groups)
and share nothing with the Spark operators but the meaning.
"""

from . import base, cleaned, cleaning, forecast, opportunity, pricing, quality, spend, vendor


def statements() -> dict[str, str]:
    merged: dict[str, str] = {}
    for module in (quality, cleaning, spend, vendor, pricing, opportunity, forecast, cleaned):
        merged.update(module.SQL)
    return merged


__all__ = ["base", "statements"]
