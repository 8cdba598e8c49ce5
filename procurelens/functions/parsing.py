"""Text to typed values. Anything unparseable or blank becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every known spelling (lower case, trimmed) of a canonical value.
CURRENCY_SPELLINGS = {"usd": "USD", "us dollar": "USD"}
STATUS_SPELLINGS = {
    "completed": "Completed",
    "open": "Open",
    "cancelled": "Cancelled",
    "canceled": "Cancelled",
}


def clean_text(column: str | Column) -> Column:
    """Trim on both sides; a blank is a missing value."""
    return F.nullif(F.trim(_col(column)), F.lit(""))


def is_missing(column: str | Column) -> Column:
    return clean_text(column).isNull()


def parse_date(column: str | Column) -> Column:
    """Strict ISO date. A partial date such as ``2024`` is rejected.

    The cast alone would also take partial dates and a time suffix, so the shape
    is checked first; both steps are far cheaper than a formatter.
    """
    text = F.trim(_col(column))
    shaped = ((F.length(text) == 10) & (F.substring(text, 5, 1) == "-")
              & (F.substring(text, 8, 1) == "-") & (F.substring(text, 10, 1) != "T"))
    return F.when(shaped, text.try_cast("date"))


def parse_decimal(column: str | Column, precision: int = 10, scale: int = 2) -> Column:
    return clean_text(column).try_cast(f"decimal({precision},{scale})")


def parse_int(column: str | Column) -> Column:
    return clean_text(column).try_cast("int")


def is_malformed_date(column: str | Column) -> Column:
    """Text is present but is not a date (missing text is a separate defect)."""
    return clean_text(column).isNotNull() & parse_date(column).isNull()


def standardise(column: str | Column, spellings: dict[str, str]) -> Column:
    """Map any known spelling to its canonical value; keep unknown text trimmed."""
    text = clean_text(column)
    folded = F.lower(text)
    by_target: dict[str, list[str]] = {}
    for spelling, target in spellings.items():
        by_target.setdefault(target, []).append(spelling)
    result = text
    for target, known in by_target.items():
        result = F.when(folded.isin(*known), F.lit(target)).otherwise(result)
    return result


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
