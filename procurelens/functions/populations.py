"""The analytical populations, each stated once as a boolean column.

A line that counts for one KPI need not count for another: spend needs valid
numbers, delivery needs valid dates, and neither filter implies the other.
NULLs fall out by three-valued logic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical status names.
COMPLETED = "Completed"
OPEN = "Open"
CANCELLED = "Cancelled"


def has_status(*statuses: str) -> Column:
    status = F.col("po_status")
    return status == statuses[0] if len(statuses) == 1 else status.isin(*statuses)


def valid_amount() -> Column:
    return (F.col("quantity") > 0) & (F.col("unit_price") > 0)


def eligible_spend() -> Column:
    """Completed lines with a positive quantity and price."""
    return has_status(COMPLETED) & valid_amount()


def ordered_spend() -> Column:
    """Completed plus Open lines with valid amounts: demand, not deliveries."""
    return has_status(COMPLETED, OPEN) & valid_amount()


def plausible_delivery() -> Column:
    """Both delivery dates known and no delivery before the order."""
    ordered, actual = F.col("order_date"), F.col("actual_delivery_date")
    return (
        F.col("expected_delivery_date").isNotNull()
        & actual.isNotNull()
        & (ordered.isNull() | (actual >= ordered))
    )


def eligible_delivery() -> Column:
    """Completed lines whose punctuality can be judged.

    Open lines never count, however late they are, so on-time rates carry
    survivorship bias.
    """
    return has_status(COMPLETED) & plausible_delivery()


def valid_open() -> Column:
    return has_status(OPEN) & valid_amount()


def open_with_due_date() -> Column:
    return valid_open() & F.col("expected_delivery_date").isNotNull()


def overdue_open(as_of: Column) -> Column:
    return valid_open() & (F.col("expected_delivery_date") < as_of)


def line_spend() -> Column:
    return F.col("quantity") * F.col("unit_price")
