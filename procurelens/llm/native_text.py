"""Column expressions that several native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: higher-order functions read it from a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)
