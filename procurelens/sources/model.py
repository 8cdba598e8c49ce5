"""The star schema that all analytics take as input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

TABLES = ("fact", "vendors", "products", "departments", "calendar")


class ProcurementModel:
    """Cleaned fact (one row per PO line) and its dimensions.

    Columns follow ``sources.schemas``. A table is given as a DataFrame or as a
    function that opens it; a table no analysis touches is never opened.
    ``lines_of``, if given, opens the fact with lines of some statuses only: a
    source that stores another status code than the canonical one can filter by its own.
    """

    fact: DataFrame
    vendors: DataFrame
    products: DataFrame
    departments: DataFrame
    calendar: DataFrame

    def __init__(self, lines_of: Callable[[tuple[str, ...]], DataFrame] | None = None,
                 **tables: DataFrame | Callable[[], DataFrame]) -> None:
        self._lines_of = lines_of
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise TypeError(f"unknown tables {sorted(unknown)}")
        self._tables = tables

    def lines(self, condition: Column, *statuses: str) -> DataFrame:
        """Lines that meet ``condition``, which only lines of ``statuses`` can meet."""
        known = self.fact if self._lines_of is None else self._lines_of(statuses)
        return known.where(condition)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES or name not in self._tables:
            raise AttributeError(f"the model has no table {name!r}")
        table = self._tables[name]
        opened = table() if callable(table) else table
        setattr(self, name, opened)
        return opened
