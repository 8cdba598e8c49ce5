"""The model made of cleaned tables: staging is cleaned once, and every analysis reads the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources import tables
from ..sources.model import ProcurementModel
from . import cleaning

#: How each staged table becomes a cleaned one.
STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fact": cleaning.clean_fact,
    "vendors": cleaning.clean_vendor,
    "products": cleaning.clean_product,
    "departments": cleaning.clean_department,
    "calendar": cleaning.clean_calendar,
}


def model_from_staging(**staged: Callable[[], DataFrame]) -> ProcurementModel:
    """A model whose tables are cleaned from untyped staging when they are first read.

    The fact is written once an application (found again as long as the staged files
    are the same), so deduplication and the collision step are not repeated by every analysis,
    and filters and columns of an analysis reach the scan of typed Parquet. Dimensions are cleaned in place,
    and a repeated or missing key fails loudly.
    """
    def opened(name: str) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            cleaned = STEPS[name](staged[name]())
            return tables.kept_set(cleaned, "cleaned-lines") if name == "fact" else cleaned

        return run

    return ProcurementModel(**{name: opened(name) for name in staged})
