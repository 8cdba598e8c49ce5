from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from procurelens.session import build_session  # noqa: E402
from procurelens.sources import schemas  # noqa: E402
from procurelens.sources.model import ProcurementModel  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def day(text):
    return None if text is None else date.fromisoformat(text)


def line(number, vendor="V1", product="P1", order="2024-01-10", expected="2024-01-20",
         actual="2024-01-20", quantity="1", price="10", status="Completed", po=None,
         department="D1"):
    """One cleaned PO line; every column can be overridden."""
    return (f"L{number}", po or f"PO{number}", vendor, product, department, day(order),
            day(expected), day(actual), quantity and Decimal(quantity), price and Decimal(price),
            "USD", status)


@pytest.fixture
def model(spark):
    """Build a model from lines; dimensions list every id that the lines use."""
    def build(lines, vendors=None, products=None):
        fact = spark.createDataFrame(lines, schemas.PURCHASE_ORDERS)
        vendor_ids = vendors or sorted({row[2] for row in lines if row[2]})
        product_ids = products or sorted({row[3] for row in lines if row[3]})
        return ProcurementModel(
            fact=fact,
            vendors=spark.createDataFrame(
                [(v, f"Vendor {v}", "Tools", "North", None, "Active") for v in vendor_ids],
                schemas.VENDORS),
            products=spark.createDataFrame(
                [(p, f"Product {p}", "Tools", "Hand", Decimal("9"), "Each") for p in product_ids],
                schemas.PRODUCTS),
            departments=spark.createDataFrame([("D1", "Ops", "Core")], schemas.DEPARTMENTS),
            calendar=lambda: _calendar(spark))

    return build


def _calendar(spark):
    from procurelens.sources.calendar import build_calendar

    return build_calendar(spark, date(2024, 1, 1), date(2025, 12, 31))


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df):
    result = df.collect()
    assert len(result) == 1
    return result[0].asDict()
