"""Fixed table schemas. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(10, 2)


def _struct(*columns: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


def all_text(columns: list[str]) -> StructType:
    """Staging shape of a table: every column is text."""
    return StructType([StructField(name, StringType(), True) for name in columns])


# Column names, order and types of the cleaned tables and exports.
PURCHASE_ORDERS = _struct(
    ("po_line_id", StringType()), ("po_id", StringType()), ("vendor_id", StringType()),
    ("product_id", StringType()), ("department_id", StringType()), ("order_date", DateType()),
    ("expected_delivery_date", DateType()), ("actual_delivery_date", DateType()),
    ("quantity", MONEY), ("unit_price", MONEY), ("currency", StringType()),
    ("po_status", StringType()),
)
VENDORS = _struct(
    ("vendor_id", StringType()), ("vendor_name", StringType()),
    ("vendor_category", StringType()), ("region", StringType()),
    ("vendor_start_date", DateType()), ("vendor_status", StringType()),
)
PRODUCTS = _struct(
    ("product_id", StringType()), ("product_name", StringType()),
    ("product_category", StringType()), ("subcategory", StringType()),
    ("standard_cost", MONEY), ("unit_of_measure", StringType()),
)
DEPARTMENTS = _struct(
    ("department_id", StringType()), ("department", StringType()), ("group", StringType()),
)
CALENDAR = _struct(
    ("date", DateType()), ("year", IntegerType()), ("quarter", StringType()),
    ("month", IntegerType()), ("month_name", StringType()), ("year_month", StringType()),
    ("week", IntegerType()), ("day_name", StringType()),
)
SCORECARD_EXPORT = _struct(
    ("vendor_name", StringType()), ("vendor_category", StringType()), ("region", StringType()),
    ("spend", DecimalType(18, 2)), ("spend_share_pct", DecimalType(6, 3)),
    ("price_index", DecimalType(8, 4)), ("on_time_pct", DecimalType(5, 1)),
    ("avg_days_late", DecimalType(5, 1)), ("price_band", StringType()),
    ("delivery_band", StringType()), ("composite_score", DecimalType(5, 1)),
    ("flagged_products", IntegerType()), ("gap_ceiling", DecimalType(18, 2)),
)
PAIRS_EXPORT = _struct(
    ("vendor_name", StringType()), ("product_name", StringType()),
    ("product_category", StringType()), ("lines", IntegerType()),
    ("spend", DecimalType(18, 2)), ("price_index", DecimalType(8, 4)),
    ("gap_to_median", DecimalType(18, 2)), ("vendor_on_time_pct", DecimalType(5, 1)),
)
