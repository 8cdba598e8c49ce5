"""Cleaning of the fact and the dimensions, and file round trips."""

from .base import (
    CALENDAR,
    CLEAN,
    DEPARTMENTS,
    PART_LINES,
    PART_PRODUCTS,
    STAGING,
    VENDORS,
    big,
    dbl,
    query,
)

STAGE = (PART_LINES, STAGING)
CLEANED = (*STAGE, CLEAN)

CLEAN_COLUMNS = f"""
  po_line_id, po_id, vendor_id, product_id, department_id,
  CAST(order_date AS VARCHAR) AS order_date,
  CAST(expected_delivery_date AS VARCHAR) AS expected_delivery_date,
  CAST(actual_delivery_date AS VARCHAR) AS actual_delivery_date,
  {dbl("quantity")} AS quantity, {dbl("unit_price")} AS unit_price, currency, po_status"""

SQL = {
    "clean_dedup": query("SELECT DISTINCT * FROM staging", *STAGE),
    "clean_badness": query("""
        SELECT badness AS badness_score, count(*) AS lines FROM versions GROUP BY badness""",
                           *CLEANED),
    "clean_collisions": query("""
        SELECT po_line_id, count(*) AS rows_kept FROM clean GROUP BY po_line_id""", *CLEANED),
    "clean_fact": query(f"SELECT {CLEAN_COLUMNS} FROM clean", *CLEANED),
    "clean_department": query("SELECT * FROM departments", DEPARTMENTS),
    "clean_vendor": query("""
        SELECT * REPLACE (CAST(vendor_start_date AS VARCHAR) AS vendor_start_date)
        FROM vendors""", VENDORS),
    "clean_product": query(f"""
        SELECT * REPLACE ({dbl("standard_cost")} AS standard_cost) FROM products""",
                           PART_PRODUCTS),
    "clean_date": query(f"""
        SELECT CAST(date AS VARCHAR) AS date, {big("year")} AS year, quarter,
               {big("month")} AS month, month_name, year_month, {big("week")} AS week, day_name,
               count(o_orderkey) AS orders
        FROM calendar LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date
        GROUP BY ALL""", CALENDAR),
    "build_calendar": query(f"""
        SELECT {big("year(d)")} AS year, {big("(dayofyear(d) - 1) // 7 + 1")} AS week_block,
               {big("weekofyear(d)")} AS iso_week, count(*) AS orders
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL"""),
    "io_staging_csv": query(f"""
        SELECT nullif(trim(po_status), '') AS po_status, nullif(trim(currency), '') AS currency,
               count(*) AS lines,
               count(*) FILTER (WHERE quantity IS NULL OR quantity = '') AS missing_quantity,
               {dbl("sum(TRY_CAST(nullif(unit_price, '') AS DECIMAL(10,2)))")} AS price_sum
        FROM staging GROUP BY ALL""", *STAGE),
    "io_cleaned_table": query(f"""
        SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS lines,
               {dbl("sum(quantity)")} AS quantity
        FROM clean GROUP BY ALL""", *CLEANED),
}
