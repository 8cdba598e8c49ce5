"""Data-quality audit."""

from .base import (
    CALENDAR,
    DEPARTMENTS,
    PART_LINES,
    PART_PRODUCTS,
    STAGING,
    VENDORS,
    big,
    pct,
    query,
    quo,
)

STAGE = (PART_LINES, STAGING)
LINE_COLUMNS = (
    "po_line_id, po_id, vendor_id, product_id, department_id, order_date, "
    "expected_delivery_date, actual_delivery_date, quantity, unit_price, currency, po_status")


def _dimension(name: str, columns: list[str], casts: dict[str, str]) -> str:
    key = columns[0]
    padded = " OR ".join(f"coalesce({c} <> trim({c}), FALSE)" for c in columns)
    failed = " + ".join(
        f"CAST({c} IS NOT NULL AND TRY_CAST(trim({c}) AS {t}) IS NULL AS INT)"
        for c, t in casts.items()) or "0"
    staged = ", ".join(f"' ' || CAST({c} AS VARCHAR) || ' ' AS {c}" for c in columns)
    return f"""
    SELECT '{name}' AS dimension, count(*) AS rows,
           count({key}) - count(DISTINCT trim({key})) AS duplicate_keys,
           count(*) FILTER (WHERE {key} IS NULL OR trim({key}) = '') AS blank_keys,
           count(*) FILTER (WHERE {padded}) AS padded_rows,
           {big(f"coalesce(sum({failed}), 0)")} AS failed_casts
    FROM (SELECT {staged} FROM {name})"""


DIMENSIONS = " UNION ALL ".join([
    _dimension("vendors", ["vendor_id", "vendor_name", "vendor_category", "region",
                           "vendor_start_date", "vendor_status"],
               {"vendor_start_date": "DATE"}),
    _dimension("products", ["product_id", "product_name", "product_category", "subcategory",
                            "standard_cost", "unit_of_measure"],
               {"standard_cost": "DECIMAL(10,2)"}),
    _dimension("departments", ["department_id", "department", '"group"'], {}),
    _dimension("calendar", ["date", "year", "quarter", "month", "month_name", "year_month",
                            "week", "day_name"],
               {"date": "DATE", "year": "INTEGER", "month": "INTEGER", "week": "INTEGER"}),
])


def _count_by_column(columns: tuple[str, ...], condition: str, alias: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {condition.format(c=c)}) AS {alias} "
        "FROM staging" for c in columns)


SQL = {
    "dq_exact_duplicates": query(
        f"SELECT {LINE_COLUMNS}, count(*) AS copies FROM staging "
        f"GROUP BY {LINE_COLUMNS} HAVING count(*) > 1", *STAGE),
    "dq_missing_counts": query(
        _count_by_column(("unit_price", "quantity", "expected_delivery_date"),
                         "{c} IS NULL OR trim({c}) = ''", "missing"), *STAGE),
    "dq_invalid_values": query("""
        SELECT count(*) FILTER (WHERE price_value < 0) AS negative_unit_price,
               count(*) FILTER (WHERE quantity_value <= 0) AS zero_or_negative_quantity
        FROM typed""", *STAGE),
    "dq_domain_profile": query("""
        SELECT 'currency' AS "column", currency AS raw_value, currency_value AS normalised_value,
               count(*) AS rows FROM typed GROUP BY ALL
        UNION ALL
        SELECT 'po_status', po_status, status_value, count(*) FROM typed GROUP BY ALL""", *STAGE),
    "dq_malformed_dates": query(
        _count_by_column(
            ("order_date", "expected_delivery_date", "actual_delivery_date"),
            "trim({c}) <> '' AND try_strptime(trim({c}), '%Y-%m-%d') IS NULL", "malformed"),
        *STAGE),
    "dq_delivery_before_order": query("""
        SELECT count(*) FILTER (WHERE actual_day < order_day) AS delivery_before_order
        FROM typed""", *STAGE),
    "dq_id_collisions": query("""
        SELECT po_line_id, count(*) AS row_count,
               count(DISTINCT [po_id, vendor_id, product_id, department_id,
                     coalesce(order_date, ''), coalesce(expected_delivery_date, ''),
                     coalesce(actual_delivery_date, ''), coalesce(quantity, ''),
                     coalesce(unit_price, ''), currency, po_status]) AS distinct_versions
        FROM staging GROUP BY po_line_id HAVING distinct_versions > 1""", *STAGE),
    "dq_orphan_keys": query(f"""
        SELECT dimension, count(DISTINCT key) FILTER (WHERE NOT known) AS orphan_keys,
               count(*) FILTER (WHERE NOT known) AS orphan_lines
        FROM (
          SELECT 'vendors' AS dimension, vendor_id AS key,
                 vendor_id IN (SELECT vendor_id FROM vendors) AS known FROM lines
          UNION ALL
          SELECT 'products', product_id, product_id IN (SELECT product_id FROM products)
          FROM lines
          UNION ALL
          SELECT 'departments', department_id,
                 department_id IN (SELECT department_id FROM departments) FROM lines
          UNION ALL
          SELECT 'calendar', CAST(order_date AS VARCHAR),
                 order_date IN (SELECT date FROM calendar) FROM lines)
        WHERE key IS NOT NULL
        GROUP BY dimension""", PART_LINES, VENDORS, PART_PRODUCTS, DEPARTMENTS, CALENDAR),
    "dq_dimension_checks": query(DIMENSIONS, VENDORS, PART_PRODUCTS, DEPARTMENTS, CALENDAR),
    "dq_calendar_gaps": query(f"""
        SELECT count(DISTINCT d) AS days,
               {big("date_diff('day', min(d), max(d)) + 1")} AS days_expected,
               {big("date_diff('day', min(d), max(d)) + 1")} - count(DISTINCT d) AS missing_days
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)"""),
    "dq_conditional_nulls": query(f"""
        SELECT status_value AS po_status, count(*) AS lines,
               count(*) FILTER (WHERE actual_day IS NULL) AS missing_actual,
               {pct("missing_actual", "count(*)")} AS missing_pct
        FROM typed GROUP BY status_value""", *STAGE),
    "dq_table_counts": query(f"""
        SELECT count(*) AS lines, count(DISTINCT po_id) AS purchase_orders,
               {quo("count(*)", "count(DISTINCT po_id)")} AS lines_per_po
        FROM staging""", *STAGE),
    "dq_status_mix": query(f"""
        SELECT status_value AS po_status, count(*) AS lines,
               {pct("count(*)", "sum(count(*)) OVER ()")} AS pct_of_lines
        FROM typed GROUP BY status_value""", *STAGE),
}

