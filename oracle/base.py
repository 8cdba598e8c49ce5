"""The model as common table expressions over the driver tables."""

LINES = """
lines AS (
  SELECT l.l_orderkey AS okey,
         CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) AS po_line_id,
         CAST(l.l_orderkey AS VARCHAR) AS po_id,
         CAST(l.l_suppkey AS VARCHAR) AS vendor_id,
         {product} AS product_id,
         c.c_mktsegment AS department_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(o.o_orderdate AS DATE) + CAST(20 * p.p_size AS INTEGER) AS expected_delivery_date,
         CASE WHEN o.o_orderstatus = 'F' THEN CAST(l.l_shipdate AS DATE) END
           AS actual_delivery_date,
         CAST(l.l_quantity AS DECIMAL(10,2)) AS quantity,
         CAST((2 * CAST(round(l.l_extendedprice * 100) AS BIGINT) + CAST(l.l_quantity AS BIGINT))
              // (2 * CAST(l.l_quantity AS BIGINT)) * 0.01 AS DECIMAL(10,2)) AS unit_price,
         'USD' AS currency,
         CASE o.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open'
              WHEN 'P' THEN 'Cancelled' END AS po_status
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

PART_LINES = LINES.format(product="CAST(l.l_partkey AS VARCHAR)")
BRAND_LINES = LINES.format(product="p.p_brand")

VENDORS = """
vendors AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS vendor_id, s_name AS vendor_name,
         ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'][CAST(s_suppkey % 6 + 1 AS INT)]
           AS vendor_category,
         r_name AS region,
         DATE '1990-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS vendor_start_date,
         CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS vendor_status
  FROM supplier
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""

PART_PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_type AS product_category, p_brand AS subcategory,
         CAST(p_retailprice AS DECIMAL(10,2)) AS standard_cost,
         split_part(p_name, ' ', 2) AS unit_of_measure
  FROM part
)"""

BRAND_PRODUCTS = """
brand_type AS (
  SELECT p_brand, p_type
  FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY p_brand, p_type)
  QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) = 1
),
products AS (
  SELECT t.p_brand AS product_id, t.p_brand AS product_name, t.p_type AS product_category,
         t.p_brand AS subcategory,
         CAST(min(p.p_retailprice) AS DECIMAL(10,2)) AS standard_cost,
         min(split_part(p.p_name, ' ', 2)) AS unit_of_measure
  FROM brand_type t JOIN part p USING (p_brand)
  GROUP BY ALL
)"""

DEPARTMENTS = """
departments AS (
  SELECT DISTINCT c_mktsegment AS department_id, c_mktsegment AS department,
         CASE WHEN c_mktsegment IN ('BUILDING','FURNITURE','HOUSEHOLD') THEN 'Consumer'
              ELSE 'Industrial' END AS "group"
  FROM customer
)"""

CALENDAR = """
calendar AS (
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
         'Q' || quarter(d) AS quarter, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
         CAST(weekofyear(d) AS INTEGER) AS week, dayname(d) AS day_name
  FROM generate_series((SELECT date_trunc('year', min(o_orderdate)) FROM orders)::TIMESTAMP,
                       (SELECT last_day(max(o_orderdate)) FROM orders)::TIMESTAMP, INTERVAL 1 DAY) g(d)
)"""

SPEND_LINES = """
spend_lines AS (
  SELECT *, quantity * unit_price AS spend FROM lines
  WHERE po_status = 'Completed' AND quantity > 0 AND unit_price > 0
)"""

DELIVERIES = """
deliveries AS (
  SELECT *, date_diff('day', expected_delivery_date, actual_delivery_date) AS slip
  FROM lines
  WHERE po_status = 'Completed' AND expected_delivery_date IS NOT NULL
    AND actual_delivery_date IS NOT NULL
    AND coalesce(actual_delivery_date >= order_date, TRUE)
)"""



def pct(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) * 100.0 / nullif(CAST({b} AS DOUBLE), 0)"


def quo(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def dbl(a: str) -> str:
    return f"CAST({a} AS DOUBLE)"


def big(a: str) -> str:
    return f"CAST({a} AS BIGINT)"


def money(a: str) -> str:
    """Exact decimal rounded half up to cents, as double."""
    return f"CAST(round({a}, 2) AS DOUBLE)"


def query(select: str, *ctes: str) -> str:
    prefix = "WITH " + ",".join(c.strip() for c in ctes) + "\n" if ctes else ""
    return prefix + select.strip()


STAGING = """
defective AS (
  SELECT *, okey // 67 AS variant FROM lines
),
staged_once AS (
  SELECT okey, po_line_id, po_id, vendor_id, product_id, department_id,
         CASE WHEN okey % 601 = 0 THEN '2024-13-45' ELSE CAST(order_date AS VARCHAR) END
           AS order_date,
         CASE WHEN okey % 211 = 0 THEN '' ELSE CAST(expected_delivery_date AS VARCHAR) END
           AS expected_delivery_date,
         CAST(actual_delivery_date AS VARCHAR) AS actual_delivery_date,
         CASE WHEN okey % 503 = 0 THEN '0' WHEN okey % 191 = 0 THEN NULL
              ELSE CAST(quantity AS VARCHAR) END AS quantity,
         CASE WHEN okey % 197 = 0 THEN ''
              WHEN okey % 499 = 0 THEN '-' || CAST(unit_price AS VARCHAR)
              ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
         CASE WHEN okey % 67 = 0
              THEN ['usd', 'US Dollar', 'Usd', ' USD'][CAST(variant % 4 + 1 AS INT)]
              ELSE currency END AS currency,
         CASE WHEN okey % 67 <> 0 THEN po_status
              WHEN po_status = 'Completed'
              THEN ['completed', 'COMPLETED', 'Completed '][CAST(variant % 3 + 1 AS INT)]
              WHEN po_status = 'Open'
              THEN ['open', 'OPEN', 'Open '][CAST(variant % 3 + 1 AS INT)]
              WHEN po_status = 'Cancelled'
              THEN ['cancelled', 'CANCELLED', 'Canceled'][CAST(variant % 3 + 1 AS INT)]
         END AS po_status
  FROM defective
),
staging AS (
  SELECT * EXCLUDE (okey) FROM staged_once
  UNION ALL
  SELECT * EXCLUDE (okey) FROM staged_once WHERE okey % 143 = 0
),
typed AS (
  SELECT *,
         TRY_CAST(nullif(trim(unit_price), '') AS DECIMAL(10,2)) AS price_value,
         TRY_CAST(nullif(trim(quantity), '') AS DECIMAL(10,2)) AS quantity_value,
         CAST(try_strptime(trim(order_date), '%Y-%m-%d') AS DATE) AS order_day,
         CAST(try_strptime(trim(expected_delivery_date), '%Y-%m-%d') AS DATE) AS expected_day,
         CAST(try_strptime(trim(actual_delivery_date), '%Y-%m-%d') AS DATE) AS actual_day,
         CASE WHEN lower(trim(currency)) IN ('usd', 'us dollar') THEN 'USD'
              ELSE nullif(trim(currency), '') END AS currency_value,
         CASE lower(trim(po_status)) WHEN 'completed' THEN 'Completed' WHEN 'open' THEN 'Open'
              WHEN 'cancelled' THEN 'Cancelled' WHEN 'canceled' THEN 'Cancelled'
              ELSE nullif(trim(po_status), '') END AS status_value
  FROM staging
)"""

CLEAN = """
versions AS (
  SELECT DISTINCT *,
         CAST(price_value IS NULL AS INT) + CAST(quantity_value IS NULL AS INT)
         + CAST(order_day IS NULL AS INT) + CAST(expected_day IS NULL AS INT)
         + CAST(coalesce(actual_day < order_day, FALSE) AS INT) AS badness
  FROM typed
),
clean AS (
  SELECT po_line_id, po_id, vendor_id, product_id, department_id, order_day AS order_date,
         expected_day AS expected_delivery_date, actual_day AS actual_delivery_date,
         quantity_value AS quantity, price_value AS unit_price, currency_value AS currency,
         status_value AS po_status
  FROM versions
  QUALIFY badness = 0 OR (
    min(badness) OVER (PARTITION BY po_line_id) > 0
    AND row_number() OVER (
      PARTITION BY po_line_id
      ORDER BY badness, po_id NULLS FIRST, vendor_id NULLS FIRST, product_id NULLS FIRST,
               department_id NULLS FIRST, versions.order_date NULLS FIRST,
               versions.expected_delivery_date NULLS FIRST,
               versions.actual_delivery_date NULLS FIRST, versions.quantity NULLS FIRST,
               versions.unit_price NULLS FIRST, versions.currency NULLS FIRST,
               versions.po_status NULLS FIRST) = 1)
)"""
