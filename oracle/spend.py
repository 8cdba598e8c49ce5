"""Spend analysis."""

from .base import (
    CALENDAR,
    DEPARTMENTS,
    PART_LINES,
    PART_PRODUCTS,
    SPEND_LINES,
    big,
    dbl,
    pct,
    query,
    quo,
)

SPEND = (PART_LINES, SPEND_LINES)
ON_DATE = "JOIN calendar ON date = order_date"
MEDIAN_PO = "quantile_cont(CAST(value * 10000 AS BIGINT), 0.5)"

SQL = {
    "spend_readiness": query("""
        SELECT count(*) AS completed_lines,
               count(*) FILTER (WHERE quantity IS NULL OR unit_price IS NULL)
                 AS missing_qty_or_price,
               count(*) FILTER (WHERE quantity <= 0) AS zero_or_negative_qty,
               count(*) FILTER (WHERE unit_price <= 0) AS zero_or_negative_price,
               count(*) FILTER (WHERE order_date IS NULL) AS missing_order_date
        FROM lines WHERE po_status = 'Completed'""", PART_LINES),
    "spend_kpis": query(f"""
        SELECT {dbl("sum(spend)")} AS total_spend, count(DISTINCT po_id) AS po_count,
               count(DISTINCT vendor_id) AS active_vendors,
               {quo("sum(spend)", "count(DISTINCT po_id)")} AS avg_po_value
        FROM spend_lines""", *SPEND),
    "spend_yoy": query(f"""
        SELECT {big("order_year")} AS order_year, {dbl("spend")} AS spend,
               {dbl("prior")} AS prior_year_spend,
               {pct("spend - prior", "prior")} AS yoy_pct_change
        FROM (SELECT year AS order_year, sum(spend) AS spend,
                     lag(sum(spend)) OVER (ORDER BY year) AS prior
              FROM spend_lines {ON_DATE} GROUP BY year)""", *SPEND, CALENDAR),
    "spend_monthly": query(f"""
        SELECT year_month, {dbl("sum(spend)")} AS spend, count(DISTINCT po_id) AS po_count
        FROM spend_lines {ON_DATE} GROUP BY year_month""", *SPEND, CALENDAR),
    "spend_by_department": query(f"""
        SELECT department, "group", {dbl("sum(spend)")} AS spend,
               {pct("sum(spend)", "sum(sum(spend)) OVER ()")} AS pct_of_total
        FROM spend_lines JOIN departments USING (department_id) GROUP BY ALL""",
                                 *SPEND, DEPARTMENTS),
    "spend_by_category": query(f"""
        SELECT product_category, {dbl("sum(spend)")} AS spend,
               {pct("sum(spend)", "sum(sum(spend)) OVER ()")} AS pct_of_total
        FROM spend_lines JOIN products USING (product_id) GROUP BY ALL""",
                               *SPEND, PART_PRODUCTS),
    "spend_top_subcategories": query(f"""
        SELECT product_category, subcategory, {dbl("sum(spend)")} AS spend
        FROM spend_lines JOIN products USING (product_id) GROUP BY ALL
        ORDER BY sum(spend_lines.spend) DESC, product_category, subcategory LIMIT 10""",
                                     *SPEND, PART_PRODUCTS),
    "spend_category_year": query(f"""
        SELECT product_category, {big("year")} AS order_year, {dbl("sum(spend)")} AS spend
        FROM spend_lines JOIN products USING (product_id) {ON_DATE} GROUP BY ALL""",
                                 *SPEND, PART_PRODUCTS, CALENDAR),
    "spend_reconciliation": query(f"""
        SELECT {dbl("sum(spend)")} AS total_spend,
               {dbl("coalesce(sum(spend) FILTER (WHERE order_date IS NULL), 0)")}
                 AS spend_with_missing_order_date
        FROM spend_lines""", *SPEND),
    "spend_reconciliation_check": query(f"""
        SELECT {dbl("sum(spend)")} AS total_spend,
               {dbl('''sum(spend) FILTER (WHERE order_date IS NULL
                       OR order_date IN (SELECT date FROM calendar))''')} AS sum_of_parts,
               {dbl('''sum(spend) FILTER (WHERE order_date IS NULL
                       OR order_date IN (SELECT date FROM calendar)) - sum(spend)''')}
                 AS difference,
               sum(spend) = sum(spend) FILTER (WHERE order_date IS NULL
                       OR order_date IN (SELECT date FROM calendar)) AS pass
        FROM spend_lines""", *SPEND, CALENDAR),
    "spend_completed_vs_open": query(f"""
        SELECT year_month,
               {dbl("coalesce(sum(v) FILTER (WHERE po_status = 'Completed'), 0)")}
                 AS completed_spend,
               {dbl("coalesce(sum(v) FILTER (WHERE po_status = 'Open'), 0)")} AS open_spend
        FROM (SELECT *, quantity * unit_price AS v FROM lines
              WHERE po_status IN ('Completed', 'Open') AND quantity > 0 AND unit_price > 0)
        {ON_DATE} GROUP BY year_month""", PART_LINES, CALENDAR),
    "spend_ordered_by_year": query(f"""
        SELECT {big("year")} AS year, {dbl("sum(quantity * unit_price)")} AS ordered_spend
        FROM lines {ON_DATE}
        WHERE po_status IN ('Completed', 'Open') AND quantity > 0 AND unit_price > 0
        GROUP BY year""", PART_LINES, CALENDAR),
    "spend_po_value_stats": query(f"""
        SELECT count(*) AS po_count, {quo("sum(value)", "count(*)")} AS mean_po_value,
               {MEDIAN_PO} / 10000 AS median_po_value
        FROM (SELECT po_id, sum(spend) AS value FROM spend_lines GROUP BY po_id)""", *SPEND),
    "spend_dept_category_affinity": query(f"""
        SELECT department, product_category, {dbl("sum(spend)")} AS spend,
               {pct("sum(spend)", "sum(sum(spend)) OVER (PARTITION BY department)")}
                 AS pct_of_department
        FROM spend_lines JOIN departments USING (department_id) JOIN products USING (product_id)
        GROUP BY department, product_category""", *SPEND, DEPARTMENTS, PART_PRODUCTS),
    "spend_affinity_matrix": query(f"""
        SELECT department,
               {", ".join(f"max(pct) FILTER (WHERE product_category = '{c}') AS {c.lower()}"
                          for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))}
        FROM (SELECT department, product_category,
                     {pct("sum(spend)", "sum(sum(spend)) OVER (PARTITION BY department)")} AS pct
              FROM spend_lines JOIN departments USING (department_id)
              JOIN products USING (product_id) GROUP BY department, product_category)
        GROUP BY department""", *SPEND, DEPARTMENTS, PART_PRODUCTS),
    "spend_status_lines_by_month": query(f"""
        SELECT year_month, count(*) AS total_lines,
               count(*) FILTER (WHERE po_status = 'Open') AS open_lines
        FROM lines {ON_DATE} GROUP BY year_month""", PART_LINES, CALENDAR),
}
