"""View an order-processing schema (lineitem/orders/part/...) as the model.

One order line is one PO line, a supplier is a vendor, the customer's segment
is the buying department. Header and part attributes are attached by left joins
and only when asked for: a line stays a line even if its header is missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import populations as pop
from .calendar import covering_calendar
from .model import ProcurementModel
from .schemas import PURCHASE_ORDERS

# Fixed values of the mapping.
ORDER_STATUS = {"F": pop.COMPLETED, "O": pop.OPEN, "P": pop.CANCELLED}
DAYS_PER_SIZE_UNIT = 20
VENDOR_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CONSUMER_SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD")
REPORT_DATE = date(2001, 8, 31)


# The columns read from each source table.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
}


def open_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Open a source table with its declared schema (no footer has to be read)."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _all_cores(df: DataFrame, scan: DataFrame, *keys: str) -> DataFrame:
    """``df``, dealt out by ``keys`` if ``scan``, which it comes from, has fewer tasks than there are cores.

    For work that is heavy per row: a file with one row group is one task however many
    cores wait. A large table has enough splits and ``df`` is returned as it is. Only the bare scan is
    asked: to count the partitions of ``df`` itself, adaptive execution would run its joins.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if scan.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


# Columns of a line that come from its header, directly or through it.
HEADER_COLUMNS = ("order_date", "expected_delivery_date", "actual_delivery_date", "department_id",
                  "po_status")


def purchase_orders(spark: SparkSession, folder: str, grain: str = "part",
                    need: Iterable[str] = (), statuses: Sequence[str] = (),
                    header: bool = True, by_po: bool = False) -> DataFrame:
    """PO lines. ``grain`` picks the product key: ``part`` or ``brand``.

    Without ``header`` the columns of ``HEADER_COLUMNS`` are left out and no header is joined.
    ``statuses`` keeps lines of some canonical statuses, by the source's own code, so
    that the filter reaches the scan of the headers and is joined from there.

    ``expected_delivery_date`` (needs the part table), ``department_id`` (needs
    the customer table) and the numeric ``order_key`` exist only when listed in
    ``need``, so a query that ignores them does not pay for those joins. Customers are joined
    to the headers, which are fewer than the lines.

    ``by_po`` is for work that groups whole lines: the header is joined last and by ``po_id`` itself. Where that
    join exchanges its sides, the lines come out dealt by a column they are grouped by and are not exchanged again.
    """
    need = set(need)
    orders = open_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("od"))
    how = "left"
    if statuses:
        codes = [code for code, name in ORDER_STATUS.items() if name in statuses]
        orders, how = orders.where(F.col("o_orderstatus").isin(codes)), "inner"
    if "department_id" in need:
        customer = open_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")

    # whole cents and units, so the price is rounded half up without decimal division
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    units = F.col("l_quantity").cast("long")
    lines = open_table(spark, folder, "lineitem").withColumns({
        "_units": units, "_cents": cents, "_shipped": F.col("l_shipdate").cast("date")}).withColumn(
        "_price", F.expr("(2 * _cents + _units) div nullif(2 * _units, 0)"))
    if header and not by_po:
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), how)
    if grain == "brand" or "expected_delivery_date" in need:
        part = open_table(spark, folder, "part").select("p_partkey", "p_brand", "p_size")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    lines = lines.withColumn("po_id", F.col("l_orderkey").cast("string"))
    if header and by_po:
        named_po = orders.withColumn("_po", F.col("o_orderkey").cast("string"))
        # the number is read back from the text, so that a line is not exchanged with both
        lines = lines.drop("l_orderkey").join(named_po, F.col("po_id") == F.col("_po"), how).withColumn(
            "l_orderkey", F.col("po_id").cast("bigint"))

    status = F.col("o_orderstatus")
    named = F.when(status == "F", ORDER_STATUS["F"]).when(status == "O", ORDER_STATUS["O"]).when(
        status == "P", ORDER_STATUS["P"])
    columns = {
        "po_line_id": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
        "po_id": F.col("po_id"),
        "vendor_id": F.col("l_suppkey").cast("string"),
        "product_id": (F.col("p_brand") if grain == "brand"
                       else F.col("l_partkey").cast("string")),
        "quantity": F.col("_units").cast("decimal(10,2)"),
        "unit_price": (F.col("_price").cast("decimal(12,0)") * F.lit(Decimal("0.01")))
        .cast("decimal(10,2)"),
        "currency": F.lit("USD"),
    }
    if header:
        columns |= {
            "order_date": F.col("od"),
            "actual_delivery_date": F.when(status == "F", F.col("_shipped")),
            "po_status": named}
    if "expected_delivery_date" in need:
        columns["expected_delivery_date"] = F.date_add(
            F.col("od"), F.col("p_size") * DAYS_PER_SIZE_UNIT)
    if "department_id" in need:
        columns["department_id"] = F.col("c_mktsegment")
    if "order_key" in need:
        columns["order_key"] = F.col("l_orderkey")
    return lines.select(*[c.alias(name) for name, c in columns.items()])


def vendors(spark: SparkSession, folder: str) -> DataFrame:
    nation = open_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = open_table(spark, folder, "region").select("r_regionkey", "r_name")
    choices = F.array(*[F.lit(c) for c in VENDOR_CATEGORIES])
    return (
        open_table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("s_suppkey").cast("string").alias("vendor_id"),
            F.col("s_name").alias("vendor_name"),
            F.element_at(choices, (F.col("s_suppkey") % len(VENDOR_CATEGORIES) + 1).cast("int"))
            .alias("vendor_category"),
            F.col("r_name").alias("region"),
            F.date_add(F.lit(date(1990, 1, 1)), (F.col("s_suppkey") % 1000).cast("int"))
            .alias("vendor_start_date"),
            F.when(F.col("s_acctbal") < 0, "Inactive").otherwise("Active").alias("vendor_status"),
        )
    )


def products(spark: SparkSession, folder: str, grain: str = "part") -> DataFrame:
    """One row per part, or per brand with its most frequent part type as category."""
    part = open_table(spark, folder, "part")
    unit = F.split_part("p_name", F.lit(" "), F.lit(2))
    cost = F.col("p_retailprice").cast("decimal(10,2)")
    if grain == "part":
        return part.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.col("p_brand").alias("subcategory"),
            cost.alias("standard_cost"), unit.alias("unit_of_measure"))
    per_type = part.groupBy("p_brand", "p_type").agg(
        F.count(F.lit(1)).alias("n"), F.min(cost).alias("cost"), F.min(unit).alias("unit"))
    return per_type.groupBy("p_brand").agg(
        F.min_by("p_type", F.struct(-F.col("n"), "p_type")).alias("product_category"),
        F.min("cost").alias("standard_cost"), F.min("unit").alias("unit_of_measure"),
    ).select(
        F.col("p_brand").alias("product_id"), F.col("p_brand").alias("product_name"),
        "product_category", F.col("p_brand").alias("subcategory"),
        "standard_cost", "unit_of_measure")


def departments(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return open_table(spark, folder, "customer").select("c_mktsegment").distinct().select(
        segment.alias("department_id"), segment.alias("department"),
        F.when(segment.isin(*CONSUMER_SEGMENTS), "Consumer").otherwise("Industrial")
        .alias("group"))


def calendar(spark: SparkSession, folder: str, week: str = "iso") -> DataFrame:
    """All days from the year of the first order to the month of the last one."""
    return covering_calendar(open_table(spark, folder, "orders"), "o_orderdate", week)


def procurement_model(spark: SparkSession, folder: str, grain: str = "part",
                      need: Iterable[str] = ()) -> ProcurementModel:
    return ProcurementModel(
        lines_of=lambda statuses: purchase_orders(spark, folder, grain, need, statuses),
        fact=lambda: purchase_orders(spark, folder, grain, need),
        vendors=lambda: vendors(spark, folder),
        products=lambda: products(spark, folder, grain),
        departments=lambda: departments(spark, folder),
        calendar=lambda: calendar(spark, folder),
    )


# Which order keys carry which defect in the staging view.
DEFECT_COPY, DEFECT_NO_PRICE, DEFECT_NO_QUANTITY, DEFECT_NO_EXPECTED = 143, 197, 191, 211
DEFECT_NEGATIVE_PRICE, DEFECT_ZERO_QUANTITY, DEFECT_BAD_DATE, DEFECT_SPELLING = 499, 503, 601, 67
BAD_DATE_TEXT = "2024-13-45"
CURRENCY_VARIANTS = ("usd", "US Dollar", "Usd", " USD")
STATUS_VARIANTS = {
    pop.COMPLETED: ("completed", "COMPLETED", "Completed "),
    pop.OPEN: ("open", "OPEN", "Open "),
    pop.CANCELLED: ("cancelled", "CANCELLED", "Canceled"),
}


def staging_lines(spark: SparkSession, folder: str,
                  columns: Sequence[str] = PURCHASE_ORDERS.names, grain: str = "part") -> DataFrame:
    """PO lines as untyped text, with defects at fixed order keys.

    The whole table passes through; the arithmetic only decides which lines get
    a defect, so that auditing and cleaning have something to find. Only tables that
    ``columns`` come from are opened.
    """
    joined = {"expected_delivery_date", "department_id"} & set(columns)
    fact = purchase_orders(spark, folder, grain, ("order_key", *joined),
                           header=not set(columns).isdisjoint(HEADER_COLUMNS), by_po=True)
    fact = _all_cores(fact, open_table(spark, folder, "lineitem"), "po_line_id")
    key = F.col("order_key")

    def hit(divisor: int):
        return key % divisor == 0

    def pick(options: tuple[str, ...]):
        chosen = (F.floor(key / DEFECT_SPELLING) % len(options) + 1).cast("int")
        return F.element_at(F.array(*[F.lit(o) for o in options]), chosen)

    price = F.when(hit(DEFECT_NO_PRICE), F.lit("")).otherwise(F.col("unit_price").cast("string"))
    price = F.when(hit(DEFECT_NEGATIVE_PRICE) & (price != ""), F.concat(F.lit("-"), price)
                   ).otherwise(price)
    quantity = F.when(hit(DEFECT_ZERO_QUANTITY), F.lit("0")).when(
        ~hit(DEFECT_NO_QUANTITY), F.col("quantity").cast("string"))
    def misspelt():
        status = F.col("po_status")
        for canonical, options in STATUS_VARIANTS.items():
            status = F.when(hit(DEFECT_SPELLING) & (F.col("po_status") == canonical), pick(options)
                            ).otherwise(status)
        return status

    defective = {
        "order_date": lambda: F.when(hit(DEFECT_BAD_DATE), BAD_DATE_TEXT)
        .otherwise(F.col("order_date").cast("string")),
        "expected_delivery_date": lambda: F.when(hit(DEFECT_NO_EXPECTED), F.lit(""))
        .otherwise(F.col("expected_delivery_date").cast("string")),
        "actual_delivery_date": lambda: F.col("actual_delivery_date").cast("string"),
        "quantity": lambda: quantity, "unit_price": lambda: price,
        "currency": lambda: F.when(hit(DEFECT_SPELLING), pick(CURRENCY_VARIANTS))
        .otherwise(F.col("currency")),
        "po_status": misspelt,
    }
    copies = F.when(hit(DEFECT_COPY), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return fact.select(
        *[defective[c]().alias(c) if c in defective else F.col(c) for c in columns],
        F.explode(copies).alias("_copy")).drop("_copy")


def staging_dimension(df: DataFrame) -> DataFrame:
    """A dimension as untyped, padded text, as an import would deliver it."""
    return df.select(*[F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" ")).alias(c)
                       for c in df.columns])
