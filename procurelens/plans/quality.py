"""Audit of the untyped staging table and of the dimensions. Nothing is changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..functions.measures import percent, ratio
from ..operators.reshape import unpivot_metrics
from ..operators.shares import share_of_total
from ..sources.model import ProcurementModel
from ..sources.schemas import PURCHASE_ORDERS

LINE_COLUMNS = tuple(PURCHASE_ORDERS.names)
LINE_ID, PO_ID = "po_line_id", "po_id"
DATE_COLUMNS = ("order_date", "expected_delivery_date", "actual_delivery_date")
# foreign key -> dimension attribute of the model
FOREIGN_KEYS = {"vendor_id": "vendors", "product_id": "products",
                "department_id": "departments", "order_date": "calendar"}


def _rows(alias: str = "rows") -> Column:
    return F.count(F.lit(1)).alias(alias)


def exact_duplicates(staging: DataFrame, columns: Sequence[str] = LINE_COLUMNS) -> DataFrame:
    """Groups of rows that agree in every column, with the number of copies."""
    return staging.groupBy(*columns).agg(_rows("copies")).where(F.col("copies") > 1)


def missing_counts(staging: DataFrame, columns: Sequence[str] = (
        "unit_price", "quantity", "expected_delivery_date")) -> DataFrame:
    """NULL or blank values per column, counted in one scan."""
    counted = staging.agg(*[F.count_if(p.is_missing(c)).alias(c) for c in columns])
    return _long(counted, columns, "missing")


def invalid_values(staging: DataFrame) -> DataFrame:
    price, quantity = p.parse_decimal("unit_price"), p.parse_decimal("quantity")
    return staging.agg(
        F.count_if(price < 0).alias("negative_unit_price"),
        F.count_if(quantity <= 0).alias("zero_or_negative_quantity"))


def domain_profile(staging: DataFrame) -> DataFrame:
    """How often each raw spelling of a categorical column occurs, with its canonical value."""
    domains = {"currency": p.CURRENCY_SPELLINGS, "po_status": p.STATUS_SPELLINGS}
    entries = F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).alias("raw_value"),
                 p.standardise(name, spellings).alias("normalised_value"))
        for name, spellings in domains.items()])
    return (staging.select(F.explode(entries).alias("e")).select("e.*")
            .groupBy("column", "raw_value", "normalised_value").agg(_rows()))


def malformed_dates(staging: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Text that is present but no date. Missing text is a separate defect."""
    counted = staging.agg(*[F.count_if(p.is_malformed_date(c)).alias(c) for c in columns])
    return _long(counted, columns, "malformed")


def delivery_before_order(staging: DataFrame) -> DataFrame:
    early = p.parse_date("actual_delivery_date") < p.parse_date("order_date")
    return staging.agg(F.count_if(early).alias("delivery_before_order"))


def id_collisions(staging: DataFrame, key: str = LINE_ID,
                  columns: Sequence[str] = LINE_COLUMNS) -> DataFrame:
    """Line ids that stand on rows which are not copies of each other.

    Blank and NULL count as the same version.

    Rows are grouped by the plain PO id first, as staging is dealt by it; what goes on of a group is its key and its
    copies. Each group is a version, but groups without a PO id (NULL or blank), which are compared as a whole.
    """
    blank = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns if c != key}
    version = F.struct(*blank.values())
    own = [c for c in (PO_ID,) if c in blank]
    groups = staging.groupBy(key, *own, *[v for c, v in blank.items() if c not in own]).agg(_rows("_copies"))
    unsure = F.coalesce(F.col(PO_ID), F.lit("")) == "" if own else F.lit(False)
    return (groups.groupBy(key)
            .agg(F.sum("_copies").alias("row_count"),
                 (F.count_if(~unsure) + F.count_distinct(F.when(unsure, version))).alias("distinct_versions"))
            .where(F.col("distinct_versions") > 1))


def orphan_keys(model: ProcurementModel) -> DataFrame:
    """Fact keys without a dimension row, per dimension, in one pass over the fact.

    Lines without a key at all (NULL) are missing values, not orphans.
    """
    used = F.array(*[
        F.struct(F.lit(dim).alias("dimension"), F.col(key).cast("string").alias("key"))
        for key, dim in FOREIGN_KEYS.items()])
    keys = (model.fact.select(F.explode(used).alias("u")).select("u.*")
            .where(F.col("key").isNotNull())
            .groupBy("dimension", "key").agg(_rows("lines")))
    known = None
    for key, dim in FOREIGN_KEYS.items():
        column = "date" if dim == "calendar" else key
        part = getattr(model, dim).select(
            F.lit(dim).alias("dimension"), F.col(column).cast("string").alias("key"))
        known = part if known is None else known.unionByName(part)
    missing = keys.join(known.withColumn("known", F.lit(True)), ["dimension", "key"], "left")
    orphan = F.col("known").isNull()
    return missing.groupBy("dimension").agg(
        F.count_if(orphan).alias("orphan_keys"),
        F.sum(F.when(orphan, F.col("lines")).otherwise(0)).alias("orphan_lines"))


def dimension_checks(staged: dict[str, DataFrame], casts: dict[str, dict[str, str]]) -> DataFrame:
    """Health of staged dimensions: rows, repeated or blank keys, padding, failed casts.

    ``staged`` maps a name to a text table whose first column is its key;
    ``casts`` names the non-text columns and their types per table.
    """
    result = None
    for name, df in staged.items():
        key, typed = df.columns[0], casts.get(name, {})
        failed = F.lit(0)
        for column, dtype in typed.items():
            parsed = (p.parse_date(column) if dtype == "date"
                      else p.clean_text(column).try_cast(dtype))
            failed = failed + F.when(p.clean_text(column).isNotNull() & parsed.isNull(), 1
                                     ).otherwise(0)
        padded = F.lit(False)
        for column in df.columns:
            padded = padded | F.coalesce(F.col(column) != F.trim(column), F.lit(False))
        row = df.agg(
            _rows(),
            (F.count(p.clean_text(key)) - F.count_distinct(p.clean_text(key)))
            .alias("duplicate_keys"),
            F.count_if(p.is_missing(key)).alias("blank_keys"),
            F.count_if(padded).alias("padded_rows"),
            F.coalesce(F.sum(failed), F.lit(0)).alias("failed_casts"),
        ).select(F.lit(name).alias("dimension"), "*")
        result = row if result is None else result.unionByName(row)
    return result


def calendar_gaps(calendar: DataFrame) -> DataFrame:
    """Days present, days expected between the first and the last, and the difference."""
    span = F.datediff(F.max("date"), F.min("date")) + 1
    return calendar.agg(
        F.count_distinct("date").alias("days"), span.alias("days_expected"),
        (span - F.count_distinct("date")).alias("missing_days"))


def conditional_nulls(staging: DataFrame) -> DataFrame:
    """Missing actual dates per status: normal for lines that were never delivered."""
    missing = F.count_if(p.is_missing("actual_delivery_date"))
    return (staging
            .groupBy(p.standardise("po_status", p.STATUS_SPELLINGS).alias("po_status"))
            .agg(_rows("lines"), missing.alias("missing_actual"))
            .withColumn("missing_pct", percent("missing_actual", "lines")))


def table_counts(staging: DataFrame) -> DataFrame:
    return (staging.agg(_rows("lines"), F.count_distinct("po_id").alias("purchase_orders"))
            .withColumn("lines_per_po", ratio("lines", "purchase_orders")))


def status_mix(staging: DataFrame) -> DataFrame:
    counted = (staging
               .groupBy(p.standardise("po_status", p.STATUS_SPELLINGS).alias("po_status"))
               .agg(_rows("lines")))
    return share_of_total(counted, "lines", "pct_of_lines")


def _long(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    return unpivot_metrics(one_row, [], columns, "column", value).withColumn(
        value, F.col(value).cast("long"))
