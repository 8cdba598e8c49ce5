"""Staging to cleaned tables.

Rows are removed only if an intact copy remains: exact duplicates, and faulty
versions of a line id that also exists in a sound version. Invalid values on
otherwise unique lines stay (unparseable ones as NULL) and are excluded by the
analytical populations instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..operators.bloom import bloom_filter, mark_may_be_in, may_be_in
from ..operators.joins import unique_rows
from ..sources.schemas import CALENDAR, DEPARTMENTS, PRODUCTS, PURCHASE_ORDERS, VENDORS
from .quality import LINE_COLUMNS, LINE_ID


def deduplicate(staging: DataFrame) -> DataFrame:
    """Keep one of each set of rows equal in all columns of a staging line.

    A badness score, if already there, depends on the other columns only.

    Copies collapse within every task before the shuffle, so a row repeated a
    billion times costs one record per task.
    """
    return staging.distinct()


def badness() -> Column:
    """Number of defects of a staging row, 0 to 5."""
    flaws = [
        p.parse_decimal("unit_price").isNull(),
        p.parse_decimal("quantity").isNull(),
        p.parse_date("order_date").isNull(),
        p.parse_date("expected_delivery_date").isNull(),
        F.coalesce(p.parse_date("actual_delivery_date") < p.parse_date("order_date"),
                   F.lit(False)),
    ]
    score = F.lit(0)
    for flaw in flaws:
        score = score + flaw.cast("int")
    return score


def with_badness(staging: DataFrame) -> DataFrame:
    return staging.withColumn("badness_score", badness())


def resolve_collisions(df: DataFrame, key: str, score: str) -> DataFrame:
    """Drop faulty rows of a key that also has a sound row.

    Sound rows (score 0) always stay, also several per key: choosing between
    them would be a guess, ``id_collisions`` reports them. If a key has faulty
    rows only, the least faulty one stays (ties: smallest column values).

    Of faulty rows the ids are exchanged first, of sound rows only ids that a Bloom filter of
    these lets pass. They tell which ids are contested: several faulty rows, or a sound one as well. Only
    faulty rows whose id passes a filter of the contested ones are exchanged whole and compared, each id
    being one record per task before; all other rows pass through unshuffled.
    """
    payload = [c for c in df.columns if c not in (score, key)]  # the key is the group's
    keyed = df.withColumn("_key", F.struct(key))  # never null, so rows without an id meet as well
    is_sound, is_faulty = F.col(score) == 0, F.col(score) > 0
    ids = keyed.where(is_faulty).groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    any_ = bloom_filter(ids.where("_rows > 0"), "_key")  # with the count, so that both readers of the ids share one exchange
    met = may_be_in(keyed.where(is_sound).select("_key"), "_key", any_).distinct()
    contested = ids.join(met.withColumn("_met", F.lit(True)), "_key", "left").where("_rows > 1 or _met")
    marked = mark_may_be_in(keyed, "_key", bloom_filter(contested, "_key"), "_suspect")
    settled = marked.where(is_sound | (is_faulty & ~F.col("_suspect"))).select(*df.columns)
    best = marked.where(is_faulty & F.col("_suspect")).groupBy("_key").agg(
        F.min(F.struct(score, *payload)).alias("_best"))
    rescued = best.join(met, "_key", "left_anti").select("_key.*", "_best.*")
    return settled.unionByName(rescued)


def typed_lines(staging: DataFrame) -> DataFrame:
    """Parse every column and fold spellings to the canonical value."""
    parsers = {
        "order_date": p.parse_date, "expected_delivery_date": p.parse_date,
        "actual_delivery_date": p.parse_date,
        "quantity": p.parse_decimal, "unit_price": p.parse_decimal,
        "currency": lambda c: p.standardise(c, p.CURRENCY_SPELLINGS),
        "po_status": lambda c: p.standardise(c, p.STATUS_SPELLINGS),
    }
    return staging.select(*[
        parsers.get(f.name, p.clean_text)(f.name).cast(f.dataType).alias(f.name)
        for f in PURCHASE_ORDERS])


def clean_fact(staging: DataFrame) -> DataFrame:
    """Deduplicate, resolve id collisions, type and standardise.

    Staging is read and exchanged once: the score is an aggregate of the
    deduplication, so no branch of the collision step filters before it, and all of
    them read the same exchange.
    """
    scored = staging.groupBy(*LINE_COLUMNS).agg(F.max(badness()).alias("badness_score"))
    return typed_lines(resolve_collisions(scored, LINE_ID, "badness_score"))


def _clean_dimension(staged: DataFrame, schema) -> DataFrame:
    parse = {"date": p.parse_date}
    return staged.select(*[
        parse.get(f.dataType.simpleString(),
                  lambda c, t=f.dataType.simpleString(): p.clean_text(c).try_cast(t))(f.name)
        .alias(f.name)
        for f in schema])


def clean_department(staged: DataFrame) -> DataFrame:
    return unique_rows(_clean_dimension(staged, DEPARTMENTS), ["department_id"], "departments")


def clean_vendor(staged: DataFrame) -> DataFrame:
    return unique_rows(_clean_dimension(staged, VENDORS), ["vendor_id"], "vendors")


def clean_product(staged: DataFrame) -> DataFrame:
    return unique_rows(_clean_dimension(staged, PRODUCTS), ["product_id"], "products")


def clean_calendar(staged: DataFrame) -> DataFrame:
    return unique_rows(_clean_dimension(staged, CALENDAR), ["date"], "calendar")
