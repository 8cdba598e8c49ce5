"""Exact grouped median that scales past one task per group.

``percentile`` keeps a map of all distinct values of a group in one buffer, and
the window form sorts the whole group in one task. Here a mergeable quantile
sketch (KLL, a few kilobytes per group and task) brackets the middle ranks, one exact
count of the rows below, inside and above the bracket tells what it
holds, and the few rows inside are put in order. The result is exact:

* both middle ranks inside: go on there;
* one of them inside, the other on its edge: the two neighbouring values are known from the count;
* both outside: the bracket missed (sketches know rows, not weights), and the side
  that holds them is bracketed again.

A bracket that still holds more than ``ROOM`` distinct values is bracketed again
as well, so no group, however hot, gathers in one task. Brackets and counts are
written - a row per group - because a sketch made again may differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..sources.tables import working_set
from .joins import join_null_safe

#: Distinct values of a group that one task puts in order.
ROOM = 1_000_000
#: Cells of the quantile grid, and size of a sketch (rank error below half a cell).
GRID, SKETCH = 64, 800
#: What is known of a group: middle ranks, weight, bounds of the values still in question, weight before and between them.
SCOPE = ("_first", "_second", "_weight", "_from", "_to", "_base", "_span")


def _inside() -> Column:
    return ((F.col("_from").isNull() | (F.col("_u") >= F.col("_from")))
            & (F.col("_to").isNull() | (F.col("_u") <= F.col("_to"))))


def _sketch() -> Column:
    return F.kll_sketch_agg_bigint("_u", F.lit(SKETCH)).alias("_sketch")


def _bracketed(grids: DataFrame, keys: list[str], margin: int) -> DataFrame:
    """Per group its scope and the values about ``margin`` cells before and after its middle ranks.

    ``grids`` hold a sketch of the values in the group's scope.
    """
    ranks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    share = (F.col("_first") - F.col("_base") - 0.5) / F.col("_span")
    at = F.floor(share * GRID).cast("int") + 1
    grid = F.kll_sketch_get_quantile_bigint("_sketch", ranks)
    return grids.select(
        *keys, *SCOPE, F.element_at(grid, F.greatest(at - margin, F.lit(1))).alias("_lo"),
        F.element_at(grid, F.least(at + 1 + margin, F.lit(GRID + 1))).alias("_hi"))


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Exact weights below and inside the bracket, and the values next to its edges."""
    below, above = F.col("_u") < F.col("_lo"), F.col("_u") > F.col("_hi")
    inside = ~below & ~above

    def weight(part: Column) -> Column:
        return F.coalesce(F.sum(F.when(part, F.col("_n"))), F.lit(0))

    return rows.groupBy(*keys, *SCOPE, "_lo", "_hi").agg(
        weight(below).alias("_below"), weight(inside).alias("_mid"),
        F.max(F.when(below, F.col("_u"))).alias("_under"),
        F.min(F.when(inside, F.col("_u"))).alias("_least"),
        F.max(F.when(inside, F.col("_u"))).alias("_most"),
        F.min(F.when(above, F.col("_u"))).alias("_over"), F.count_if(inside).alias("_rows"))


def _settled(counted: DataFrame, keys: list[str]) -> DataFrame:
    """What the counts say: the two middle values, or where to go on."""
    start = F.col("_base") + F.col("_below")
    end = start + F.col("_mid")
    one, two = F.col("_first"), F.col("_second")
    held = (one > start) & (two <= end)
    low_edge, high_edge = (one == start) & (two > start), (one == end) & (two > end)
    lower = two <= start
    known = held & (F.col("_least") == F.col("_most"))
    after_low = F.coalesce("_least", "_over")
    before_high = F.coalesce("_most", "_under")
    return counted.select(
        *keys, "_first", "_second", "_weight",
        F.when(known, F.col("_least")).when(low_edge, F.col("_under"))
        .when(high_edge, before_high).alias("_m1"),
        F.when(known, F.col("_least")).when(low_edge, after_low)
        .when(high_edge, F.col("_over")).alias("_m2"),
        F.when(held, F.col("_least")).when(~lower, F.col("_over")).otherwise(F.col("_from")).alias("_from"),
        F.when(held, F.col("_most")).when(lower, F.col("_under")).otherwise(F.col("_to")).alias("_to"),
        F.when(held, start).when(lower, F.col("_base")).otherwise(end).alias("_base"),
        F.when(held, F.col("_mid")).when(lower, F.col("_below"))
        .otherwise(F.col("_span") - F.col("_below") - F.col("_mid")).alias("_span"),
        F.when(held, F.least("_rows", F.col("_most") - F.col("_least") + 1)).alias("_room"))


def _scoped(values: DataFrame, scope: DataFrame, keys: list[str]) -> DataFrame:
    """Rows inside the scope of their group."""
    return join_null_safe(values, scope, keys).where(_inside())


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                 weight: str | None = None, count_out: str | None = None,
                 margin: int = 1) -> DataFrame:
    """Median of a decimal column per group (continuous: mean of the middle two).

    ``weight`` counts how many rows a row stands for. NULL values are ignored.
    The result is a decimal with one more digit, so it is exact at every size and value.
    ``df`` is read a few times: pass a table or a working set. ``margin`` is the
    half-width of a bracket in cells of the grid.
    """
    dtype = df.schema[value].dataType
    if not isinstance(dtype, DecimalType) or dtype.precision > 18:
        raise TypeError(f"exact_median needs a decimal of at most 18 digits, got {dtype}")
    unit = 10**dtype.scale
    keys = list(keys)
    values = df.where(F.col(value).isNotNull()).select(
        *keys, (F.col(value) * F.lit(unit)).cast("long").alias("_u"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("_n")).where("_n > 0")
    none = F.lit(None).cast("long")
    whole = values.groupBy(*keys).agg(F.sum("_n").alias("_weight"), _sketch()).where("_weight > 0")
    grids = whole.withColumns({
        "_first": F.expr("(_weight + 1) div 2"), "_second": F.expr("(_weight + 2) div 2"),
        "_from": none, "_to": none, "_base": F.lit(0).cast("long"), "_span": F.col("_weight")})
    done = None
    while True:
        brackets = working_set(_bracketed(grids, keys, margin), "median-brackets")
        counted = _counted(_scoped(values, brackets, keys), keys)
        scope = working_set(_settled(counted, keys), "median-scope")
        small = F.col("_m1").isNotNull() | (F.coalesce("_room", F.lit(ROOM + 1)) <= ROOM)
        settled, open_ = scope.where(small), scope.where(~small)
        done = settled if done is None else done.unionByName(settled)
        if open_.isEmpty():
            break
        rows = _scoped(values, open_.select(*keys, *SCOPE), keys)
        grids = rows.groupBy(*keys).agg(*[F.first(c).alias(c) for c in SCOPE], _sketch())

    result_type = DecimalType(dtype.precision + 1, dtype.scale + 1)
    half = Decimal(1) / (2 * unit)
    found = done.where("_m1 is not null").select(*keys, "_weight", "_m1", "_m2")
    rows = _scoped(values, done.where("_m1 is null").select(*keys, *SCOPE), keys)
    histogram = rows.groupBy(*keys, "_u").agg(
        F.sum("_n").alias("_n"), *[F.first(c).alias(c) for c in ("_first", "_second", "_base", "_weight")])
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_u").rowsBetween(Window.unboundedPreceding, 0))
    ends = histogram.withColumn("_end", F.col("_base") + upto)
    middle = ends.where((F.col("_end") >= F.col("_first")) & (F.col("_end") - F.col("_n") < F.col("_second")))
    grouped = middle.groupBy(*keys, "_weight")
    found = found.unionByName(grouped.agg(F.min("_u").alias("_m1"), F.max("_u").alias("_m2"))
                              .select(*keys, "_weight", "_m1", "_m2"))
    value_out = ((F.col("_m1") + F.col("_m2")).cast("decimal(20,0)") * F.lit(half)).cast(result_type)
    columns = [value_out.alias(out), *([F.col("_weight").alias(count_out)] if count_out else [])]
    if keys:
        return found.select(*keys, *columns)
    # a global aggregate has its one row also without values
    return found.agg(F.max(columns[0]).alias(out), *[F.max("_weight").alias(count_out)] if count_out else [])
