"""Order-based operators: top-k, positions, running totals, tiles.

A window without partition keys - or over one hot key - sorts everything in one
task. ``ordered_position`` is a distributed prefix sum instead, the same at
every size: rows are dealt into ranges of the whole order (group, value, tie), so
that even rows of one identical value lie in many ranges; each range is reduced to
one count and one sum per column; running totals over ranges - a row each - say where a
range begins; and rows are numbered inside their range from there.

The ranges are written once: their borders come from a sample, and a task that
is run again must find the layout that the totals describe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import working_set
from .joins import join_null_safe


def top_k(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] = (),
          method: str = "row_number", out: str | None = None) -> DataFrame:
    """First ``k`` rows by ``order``, overall or per group.

    End ``order`` with a unique column: without it ties at the cut are
    arbitrary. Per-group limits are applied before the shuffle as well.
    """
    if not by:
        return df.orderBy(*order).limit(k)
    rank = F.rank() if method == "rank" else F.row_number()
    name = out or "_position"
    ranked = df.withColumn(name, rank.over(Window.partitionBy(*by).orderBy(*order)))
    kept = ranked.where(F.col(name) <= k)
    return kept if out else kept.drop(name)


def tie_order(columns: Sequence[str]) -> Column:
    """Uniform, reproducible order for rows that tie: a hash of their ids."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def _ranged(df: DataFrame, value: str, tie: list[str], by: list[str],
            descending: bool) -> DataFrame:
    """Rows with the number of their range, numbers following the order."""
    direction = F.col(value).desc() if descending else F.col(value).asc()
    keyed = df.select("*", tie_order(tie).alias("_tie"))
    dealt = keyed.repartitionByRange(*map(F.col, by), direction, F.col("_tie"), *map(F.col, tie))
    return working_set(dealt.withColumn("_range", F.spark_partition_id()), "ordered-ranges")


def _range_starts(ranged: DataFrame, value: str, by: list[str], descending: bool,
                  measures: dict[str, Column]) -> DataFrame:
    """One row per group and range: what lies before it, and where its first value began.

    ``_off<m>`` and ``_all<m>`` are sums of measure ``m`` before the range and over
    the group. The first value of a range may have begun in an earlier one: in
    the first of those whose last value it is.
    """
    cells = ranged.groupBy(*by, "_range", value).agg(
        *[F.sum(e).alias(m) for m, e in measures.items()])
    lowest, highest = F.min(value), F.max(value)
    # NULLs come first in ascending and last in descending order
    edge = F.sum(F.when(F.col(value).isNull(), F.col("_n")))
    if descending:
        first, last, last_n = highest, F.when(edge.isNull(), lowest), F.coalesce(
            edge, F.min_by("_n", value))
    else:
        first, last, last_n = F.when(edge.isNull(), lowest), highest, F.coalesce(
            F.max_by("_n", value), edge)
    ranges = cells.groupBy(*by, "_range").agg(
        *[F.sum(m).alias(m) for m in measures], first.alias("_first"), last.alias("_last"),
        last_n.alias("_last_n"))

    group = Window.partitionBy(*by)
    in_order = group.orderBy("_range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "*", *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_off{m}") for m in measures],
        *[F.sum(m).over(group).alias(f"_all{m}") for m in measures])
    began = F.min(F.col("_off_n") + F.col("_n") - F.col("_last_n")).over(
        Window.partitionBy(*by, "_last"))
    ranges = ranges.withColumn("_began", began)
    goes_on = (F.lag("_n").over(in_order).isNotNull()
               & F.lag("_last").over(in_order).eqNullSafe(F.col("_first")))
    start = F.when(goes_on, F.lag("_began").over(in_order)).otherwise(F.col("_off_n"))
    return ranges.select(*by, "_range", "_first", start.alias("_first_start"),
                         *[c for m in measures for c in (f"_off{m}", f"_all{m}")])


def ordered_position(df: DataFrame, value: str, tie: Sequence[str], by: Sequence[str] = (),
                     descending: bool = True, running: Sequence[str] = ()) -> DataFrame:
    """Number rows by ``value`` and accumulate ``running`` columns in that order.

    Adds ``position`` (row number), ``tie_rank`` (rank with ties),
    ``group_rows``, and per running column ``running_<c>`` and ``total_<c>``
    (NULLs add nothing). Ties follow a hash of ``tie``, then ``tie``.
    """
    tie, by = list(tie), list(by)
    measures = {"_n": F.lit(1).cast("long"), **{f"_s_{c}": F.col(c) for c in running}}
    ranged = _ranged(df, value, tie, by, descending)
    starts = _range_starts(ranged, value, by, descending, measures)
    direction = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*by, "_range")
    in_order = inside.orderBy(direction, "_tie", *tie)
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = join_null_safe(ranged, starts, [*by, "_range"])
    rank = F.col("_off_n") + F.rank().over(inside.orderBy(direction))
    return placed.select(
        *df.columns,
        (F.col("_off_n") + F.row_number().over(in_order)).alias("position"),
        F.when(F.col(value).eqNullSafe(F.col("_first")), F.col("_first_start") + 1)
        .otherwise(rank).alias("tie_rank"),
        F.col("_all_n").alias("group_rows"),
        *[(F.col(f"_off_s_{c}") + F.coalesce(F.sum(c).over(upto), F.lit(0)))
          .alias(f"running_{c}") for c in running],
        *[F.col(f"_all_s_{c}").alias(f"total_{c}") for c in running])


def _tile(position: Column, rows: Column, n: int) -> Column:
    """Tile (1 to ``n``) of a 1-based position; the first ``rows % n`` tiles hold one row more."""
    def div(a: Column, b: Column) -> Column:
        return (a - F.pmod(a, b)) / b  # whole longs below 2**53, so exact

    size, extra = div(rows, F.lit(n)), rows % n
    boundary = extra * (size + 1)
    index = position - 1
    tile = F.when(index < boundary, div(index, size + 1)).otherwise(
        extra + div(index - boundary, F.greatest(size, F.lit(1.0)))) + 1
    return tile.cast("int")


def tile_totals(df: DataFrame, n: int, by: Sequence[str], order: str, tie: Sequence[str],
                sums: dict[str, Column], out: str = "tile") -> DataFrame:
    """Row counts and sums of each of ``n`` near-equal tiles of every group.

    Tiles follow ``order`` as SQL's NTILE does; ties follow a hash of ``tie``, then
    ``tie``. Returns ``by, out, lines, <sums>``.

    Rows are counted per distinct value of ``order``, and running counts tell the
    tile of every value that no border cuts. Only the rows of values
    that a border cuts, ``n - 1`` a group at most, are ordered.
    """
    by = list(by)
    cell = df.groupBy(*by, order).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(e).alias(c) for c, e in sums.items()])
    placed = ordered_position(cell, order, [], by=by, descending=False, running=["_rows"])
    before = F.col("running__rows") - F.col("_rows")
    placed = placed.withColumns({
        "_before": before, out: _tile(before + 1, F.col("total__rows"), n),
        "_until": _tile(F.col("running__rows"), F.col("total__rows"), n)})
    whole = placed.where(F.col(out) == F.col("_until")).select(
        *by, out, F.col("_rows").alias("lines"), *sums)

    cut = placed.where(F.col(out) != F.col("_until")).select(
        *by, order, "_before", F.col("total__rows").alias("_total"))
    rows = join_null_safe(
        df.select(*dict.fromkeys([*by, order, *tie]), *[e.alias(f"_m_{c}") for c, e in sums.items()]),
        cut, [*by, order]).withColumn("_same", F.lit(0))
    ordered = ordered_position(rows, "_same", tie, by=[*by, order])
    parts = ordered.select(
        *by, _tile(F.col("_before") + F.col("position"), F.col("_total"), n).alias(out),
        F.lit(1).cast("long").alias("lines"), *[F.col(f"_m_{c}").alias(c) for c in sums])
    return whole.unionByName(parts).groupBy(*by, out).agg(
        F.sum("lines").alias("lines"), *[F.sum(c).alias(c) for c in sums])
