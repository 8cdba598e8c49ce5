"""Join helpers.

No side is broadcast by hint unless it has one row by construction. For all
other joins Spark compares the known file size (static) or the finished shuffle
size (adaptive) with ``spark.sql.autoBroadcastJoinThreshold`` and falls back to
a sort-merge join, whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a global aggregate (exactly one row) to every row."""
    return df.crossJoin(F.broadcast(one_row))


def describe(df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str],
             how: str = "inner") -> DataFrame:
    """Attach descriptive dimension columns. Call it after aggregating by ``key``."""
    return df.join(dim.select(key, *columns), key, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in a window."""
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    condition = None
    for key in keys:
        test = F.col(key).eqNullSafe(F.col(f"__{key}"))
        condition = test if condition is None else condition & test
    if condition is None:
        return left.crossJoin(renamed)
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def unique_rows(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` as it is, but an error when it is read if a key is missing or stands on two rows.

    Rows are reduced to one per key in every task first; a lookup by these keys
    afterwards finds them already dealt out by key.
    """
    keys, rest = list(keys), [c for c in df.columns if c not in keys]
    columns = [F.first(F.struct(*rest)).alias("_row")] if rest else []
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *columns)
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("missing")) for k in keys])
    sound = F.col("_rows") == 1
    for key in keys:
        sound = sound & F.col(key).isNotNull()
    message = F.concat(F.lit(f"{what}: key ("), shown, F.lit(") is no key: "), F.col("_rows").cast("string"), F.lit(" rows"))
    checked = grouped.where(F.when(sound, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c)
                            for c in df.columns])
