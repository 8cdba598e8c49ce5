"""A Bloom filter of keys as a small table, for semi and anti joins that shuffle few rows.

The filter has a fixed number of 64-bit words whatever the data, so it may be
broadcast at any size. It lets rows pass that are not in the set (more of them the
fuller it is) and never holds one back that is: an exact join of what passes follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the filter (8 bytes each, one megabyte in all) and hash functions.
WORDS, HASHES = 1 << 17, 2


def _place(key: str, which: int) -> tuple[Column, Column]:
    """Word and bit of a key; NULL is a key like any other.

    The word is plainly not null, so that no test for it is pushed below what ``key`` comes from.
    """
    spread = F.xxhash64(F.col(key), F.lit(which))
    return F.coalesce(F.pmod(spread, F.lit(WORDS)), F.lit(0)), F.pmod(F.shiftrightunsigned(spread, 40), F.lit(64)).cast("int")


def bloom_filter(df: DataFrame, key: str) -> DataFrame:
    """``(word, bits)`` of the keys of ``df``; every task sends a record per word at most."""
    places = F.array(*[F.struct(word.alias("word"), bit.alias("bit"))
                       for word, bit in (_place(key, i) for i in range(HASHES))])
    bits = F.expr("shiftleft(1L, p.bit)")
    return df.select(F.explode(places).alias("p")).groupBy(F.col("p.word").alias("word")).agg(
        F.bit_or(bits).alias("bits"))


def _looked_up(df: DataFrame, key: str, filter_: DataFrame, which: int, how: str) -> tuple[DataFrame, Column]:
    """``df`` with the word of its key, and whether the key's bit is set there (NULL: no such word)."""
    word, bit = _place(key, which)
    known = F.broadcast(filter_.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    return (df.withColumn("_at", word).join(known, F.col("_at") == F.col("_word"), how),
            F.getbit(F.col("_bits"), bit) == 1)


def may_be_in(df: DataFrame, key: str, filter_: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be among those of ``bloom_filter``."""
    out = df
    for i in range(HASHES):
        found, is_set = _looked_up(out, key, filter_, i, "inner")
        out = found.where(is_set).select(*df.columns)
    return out


def mark_may_be_in(df: DataFrame, key: str, filter_: DataFrame, out: str) -> DataFrame:
    """All rows of ``df``, with a column ``out`` that is true where ``may_be_in`` lets a row pass, else false."""
    marked = df.withColumn(out, F.lit(True))
    for i in range(HASHES):
        found, is_set = _looked_up(marked, key, filter_, i, "left")
        marked = found.withColumn(out, F.col(out) & F.coalesce(is_set, F.lit(False))).select(*df.columns, out)
    return marked
