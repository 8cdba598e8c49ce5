"""Document fingerprints by one-permutation MinHash, in SQL expressions only.

Each distinct ``size``-word shingle is hashed once. The top bits of the hash choose one of ``BINS`` bins, and a bin
keeps its least hash. Bins that stay empty copy one that is not (optimal densification): bin ``i`` tries the bins
``hash(i, 1), hash(i, 2), ...``; after ``PROBES`` tries it takes, of the filled bins, the one that comes
first in a permutation of its own, which is what going on would find. Of each bin's value, hashed once more with
the bin's number so that copies in several bins do not agree by chance together, the low ``BITS`` bits are
kept, 16 bins to a 64-bit word. Two unequal bins agree on them with probability ``2 ** -BITS``, which the likeness
takes off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .native_text import let
from .store import saved

BINS, BITS, PROBES = 256, 4, 16
PER_WORD = 64 // BITS
BIN_SHIFT = 55  # hashes are made non-negative: 63 bits, the top 8 are the bin
EMPTY = (1 << BIN_SHIFT) - 1
#: Words are runs of characters other than ASCII white space, in lower case.
SPACES, BLANKS = "[\\x20\\x09-\\x0D]+", " \t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    """The words; a text without any gives one empty word, as splitting does."""
    return F.split(F.btrim(F.lower(text), F.lit(BLANKS)), SPACES)


def _shingles(words: Column, size: int) -> Column:
    """One non-negative hash for each shingle; a shorter text is one shingle, no words none."""
    def many(w):
        return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            F.sequence(F.lit(1), F.size(h) - (size - 1)),
            lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(size)]).bitwiseAND((1 << 63) - 1)))

    return let(words, lambda w: F.when(F.size(w) >= size, many(w)).when(
        F.get(w, 0) != "", F.array(F.xxhash64(w).bitwiseAND((1 << 63) - 1))).otherwise(F.array().cast("array<bigint>")))


def _bins(hashes: Column) -> Column:
    """The least hash of every bin, null where there is none: sort, with a last entry for each bin, and take firsts."""
    ends = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.shiftleft(i.cast("long"), BIN_SHIFT) + EMPTY)
    ordered = F.sort_array(F.concat(hashes, ends))
    firsts = let(ordered, lambda o: F.filter(o, lambda x, i: (i == 0) | (x.bitwiseXOR(F.get(o, i - 1)) > EMPTY)))
    return F.transform(firsts, lambda x: F.nullif(x.bitwiseAND(EMPTY), F.lit(EMPTY)))


def _densified(bins: Column) -> Column:
    """Every empty bin takes the first filled one in its own order; null if all are empty."""
    def probe(m, i, step):
        return F.get(m, F.xxhash64(i, F.lit(step)).bitwiseAND(BINS - 1).cast("int"))

    def probed(m):
        return F.transform(m, lambda x, i: F.coalesce(x, *[probe(m, i, step) for step in range(PROBES)]))

    def rest(m0, m):
        filled = F.filter(F.transform(m0, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].isNotNull())
        return let(filled, lambda f: F.transform(m, lambda x, i: F.coalesce(x, F.array_min(F.transform(
            f, lambda s: F.struct(F.xxhash64(i, s["i"], F.lit(-1)).alias("order"), s["x"].alias("x"))))["x"])))

    def full(m0):
        return let(probed(m0), lambda m: F.when(F.exists(m, lambda x: x.isNull()), rest(m0, m)).otherwise(m))

    return let(bins, lambda m: F.when(F.exists(m, lambda x: x.isNotNull()), full(m)))


def fingerprint(text: Column, size: int = 5) -> Column:
    """The packed fingerprint (an array of 64-bit words) of a text; null if it has no words or is null."""
    low = F.transform(_densified(_bins(_shingles(_words(text), size))),
                      lambda x, i: F.xxhash64(x, i).bitwiseAND((1 << BITS) - 1))
    word = lambda v, k: F.aggregate(
        F.slice(v, k * PER_WORD + 1, PER_WORD), F.lit(0).cast("long"),
        lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x))
    return let(low, lambda v: F.when(v.isNotNull(), F.transform(
        F.sequence(F.lit(0), F.lit(BINS // PER_WORD - 1)), lambda k: word(v, k))))


def hexadecimal(packed: Column) -> Column:
    """The fingerprint as text; empty for none."""
    return F.coalesce(F.array_join(F.transform(packed, lambda w: F.lpad(F.hex(w), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets: the share of equal bins less what chance gives.

    Two texts without words are alike (1), one with and one without are not (0).
    """
    ones = int("1" * PER_WORD, 16)

    def unequal(x, y):
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseAND(ones))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    estimate = F.greatest(((1 - differing / BINS) - chance) / (1 - chance), F.lit(0.0))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(estimate)


def next_ids(documents: DataFrame) -> DataFrame:
    """``(doc_id, next_id)`` in ascending order, after the last the first; ids that are null have no place.

    Ranges of ids are sorted apart; the first id of each range follows the last of the range before it.
    """
    ids = documents.where("doc_id is not null").select("doc_id").distinct()
    ranged = saved(ids.repartitionByRange("doc_id").withColumn("task", F.spark_partition_id()), "ids")
    within = Window.partitionBy("task").orderBy("doc_id")
    followed = ranged.withColumn("next", F.lead("doc_id").over(within))
    heads = ranged.groupBy("task").agg(F.min("doc_id").alias("head"))  # one row for each task
    after = heads.withColumn("follower", F.coalesce(F.lead("head").over(Window.orderBy("task")),
                                                    F.min("head").over(Window.partitionBy())))
    return (followed.join(F.broadcast(after.select("task", "follower")), "task")
            .select("doc_id", F.coalesce("next", "follower").alias("next_id")))


def fingerprints(documents: DataFrame, size: int = 5) -> DataFrame:
    """``documents(doc_id, text)`` -> ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` for every row.

    The edited text is the text with its last ``floor(n_chars / 4)`` code points replaced by the first as many (or
    all) of the next document by id; after the last comes the first. A null text is empty, and an empty text's fingerprint is the
    empty string. Rows without an id have no next document: their edited text only loses its tail. Of rows that share an
    id, the one with the least text is the "next" of the document before. Other columns are not read.
    """
    doc_id = F.col("doc_id") if documents.schema["doc_id"].dataType == LongType() else F.col("doc_id").cast("long")
    rows = documents.select(doc_id, F.coalesce("text", F.lit("")).alias("text"))  # no idle cast: it hides that shuffles are equal
    follow = saved(next_ids(rows), "next-ids")
    n_chars = F.char_length("text").cast("long")
    cut = F.floor(n_chars / 4).cast("int")
    wanted = (rows.select("doc_id", cut.alias("cut")).groupBy("doc_id").agg(F.max("cut").alias("cut"))
              .join(follow, "doc_id").select(F.col("doc_id").alias("before"), "cut", "next_id"))
    placed = rows.where("doc_id is not null")  # shuffled by id once, for both joins
    heads = (placed.join(wanted, F.col("doc_id") == F.col("next_id"))
             .groupBy(F.col("before").alias("id")).agg(F.min(F.expr("substring(text, 1, cut)")).alias("head")))
    turns = Window.partitionBy("doc_id").orderBy("text")
    met = (placed.join(heads, F.col("doc_id") == F.col("id"), "left")
           .withColumn("least", F.row_number().over(turns) == 1).select("doc_id", "text", "head", "least")
           .unionAll(rows.where("doc_id is null").select("doc_id", "text", F.lit("").alias("head"), F.lit(False).alias("least"))))
    met = met.withColumn("n_chars", n_chars).withColumn("cut", cut)
    edited = F.concat(F.expr("substring(text, 1, int(n_chars) - cut)"), F.expr("substring(coalesce(head, ''), 1, cut)"))
    both = met.select("doc_id", "n_chars", "least", "text", edited.alias("edited"))
    made = saved(both.select("doc_id", "n_chars", "least", F.sha2("edited", 256).alias("edited_sha256"),
                             fingerprint(F.col("text"), size).alias("own"),
                             fingerprint(F.col("edited"), size).alias("other")), "fingerprints")
    of_next = made.where("least and doc_id is not null").select(F.col("doc_id").alias("next_id"), F.col("own").alias("next_own"))
    following = follow.join(of_next, "next_id").withColumnRenamed("doc_id", "id")
    return (made.join(following, F.col("doc_id") == F.col("id"), "left")
            .select("doc_id", "n_chars", "edited_sha256", hexadecimal(F.col("own")).alias("fingerprint"),
                    hexadecimal(F.col("other")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("other")).alias("near_edited"),
                    likeness(F.col("own"), F.col("next_own")).alias("near_next")))
