"""Passages of documents that copy benchmark items, also paraphrased or edited.

Items and passages are aligned by Smith-Waterman over words: matches score 1, mismatches and gaps cost
``COST``. The best score over the item's length in words is the likeness.

Only places that may reach it are aligned, and none that does is left out. An item's *grams* are its words and
its pairs of neighbouring words. An alignment with m matched words in r unbroken runs matches m words and m - r
pairs, and each break between runs costs ``COST`` = 1/2 at least; so one of likeness s matches at least
``2 * s * length - 1`` of the ``2 * length - 1`` grams, within a span of bounded length. Hence at least k of any
``needed + k`` grams, where the alignment may miss ``needed`` of them. The rarest ones in the whole corpus are the
item's *seeds*: mostly pairs, and words where a pair is common or all pairs may be cut apart. Every k is sound; each item takes the one that
costs least by its grams' corpus counts.

Grams are counted in the corpus, and those of the seeds are found there and joined to them by hash. Tasks get only
bitmaps of the grams, which are bounded in size and let no gram through unseen; places that hold enough seeds are
joined to their texts and items and aligned there.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .wordhash import LETTERS, U, Words, lists, mix, signed, slices, split_words

COST, LIKENESS = 0.5, 0.5
#: Only for speed: what a place costs next to one seed found in the corpus.
PLACE = 20
#: A bitmap has 16 bits for each gram, within these bounds (as powers of two). Fuller ones let more grams through to the join.
MIN_BITS, MAX_BITS = 16, 28


class _Bitmap(NamedTuple):
    """Which leading ``bits`` of gram hashes occur."""

    bits: int
    words: np.ndarray

    @classmethod
    def of(cls, grams: DataFrame) -> _Bitmap:
        """At most ``2**(MAX_BITS - 6)`` numbers reach the driver."""
        bits = min(MAX_BITS, max(MIN_BITS, (16 * grams.count()).bit_length()))
        cell = F.shiftrightunsigned("gram", 64 - bits)
        slots = grams.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("slot")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("word")).toArrow()
        words = np.zeros(1 << (bits - 6), np.int64)
        words[slots["slot"].to_numpy()] = slots["word"].to_numpy()
        return cls(bits, words.view(U))

    def has(self, grams: np.ndarray) -> np.ndarray:
        cell = grams >> U(64 - self.bits)
        return (self.words[(cell >> U(6)).astype(np.int64)] >> (cell & U(63)) & U(1)).astype(bool)


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash of every two words in a row; only places to align hang on it, so that a collision costs time and no result."""
    return mix(hashes[:-1] * U(0x9E3779B97F4A7C15) + hashes[1:])


def _pairs(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs of neighbouring words of one text, and the place of their first word."""
    pairs = pair_hashes(hashes)
    inside = np.ones(len(pairs), bool)
    border = words.offsets[1:-1]
    inside[border[(border > 0) & (border < len(hashes))] - 1] = False
    at = np.flatnonzero(inside)
    return pairs[at], at


def _items(benchmark: DataFrame) -> DataFrame:
    """``(item_id, words)``: word hashes in order; equal texts count once, by least id."""
    texts = benchmark.where("item_id is not null and text is not null").groupBy("text").agg(
        F.min("item_id").cast("long").alias("item_id"))

    def run(batches):
        for part in slices(batches):
            words = split_words(part.column("text"), LETTERS)
            hashes = words.hashes()
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), lists([hashes[a:b] for a, b in zip(words.offsets, words.offsets[1:])])],
                names=["item_id", "words"])

    return texts.mapInArrow(run, "item_id long, words array<long>").where("size(words) > 0")


def _words(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy().view(U)


def _grams(items: DataFrame) -> DataFrame:
    """``(item_id, size, gram)``: a row for every word and pair of an item, as often as it has it."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                words = _words(batch.column("words"), row)
                grams = signed(np.concatenate([words, pair_hashes(words)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column("item_id")[row], len(grams)), pa.repeat(pa.scalar(len(words)), len(grams)), pa.array(grams)],
                    names=["item_id", "size", "gram"])

    return items.mapInArrow(run, "item_id long, size long, gram long")


def _counts(documents: DataFrame, wanted) -> DataFrame:
    """``(gram, times)`` in the corpus of the grams in the bitmap ``wanted`` (and some others); of all words under null."""

    def run(batches):
        for part in slices(batches):
            words = split_words(part.column("text"), LETTERS)
            hashes = words.hashes()
            total = len(hashes)
            pairs = _pairs(words, hashes)[0]
            known = wanted.value
            grams, times = np.unique(np.concatenate([hashes[known.has(hashes)], pairs[known.has(pairs)]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([None, *signed(grams).tolist()], pa.int64()),
                                              pa.array([total, *times.tolist()], pa.int64())], names=["gram", "times"])

    return documents.select("text").mapInArrow(run, "gram long, times long").groupBy("gram").agg(F.sum("times").alias("times"))


def _choose(times: np.ndarray, grams: np.ndarray, size: int, total: int, likeness: float) -> tuple[np.ndarray, int, int]:
    """Seeds of an item, how many of them a place needs, and within how many words."""
    least = max(1, math.ceil(2 * likeness * size - 1e-9) - 1)  # grams that an alignment matches
    if least > len(grams):
        return grams[:0], 1, 1
    span = math.floor(size + max(0.0, 1 - likeness) * size / COST)  # all words match, the rest are gaps
    order = np.lexsort((grams, times))
    grams, times = grams[order], times[order]
    first = np.concatenate([[True], grams[1:] != grams[:-1]])
    k = np.arange(1, least + 1)
    rate = (np.cumsum(times * first) / max(total, 1))[len(grams) - least + k - 1]
    more, mean = k - 1, np.maximum(rate * span, 1e-300)
    chance = np.exp(np.where(more > mean, more - mean + more * np.log(mean / np.maximum(more, 1)), 0))
    needed = int(k[np.argmin(rate * (1 + PLACE * chance))])
    taken = len(grams) - least + needed
    return grams[:taken][(first & (times > 0))[:taken]], needed, span


def _seeds(grams: DataFrame, counts: DataFrame, total: int, likeness: float) -> DataFrame:
    """``(gram, item_id, needed, span)`` for all seeds that occur in the corpus."""
    counted = grams.join(counts, "gram", "left").groupBy("item_id", "size").agg(
        F.collect_list(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram")).alias("grams"))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                listed = batch.column("grams")[row].values
                seeds, needed, span = _choose(listed.field("times").to_numpy(), listed.field("gram").to_numpy(),
                                              batch.column("size")[row].as_py(), total, likeness)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds), pa.repeat(batch.column("item_id")[row], len(seeds)),
                     pa.repeat(pa.scalar(needed, pa.int32()), len(seeds)), pa.repeat(pa.scalar(span, pa.int32()), len(seeds))],
                    names=["gram", "item_id", "needed", "span"])

    return counted.mapInArrow(run, "gram long, item_id long, needed int, span int")


def _hits(documents: DataFrame, wanted) -> DataFrame:
    """``(key, gram, hit)``: where texts hold grams of the bitmap; ``hit`` is twice the word's place, one more for a pair."""

    def run(batches):
        for part in slices(batches):
            words = split_words(part.column("text"), LETTERS)
            hashes = words.hashes()
            pairs, at = _pairs(words, hashes)
            known = wanted.value
            one, two = np.flatnonzero(known.has(hashes)), np.flatnonzero(known.has(pairs))
            place = np.concatenate([one, at[two]])
            row = np.searchsorted(words.offsets, place, "right") - 1
            hit = 2 * (place - words.offsets[row])
            hit[len(one):] += 1
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(row)), pa.array(signed(np.concatenate([hashes[one], pairs[two]]))),
                 pa.array(hit, pa.int32())], names=["key", "gram", "hit"])

    return documents.select("key", "text").mapInArrow(run, "key binary, gram long, hit int")


#: Places where ``needed`` hits in a row lie within the span: those of the first and last word.
PLACES = """if(size(hits) < needed, array(), filter(
    transform(sequence(0, size(hits) - needed), i -> struct(int(hits[i] div 2) as a, int(hits[i + needed - 1] div 2) as b)),
    p -> p.b - p.a < span))"""


def _candidates(hits: DataFrame, seeds: DataFrame, items: DataFrame) -> DataFrame:
    """``(key, found)``: for each text the items that it may copy, with their words and the places."""
    placed = hits.join(seeds, "gram").groupBy("key", "item_id", "needed", "span").agg(  # copies of a text add nothing to a set
        F.sort_array(F.collect_set("hit")).alias("hits")).select("key", "item_id", "span", F.expr(PLACES).alias("places"))
    found = F.struct("item_id", "span", "words", F.col("places.a").alias("a"), F.col("places.b").alias("b"))
    return placed.where("size(places) > 0").join(items, "item_id").groupBy("key").agg(F.collect_list(found).alias("found"))


def align(item: np.ndarray, passage: np.ndarray, anchored: bool = False) -> tuple[float, int, int]:
    """Best local alignment score of two word sequences, and the places after its end in both.

    An anchored alignment starts with the first words of both."""
    steps = COST * np.arange(len(passage) + 1)
    above, best, stop, end = -steps if anchored else np.zeros(len(passage) + 1), 0.0, 0, 0
    for place, word in enumerate(item, 1):
        row = above - COST
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(passage == word, 1.0, -COST))
        if not anchored:
            row = np.maximum(row, 0)
        row = np.maximum.accumulate(row + steps) - steps  # gaps along the passage
        top = int(row.argmax())
        if row[top] > best + 1e-9:
            best, stop, end = float(row[top]), place, top
        above = row
    return best, stop, end


def passages(item: np.ndarray, words: np.ndarray, likeness: float) -> Iterator[tuple[float, int, int]]:
    """``(score, first, last)``: the best alignment of at least ``likeness``, then those of the words before and after it."""
    least, parts = likeness * len(item), [(0, len(words))]
    while parts:
        a, b = parts.pop()
        if b - a < least or a == b:
            continue
        if (Counter(words[a:b].tolist()) & Counter(item.tolist())).total() < least:  # matches in any order
            continue
        best, stop, end = align(item, words[a:b])
        if best < least or not best:
            continue
        size = align(item[:stop][::-1], words[a:a + end][::-1], anchored=True)[2]
        yield best / len(item), a + end - size, a + end
        parts += [(a, a + end - size), (a + end, b)]


def _windows(a: np.ndarray, b: np.ndarray, span: int, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of a text around places, joined where they overlap."""
    low, high = np.maximum(b - span + 1, 0), np.minimum(a + span, size)
    new = np.flatnonzero(np.concatenate([[True], low[1:] >= high[:-1]]))
    return zip(low[new].tolist(), high[np.append(new[1:], len(high)) - 1].tolist(), strict=True)


def _promising(item: np.ndarray, words: np.ndarray, likeness: float) -> bool:
    """Could the words have the score if they stood in any order, each as often as one likes?"""
    gain = np.cumsum(np.concatenate([[0.0], np.where(np.isin(words, item), 1.0, -COST)]))
    return bool((gain - np.minimum.accumulate(gain)).max() >= likeness * len(item))


def _aligned(likeness: float):
    """Rows ``(doc_id, item_id, score, first_word, last_word)`` of texts with candidates."""

    def run(batches):
        for part in slices(batches):
            words = split_words(part.column("text"), LETTERS)
            hashes = words.hashes()
            out = []
            for row, (first, last) in enumerate(zip(words.offsets, words.offsets[1:], strict=False)):
                text, listed = hashes[first:last], part.column("found")[row].values
                a, b, item_words = (listed.field(n) for n in ("a", "b", "words"))
                for i, (item_id, span) in enumerate(zip(listed.field("item_id").to_pylist(), listed.field("span").to_pylist(), strict=True)):
                    item = _words(item_words, i)
                    for low, high in _windows(a[i].values.to_numpy(), b[i].values.to_numpy(), span, len(text)):
                        if _promising(item, text[low:high], likeness):
                            out += [(row, item_id, score, low + x, low + y)
                                    for score, x, y in passages(item, text[low:high], likeness)]
            if out:
                rows, ids, scores, firsts, lasts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows)), pa.array(ids, pa.int64()), pa.array(scores, pa.float64()),
                     pa.array(firsts, pa.int64()), pa.array(lasts, pa.int64())],
                    names=["doc_id", "item_id", "score", "first_word", "last_word"])

    return run


def leaks(documents: DataFrame, benchmark: DataFrame, likeness: float = LIKENESS) -> DataFrame:
    """Rows ``(doc_id, item_id, score, first_word, last_word)``: a document passage (words counted without
    ASCII punctuation, the last exclusive) that aligns with a benchmark item of
    ``benchmark(item_id, text)`` by at least ``likeness``.

    All such passages are found, short items' too, of which a few words suffice. Several passages of a document give
    several rows (the best, then those of the words before and after it), repeated document rows repeat theirs. Null
    texts, items without words or id and empty tables give no rows; of equal item texts the least id speaks.
    Other columns are not read. The corpus is read three times, whatever the size of the benchmark; its texts are shuffled
    only if those with candidates are too many to broadcast.
    """
    context = documents.sparkSession.sparkContext
    documents = documents.select(F.col("doc_id").cast("long"), "text", F.unhex(F.md5("text")).alias("key"))
    items = store.saved(_items(benchmark), "items")
    grams = store.saved(_grams(items), "grams")
    counts = store.saved(_counts(documents, context.broadcast(_Bitmap.of(grams.select("gram").distinct()))), "counts")
    total = counts.where("gram is null").agg(F.sum("times")).first()[0] or 0
    seeds = store.saved(_seeds(grams, counts.where("gram is not null"), total, likeness), "seeds")
    wanted = context.broadcast(_Bitmap.of(seeds.select("gram").distinct()))
    found = store.saved(_candidates(_hits(documents, wanted), seeds, items), "candidates")
    return documents.join(found, "key").select("doc_id", "text", "found").mapInArrow(
        _aligned(likeness), "doc_id long, item_id long, score double, first_word long, last_word long")
