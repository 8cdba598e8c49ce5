"""Phrase collocations by vertical partitioning of a truncated suffix tree.

Every word of a text begins a suffix of its piece, cut after ``longest`` words. All suffixes with a common beginning
form a subtree, which can be built apart from all others:

1. Words are counted. Prefixes above the memory budget are made a word longer, and counted again, until each is
   within the budget or is a whole suffix.
2. ``Plan``: frequent prefixes are packed into groups of at most a budget of occurrences; rare ones are dealt to the
   rest of the groups by hash. Only prefixes above ``1/SHARE`` of the budget are listed: at most ``SHARE`` of each length for
   each budget of words in the corpus. Longer prefixes are counted in slots by hash, which changes what goes together and no count.
3. Tasks send each distinct suffix of their texts, with its count, to the group of its prefix.
4. A task builds the subtrees of its group: suffixes in order, equal ones merged to leaves, and each node's frequency as the
   total of the leaves below it. Nodes above a prefix that was made longer get a part of their total from each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .store import saved
from .wordhash import Alphabet, U, mix, slices, split_words

#: Suffix occurrences whose subtrees one task builds, and words whose suffixes one task merges before sending.
BUDGET, CHUNK = 500_000, 200_000
#: Prefixes with more than this part of the budget are packed by count.
SHARE = 32
#: Slots of longer prefixes: two to this power at least, four for each budget of words.
LEAST_BITS = 12
BREAKS = {*b".,;:!?", *range(0x0A, 0x0E)}


def _alphabet() -> Alphabet:
    word, folded = np.ones(256, bool), np.arange(256)
    word[[0x20, 0x09, *sorted(BREAKS)]] = False
    folded[65:91] += 32
    return Alphabet(word, folded)


PIECES = _alphabet()
IS_BREAK = np.isin(np.arange(256), sorted(BREAKS))


ROWS = "`group` int, names string, langs string, lang binary, words binary, counts binary"
NODES = "lang string, phrase string, words int, f long"


class Chunk(NamedTuple):
    """Words of some texts: ``names`` of distinct ones (bytes), ``langs``; by word its ``name``, ``lang`` and ``piece``."""

    names: pa.Array
    langs: list[str]
    name: np.ndarray
    lang: np.ndarray
    piece: np.ndarray


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Chunk]:
    """Words of ``(lang, text)`` rows, about ``size`` at a time; a longer text makes a chunk of its own."""
    held: list[tuple] = []

    def merged() -> Chunk:
        names, langs, pieces, shift = [], [], [], 0
        for words, lang, piece in held:
            names.append(words)
            langs.append(lang)
            pieces.append(piece + shift)
            shift += int(piece[-1]) + 1
        held.clear()
        coded = pa.chunked_array(names).combine_chunks().dictionary_encode()
        spoken = pa.chunked_array(langs).combine_chunks().dictionary_encode()
        return Chunk(coded.dictionary, spoken.dictionary.to_pylist(), coded.indices.to_numpy(),
                     spoken.indices.to_numpy(), np.concatenate(pieces))

    for part in slices(batches):
        words = split_words(part.column("text"), PIECES)
        if not len(words.starts):
            continue
        offsets = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
        inside = PIECES.folded[words.data[PIECES.word[words.data]]].astype(np.uint8)
        found = pa.Array.from_buffers(pa.large_binary(), len(words.starts), [None, pa.py_buffer(offsets), pa.py_buffer(inside)])
        text = np.searchsorted(words.offsets, np.arange(len(words.starts)), "right") - 1
        breaks = np.concatenate([[0], np.cumsum(IS_BREAK[words.data])])[words.starts]  # those before each word
        held.append((found, pc.fill_null(part.column("lang"), "und").take(pa.array(text)), breaks + text))
        if sum(len(h[0]) for h in held) >= size:
            yield merged()
    if held:
        yield merged()
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def _following(chunk: Chunk, longest: int) -> np.ndarray:
    """By word and step, the code of the word ``step`` places on in its piece, or -1."""
    out = np.full((len(chunk.name), longest), -1, np.int64)
    for step in range(min(longest, len(chunk.name))):
        same = chunk.piece[step:] == chunk.piece[:len(chunk.piece) - step]
        out[:len(same), step] = np.where(same, chunk.name[step:], -1)
    return out


def _unique(columns: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of equal rows, in order, and how often (or with what weight) each comes."""
    key = np.zeros(len(columns[0]), np.int64)
    room = 1
    for column in columns:
        low, width = int(column.min(initial=0)), int(column.max(initial=0)) - int(column.min(initial=0)) + 1
        if room * width >= 1 << 62:  # number the rows so far by rank
            _, key = np.unique(key, return_inverse=True)
            room = int(key.max(initial=0)) + 1
        key = key * width + (column - low)
        room *= width
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.ones(len(key), np.int64) if weights is None else weights[order]
    return order[first], np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)


def _hashes(names: pa.Array) -> np.ndarray:
    return np.fromiter((xxh3_64_intdigest(n) for n in names.to_pylist()), U, len(names))


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of prefixes with one word more; a lang is the prefix of no words."""
    return mix(prefix * U(0x9E3779B97F4A7C15) + word + U(1))


def prefix_hash(lang: str, *words: str) -> int:
    out = np.array([xxh3_64_intdigest(lang)], U)
    for word in words:
        out = _longer(out, np.array([xxh3_64_intdigest(word)], U))
    return int(out[0])


class Plan(NamedTuple):
    """Which group builds the subtree of a prefix; prefixes are given as sorted slots.

    ``packed`` go to the group at the same place in ``groups``; suffixes of ``longer`` ones go by one word more; all others are
    dealt to ``rest`` groups, numbered from ``first``. A word is a slot of its own; longer prefixes share ``2**bits`` slots of
    their length, so that no task has more than these to tell.
    """

    bits: int
    packed: np.ndarray
    groups: np.ndarray
    longer: np.ndarray
    first: int
    rest: int

    def groups_of(self, prefixes: list[np.ndarray]) -> np.ndarray:
        """Groups of suffixes, of which the prefix hashes of each length are given."""
        out = np.full(len(prefixes[0]), -1, np.int64)
        going = np.ones(len(out), bool)
        for length, own in enumerate(prefixes, 1):
            slots = _slots(own, length, self.bits)
            at, known = _find(self.packed, slots)
            take = going & known
            out[take] = self.groups[at[take]]
            dealt = going & ~known & ~_find(self.longer, slots)[1]
            out[dealt] = self.first + (own[dealt] % U(self.rest)).astype(np.int64)
            going &= ~take & ~dealt
        out[going] = self.first + (prefixes[-1][going] % U(self.rest)).astype(np.int64)
        return out


def _slots(prefixes: np.ndarray, length: int, bits: int) -> np.ndarray:
    return prefixes if length == 1 else _slot(prefixes >> U(64 - bits), length)


def _slot(number: np.ndarray, length: int) -> np.ndarray:
    return mix(number * U(64) + U(length))


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, values), max(0, len(table) - 1))
    return at, (table[at] == values if len(table) else np.zeros(len(values), bool))


def packed_groups(sizes: list[int], room: int) -> tuple[list[int], int]:
    """A group for each size (descending), filled one after another up to ``room``, and the number of groups."""
    groups, used, group = [], 0, -1
    for size in sizes:
        if group < 0 or used + size > room:
            group, used = group + 1, 0
        used += size
        groups.append(group)
    return groups, group + 1


def _word_counts(chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, chunk_words):
            first, counts = _unique([chunk.lang, chunk.name])
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.langs, pa.string()).take(pa.array(chunk.lang[first])),
                 _text(chunk.names.take(pa.array(chunk.name[first]))), pa.array(counts)], names=["lang", "phrase", "f"])

    return run


def _text(names: pa.Array) -> pa.Array:
    return names.cast(pa.large_string()).cast(pa.string())


def _prefix_hashes(chunk: Chunk, words: np.ndarray, lang: np.ndarray) -> list[np.ndarray]:
    """By length, hashes of the prefixes of suffixes; where a suffix ends, of it and an end."""
    known = np.concatenate([_hashes(chunk.names), np.zeros(1, U)])  # place -1: the end
    own = np.fromiter(map(xxh3_64_intdigest, chunk.langs), U, len(chunk.langs))[lang]
    out = []
    for column in words.T:
        own = _longer(own, known[column])
        out.append(own)
    return out


def _prefix_counts(length: int, longer: np.ndarray, bits: int, chunk_words: int):
    """Counts of slots of prefixes of ``length`` words that go on from one of ``longer``; a task tells each slot once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << bits, np.int64)
        for chunk in chunks(batches, chunk_words):
            words = _following(chunk, length)
            keep = words[:, length - 1] >= 0
            prefixes = _prefix_hashes(chunk, words[keep], chunk.lang[keep])
            own = prefixes[-1][_find(longer, _slots(prefixes[-2], length - 1, bits))[1]]
            totals += np.bincount((own >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(_slot(used.astype(U), length).view(np.int64)), pa.array(totals[used])],
                                         names=["prefix", "f"])

    return run


def plan_groups(texts: DataFrame, words: DataFrame, longest: int, budget: int) -> Plan:
    """Prefixes and their groups. ``texts(lang, text)``; ``words(lang, phrase, f)``: all words."""
    total = int(words.agg(F.sum("f")).first()[0] or 0)
    bits = max(LEAST_BITS, (4 * total // budget).bit_length())
    listed = [(prefix_hash(r["lang"], r["phrase"]), r["f"])
              for r in words.where(F.col("f") * SHARE > budget).toLocalIterator()]
    packed, longer = [], []
    for length in range(1, longest + 1):
        over = sorted(h for h, f in listed if f > budget) if length < longest else []
        packed += [(f, h) for h, f in listed if f <= budget or length == longest]
        longer += over
        if not over:
            break
        counts = (texts.mapInArrow(_prefix_counts(length + 1, np.array(over, U), bits, CHUNK), "prefix long, f long")
                  .groupBy("prefix").agg(F.sum("f").alias("f")).where(F.col("f") * SHARE > budget))
        listed = [(r["prefix"] % (1 << 64), r["f"]) for r in counts.toLocalIterator()]
    packed.sort(reverse=True)
    groups, first = packed_groups([f for f, _ in packed], budget)
    order = np.argsort(np.array([h for _, h in packed], U))
    rest = max(1, -(-2 * (total - sum(f for f, _ in packed)) // budget))
    return Plan(bits, np.array([h for _, h in packed], U)[order], np.array(groups, np.int64)[order],
                np.sort(np.array(longer, U)), first, rest)


def _suffixes(longest: int, plan: Plan, chunk_words: int):
    """Each distinct suffix of two words or more of a chunk with its count, a row for each group of subtrees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, chunk_words):
            words = _following(chunk, longest)
            keep = np.flatnonzero(words[:, 1] >= 0)
            if not len(keep):
                continue
            first, counts = _unique([chunk.lang[keep], *words[keep].T])
            words, lang = words[keep[first]], chunk.lang[keep[first]]
            group = plan.groups_of(_prefix_hashes(chunk, words, lang))
            order = np.argsort(group, kind="stable")
            group, words, lang, counts = group[order], words[order], lang[order], counts[order]
            starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            bounds = np.concatenate([starts, [len(group)]])
            rank = np.repeat(np.arange(len(starts)), np.diff(bounds))

            size = len(chunk.names) + 1
            key = rank[:, None] * size + words + 1  # word 0: the end
            used = np.unique(key[words >= 0])
            at = np.searchsorted(used // size, np.arange(len(starts) + 1))
            local = np.where(words < 0, -1, np.searchsorted(used, key) - at[rank][:, None]).astype(np.int32)
            names = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), _text(chunk.names.take(pa.array(used % size - 1))))
            lang, counts = lang.astype(np.int32), counts.astype(np.int32)
            parts = [(lang[a:b].tobytes(), local[a:b].tobytes(), counts[a:b].tobytes())
                     for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[starts], pa.int32()), pc.binary_join(names, "\n"),
                 pa.array(["\n".join(chunk.langs)] * len(starts), pa.string()),
                 *(pa.array(list(column), pa.binary()) for column in zip(*parts, strict=True))],
                names=["group", "names", "langs", "lang", "words", "counts"])

    return run


def _listed(table: pa.Table, name: str) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All names of the rows, coded, and where those of each row begin."""
    lists = pc.split_pattern(table.column(name).combine_chunks(), "\n")
    return lists.flatten().dictionary_encode(), lists.offsets.to_numpy()


def _subtrees(longest: int, least: int, longer: np.ndarray, bits: int):
    """Build the subtrees of a group and return nodes of two words or more that occur at least ``least`` times.

    Nodes that are a longer prefix's beginning have only a part of their total here and are returned in any case.
    """
    def run(table: pa.Table) -> pa.Table:
        names, name_at = _listed(table, "names")
        langs, lang_at = _listed(table, "langs")
        flat, spoken, weights = [], [], []
        for i, (lang, words, counts) in enumerate(zip(*(table.column(c).to_pylist() for c in ("lang", "words", "counts")), strict=True)):
            own = np.frombuffer(words, np.int32).reshape(-1, longest)
            flat.append(np.where(own < 0, -1, names.indices.to_numpy()[np.maximum(own, 0) + name_at[i]]))
            spoken.append(langs.indices.to_numpy()[np.frombuffer(lang, np.int32) + lang_at[i]])
            weights.append(np.frombuffer(counts, np.int32))
        words, lang, counts = np.concatenate(flat), np.concatenate(spoken), np.concatenate(weights).astype(np.int64)
        at, leaves = _unique([lang, *words.T], counts)  # leaves in the order of the tree
        words, lang = words[at], lang[at]
        chunk = Chunk(names.dictionary, langs.dictionary.to_pylist(), at, at, at)
        new = np.concatenate([[True], lang[1:] != lang[:-1]])
        out = []
        for depth in range(1, longest + 1):
            new[1:] |= words[1:, depth - 1] != words[:-1, depth - 1]
            if depth == 1:
                continue
            first = np.flatnonzero(new)
            totals = np.add.reduceat(leaves, first)
            whole = words[first, depth - 1] >= 0
            kept = whole & (totals >= least)
            if len(longer) and depth < longest:
                own = _prefix_hashes(chunk, words[first][:, :depth], lang[first])[-1]
                kept |= whole & _find(longer, _slots(own, depth, bits))[1]
            first, totals = first[kept], totals[kept]
            columns = [names.dictionary.take(pa.array(words[first, i])) for i in range(depth)]
            out.append(pa.table({"lang": langs.dictionary.take(pa.array(lang[first])),
                                 "phrase": pc.binary_join_element_wise(*columns, " "),
                                 "words": pa.array(np.full(len(first), depth, np.int32)), "f": pa.array(totals)}))
        return pa.concat_tables(out)

    return run


class Counted(NamedTuple):
    """``sizes(lang, n)``: all words; ``phrases(lang, phrase, words, f)``: those that occur ``least`` times or more."""

    sizes: DataFrame
    phrases: DataFrame


def count_phrases(documents: DataFrame, longest: int = 3, least: int = 10, budget: int = BUDGET) -> Counted:
    """Frequencies of all phrases of up to ``longest`` words in ``documents(lang, text)``, by lang."""
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                             F.col("text").cast("string").alias("text"))
    words = saved(texts.mapInArrow(_word_counts(CHUNK), "lang string, phrase string, f long")
                  .groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrase-words")
    plan = plan_groups(texts, words, longest, budget)
    nodes = (texts.mapInArrow(_suffixes(longest, plan, CHUNK), ROWS).groupBy("group")
             .applyInArrow(_subtrees(longest, least, plan.longer, plan.bits), NODES)
             .groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")))
    phrases = words.withColumn("words", F.lit(1)).unionByName(nodes).where(F.col("f") >= least)
    return Counted(words.groupBy("lang").agg(F.sum("f").alias("n")), saved(phrases, "phrase-counts"))


def _part(first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice("w", first, length), " ")


def collocations(documents: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, top: int = 2000,
                 budget: int = BUDGET) -> DataFrame:
    """The ``top`` phrases of each lang by how much oftener their words come together than apart.

    Texts (A-Z lower-cased; null: empty) are split at ``. , ; : ! ?`` and line breaks into pieces, and those at
    blanks and tabs into words. Phrases of 2 to ``longest`` words with frequency ``a >= least`` are candidates; of all
    ways to cut one in two, the one with the least ``floor(1000000 a a / (l r))`` counts (ties: the shorter first part).
    A candidate goes if a longer one, that holds its words next to each other, has ``percent`` of its frequency. Rows
    without lang are of lang ``und``; documents that repeat count as often as they come; langs without
    candidates have no rows. Other columns are ignored.
    """
    counted = count_phrases(documents, longest, least, budget)
    whole = counted.phrases.where("words > 1").withColumn("w", F.split("phrase", " "))
    part = counted.phrases.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias("_f"))
    cuts = (whole.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("_left"),
                    _part(F.col("k") + 1, F.size("w") - F.col("k")).alias("_right")))
    for side, name in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_phrase"))).select(
            *[c for c in cuts.columns if c != side], F.col("_f").alias(name))
    exact = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}  # so that no product is rounded
    scored = (cuts.withColumn("_top", F.lit(1_000_000).cast("decimal(7,0)") * exact["a"] * exact["a"])
              .withColumn("_below", exact["l"] * exact["r"]).withColumn("score", F.expr("_top div _below"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " "))))
    inside = (whole.where("words > 2").select("lang", "f", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = (scored.join(inside, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {percent} * a"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(counted.sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
