"""Removal of word sequences that occur again anywhere in the corpus.

A *window* is ``size`` consecutive words of one document. A window that starts at two places
of the corpus is repeated, and every word of it goes, at all its places.

Pass one sketches the corpus (count-min, one row of cells saturating at two, merged from all
tasks). To keep the sketch small, it counts one *anchor* for each window: among the runs
of ``size // 2 + 1`` words inside it, the one with the least hash.
Equal windows have equal anchors, so an anchor's cell never holds less than the count of any
window around it. Pass two hashes the windows again, keeps those whose anchor may repeat,
and groups exactly these, by 96 bits of hash. A task settles what repeats within its own share and sends each
of its distinct windows once, so a window that very many documents hold arrives once from each share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .sketch import repeated, size_bits
from .store import saved
from .wordhash import EXACT, U, mix, ngrams, signed, slices, split_words

#: Cells per anchor; bytes of text per word and words per anchor only size the sketch.
CELLS, BYTES_PER_WORD = 12, 6
#: Windows that a task settles at a time, and bytes of text for each group of hashes.
#: Bytes of text that a task takes at a time: two hashes of every window are held for them.
SLICE = 1 << 19
SHARE, GROUP_BYTES = 600_000, 32 << 20


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def _window_starts(offsets: np.ndarray, size: int, count: int) -> np.ndarray:
    """Whether a window that starts at each of ``count`` places lies within one text."""
    last = np.repeat(offsets[1:], np.diff(offsets))[:count]
    return np.arange(count) + size <= last


def _anchors(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least run hash of each window, whether the window is real, and the hashes of all anchor places."""
    run = size // 2 + 1
    span = size - run + 1
    runs = ngrams(hashes, run)
    least = _sliding(runs, span, np.minimum)
    real = _window_starts(offsets, size, len(least))
    of_window = np.where(real, least, U(0))
    padded = np.concatenate([np.zeros(span - 1, U), of_window, np.zeros(span - 1, U)])
    return least, real, runs[_sliding(padded, span, np.maximum) == runs]


def _anchor_items(size: int):
    def items(batch):
        for part in slices([batch], limit=SLICE):
            words = split_words(part.column("text"), EXACT)
            if len(words.starts) >= size:
                yield _anchors(words.hashes(), words.offsets, size)[2]

    return items


def _text_keys(words) -> np.ndarray:
    """A hash of the whole word sequence of each text."""
    hashes = words.hashes(5)
    place = np.arange(len(hashes)) - np.repeat(words.offsets[:-1], np.diff(words.offsets))
    sums = np.concatenate([[U(0)], np.cumsum(mix(hashes + place.astype(U) * U(0x9E3779B97F4A7C15)))])
    return sums[words.offsets[1:]] - sums[words.offsets[:-1]]


_ROWS = "bucket int, k1 binary, k2 binary, row binary, at binary, doc_ids array<bigint>, text_keys array<bigint>"


def _grouped(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash, and the number of the group of equal hashes of each entry in that order."""
    order = np.lexsort((k2, k1))
    new = np.ones(len(order), bool)
    new[1:] = (k1[order[1:]] != k1[order[:-1]]) | (k2[order[1:]] != k2[order[:-1]])
    return order, np.cumsum(new) - 1


class _Share:
    """Windows of a task's share: hashes, places, and the documents that the places point to."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.ids: list[pa.Array] = []
        self.keys: list[np.ndarray] = []
        self.rows, self.count = 0, 0

    def add(self, k1, k2, row, at, ids: pa.Array, keys: np.ndarray) -> None:
        self.parts.append((k1, k2, (row + self.rows).astype(np.int32), at.astype(np.int32)))
        self.ids.append(ids)
        self.keys.append(keys)
        self.rows += len(ids)
        self.count += len(k1)

    def rows_of(self, bucket: int, k1, k2, row, at) -> dict:
        """One output row; documents are numbered anew, -1 stays."""
        used, again = np.unique(row[row >= 0], return_inverse=True)
        number = np.full(len(row), -1, np.int32)
        number[row >= 0] = again
        return {"bucket": bucket, "k1": k1.tobytes(), "k2": k2.tobytes(), "row": number.tobytes(), "at": at.tobytes(),
                "doc_ids": self.all_ids.take(pa.array(used)).to_pylist(), "text_keys": self.all_keys[used].tolist()}

    def settled(self, bits: int) -> list[dict]:
        """Places of windows that repeat here (without hashes), and each distinct window once for its bucket."""
        k1, k2, row, at = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.all_ids, self.all_keys = pa.concat_arrays(self.ids), signed(np.concatenate(self.keys))
        order, group = _grouped(k1, k2)
        sizes = np.bincount(group)
        many = np.zeros(len(order), bool)
        many[order] = sizes[group] > 1
        none = np.zeros(0, U)
        out = []
        if many.any():
            out.append(self.rows_of(int(self.all_keys[row[many][0]]) & ((1 << bits) - 1), none, none.astype(np.uint32),
                                    row[many], at[many]))
        first = order[np.cumsum(sizes) - sizes]
        first.sort()  # by document again
        k1, k2, at = k1[first], k2[first], at[first]
        row = np.where(many[first], -1, row[first]).astype(np.int32)
        bucket = (k1 >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(k1), np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[by_bucket], np.arange((1 << bits) + 1))
        for i in np.flatnonzero(np.diff(bounds)):
            chosen = by_bucket[bounds[i]:bounds[i + 1]]
            out.append(self.rows_of(int(i), k1[chosen], k2[chosen], row[chosen], at[chosen]))
        return out


def _suspects(size: int, bits: int, seen):
    """Windows whose anchor may repeat, in buckets by hash."""
    schema = pa.schema([("bucket", pa.int32()), ("k1", pa.binary()), ("k2", pa.binary()), ("row", pa.binary()),
                        ("at", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("text_keys", pa.list_(pa.int64()))])

    def run(batches):
        known, share = seen.value, _Share()
        for part in slices(batches, limit=SLICE):
            words = split_words(part.column("text"), EXACT)
            if len(words.starts) < size:
                continue
            hashes = words.hashes()
            least, real, _ = _anchors(hashes, words.offsets, size)
            at = np.flatnonzero(real)
            at = at[known(least[at])]
            if not len(at):
                continue
            row = np.searchsorted(words.offsets, at, "right") - 1
            share.add(ngrams(hashes, size, 1)[at], (ngrams(words.hashes(2), size, 2)[at] >> U(32)).astype(np.uint32),
                      row, at - words.offsets[row], part.column("doc_id"), _text_keys(words))
            if share.count > SHARE:
                yield pa.RecordBatch.from_pylist(share.settled(bits), schema)
                share = _Share()
        if share.count:
            yield pa.RecordBatch.from_pylist(share.settled(bits), schema)

    return run


def _places(batches):
    """``(doc_id, text_key, starts)`` of repeated windows, bucket by bucket."""
    held: list[tuple] = []
    names = ["doc_id", "text_key", "starts"]

    def rows(ids, keys, row, at):
        order = np.lexsort((at, row))
        row, at = row[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        offsets = np.concatenate([first, [len(row)]]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row[first])), keys.take(pa.array(row[first])),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(at))], names=names)

    def settle():
        k1, k2, row, at = (np.concatenate(x) for x in list(zip(*held, strict=True))[:4])
        base = np.cumsum([0] + [len(h[4]) for h in held])
        row = row.astype(np.int64)
        shift = np.repeat(base[:-1], [len(h[0]) for h in held])
        ids, keys = pa.concat_arrays([h[4] for h in held]), pa.concat_arrays([h[5] for h in held])
        order, group = _grouped(k1, k2)
        told = np.bincount(group, weights=row[order] < 0) > 0  # a share settled it: it repeats there
        again = order[(np.bincount(group) > 1)[group] | told[group]]
        again = again[row[again] >= 0]
        held.clear()
        if len(again):
            yield rows(ids, keys, (row + shift)[again], at[again])

    bucket = None
    for batch in batches:
        for i in range(batch.num_rows):
            here = batch.column("bucket")[i].as_py()
            if here != bucket and held:
                yield from settle()
            bucket = here
            k1, k2, row, at = (np.frombuffer(batch.column(n)[i].as_buffer(), t) for n, t in
                               (("k1", U), ("k2", np.uint32), ("row", np.int32), ("at", np.int32)))
            ids, keys = batch.column("doc_ids")[i].values, batch.column("text_keys")[i].values
            if len(k1):
                held.append((k1, k2, row, at, ids, keys))
            else:
                yield rows(ids, keys, row, at)
    if held:
        yield from settle()


def _text_keys(words) -> np.ndarray:
    """A hash of the whole word sequence of each text."""
    hashes = words.hashes(5)
    place = np.arange(len(hashes)) - np.repeat(words.offsets[:-1], np.diff(words.offsets))
    sums = np.concatenate([[U(0)], np.cumsum(mix(hashes + place.astype(U) * U(0x9E3779B97F4A7C15)))])
    return sums[words.offsets[1:]] - sums[words.offsets[:-1]]


def _keep(size: int):
    """Cut the words that windows at ``found`` cover."""
    def run(batches):
        for part in slices(batches, limit=SLICE):
            texts, found = part.column("text").to_pylist(), part.column("found").to_pylist()
            totals, removed, kept_texts, digests = [], [], [], []
            for text, starts in zip(texts, found, strict=True):
                words = (text or "").encode().split()
                totals.append(len(words))
                if starts:
                    edges = np.zeros(len(words) + 1, np.int32)
                    starts = np.unique(np.asarray(starts))
                    edges[starts] += 1
                    edges[starts + size] -= 1
                    covered = np.cumsum(edges[:-1]) > 0
                    words = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
                kept = b" ".join(words)
                removed.append(totals[-1] - len(words))
                kept_texts.append(kept.decode())
                digests.append(hashlib.sha256(kept).hexdigest())
            rest = [part.column(i) for i, name in enumerate(part.schema.names) if name not in ("text", "found")]
            names = [name for name in part.schema.names if name not in ("text", "found")]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept_texts, pa.string()), pa.array(digests, pa.string())],
                names=[*names, "n_words", "n_removed", "kept_text", "kept_sha256"])

    return run


def _keys(batches):
    for part in slices(batches, limit=SLICE):
        keys = signed(_text_keys(split_words(part.column("text"), EXACT)))
        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys)], names=[*part.schema.names, "text_key"])


def without_repeats(documents: DataFrame, size: int = 35, keep: Sequence[str] = ()) -> DataFrame:
    """Cut every repeated window of ``size`` words from ``documents(doc_id, text, ...)``.

    Words are runs of characters other than ASCII white space, unchanged. Returns ``doc_id`` with
    ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space) and ``kept_sha256`` for
    every row. A null text has no words; a text shorter than a window keeps all. Repeated rows are
    places of their own, so they lose everything that makes a window. Windows are judged on the
    input. Rows without an id are treated like any other. The columns named in ``keep`` come along in
    a struct ``others``, so their names clash with nothing; no other column is read.
    """
    spark = documents.sparkSession
    others = F.struct(*[F.col(f"`{name}`") for name in keep]) if keep else F.lit(None).cast("int")
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text"), others.alias("others"))
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    per_anchor = (size - size // 2) / 2 * BYTES_PER_WORD
    seen = spark.sparkContext.broadcast(
        repeated(documents.select("text"), _anchor_items(size), size_bits(total / per_anchor, CELLS)))
    bits = min(14, max(5, int(total // GROUP_BYTES).bit_length()))
    found = (documents.select("doc_id", "text").mapInArrow(_suspects(size, bits, seen), _ROWS)
             .repartition(1 << bits, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_places, "doc_id long, text_key long, starts array<int>")
             .groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("starts")).alias("found")))
    found = saved(found, "repeats")
    schema = documents.schema
    keyed = documents.mapInArrow(_keys, StructType([*schema.fields, StructField("text_key", LongType())]))
    met = keyed.join(found.withColumnRenamed("doc_id", "id").withColumnRenamed("text_key", "key"),
                     F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    made = [StructField("n_words", LongType()), StructField("n_removed", LongType()),
            StructField("kept_text", StringType()), StructField("kept_sha256", StringType())]
    out = met.select("doc_id", "others", "text", "found").mapInArrow(
        _keep(size), StructType([schema["doc_id"], schema["others"], *made]))
    return out if keep else out.drop("others")
