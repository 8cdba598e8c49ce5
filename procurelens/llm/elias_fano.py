"""Token ids in binary blocks with Elias-Fano document boundaries.

A block is one binary value: a header, all ids of its documents one after another (2 bytes each
if the vocabulary allows, else 4), and the documents' boundaries as an Elias-Fano sequence. Of every boundary the
low ``l`` bits are stored as they are, the high ones in unary: boundary ``i`` sets bit
``(b >> l) + i``. Select finds the i-th set bit from samples, one 32-bit place for every ``SAMPLE``
bits set. That is about ``2 + log2(ids / documents)`` bits a document, and no table of 64-bit offsets.

Blocks are rows of a Parquet table ``(part, block, before, n_ids, doc_ids, payload)``, written by Spark in ascending
document order, so that a lost executor's blocks are written again; ``before`` counts the ids of earlier blocks in
the part.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .parts import PartMemory
from .wordhash import slices

BLOCK_IDS = 1 << 17
SAMPLE = 64
HEADER = struct.Struct("<4sBBHIII")  # mark, bytes of an id, l, version, documents, ids, bytes of the high bits
MARK = b"EFTK"
BITS_SET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)  # of each byte
SCHEMA = "part int, block int, before long, n_ids long, doc_ids array<bigint>, payload binary"


class Boundaries(NamedTuple):
    """An Elias-Fano sequence: ``count`` ascending numbers."""

    count: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> Boundaries:
        values = np.asarray(values, np.int64)
        last = int(values[-1]) if len(values) else 0
        low_bits = max(0, (last // max(len(values), 1)).bit_length() - 1)
        shifts = np.arange(low_bits)
        low = np.packbits((values[:, None] >> shifts & 1).astype(np.uint8).ravel())
        places = (values >> low_bits) + np.arange(len(values))
        flags = np.zeros(int(places[-1]) + 1 if len(places) else 0, np.uint8)
        flags[places] = 1
        return cls(len(values), low_bits, low, np.packbits(flags), places[::SAMPLE].astype(np.uint32))

    def _low(self, index: np.ndarray) -> np.ndarray:
        out = np.zeros(len(index), np.int64)
        for shift in range(self.low_bits):
            bit = index * self.low_bits + shift
            out |= (self.low[bit >> 3] >> (7 - (bit & 7)) & 1).astype(np.int64) << shift
        return out

    def select(self, index: np.ndarray) -> np.ndarray:
        """The numbers at ``index``, each from its nearest sample on, byte by byte."""
        index = np.asarray(index, np.int64)
        place = self.samples[index // SAMPLE].astype(np.int64)
        missing, byte = index % SAMPLE, place >> 3
        value = self.high[byte] & (0xFF >> (place & 7)).astype(np.uint8)
        going = np.flatnonzero(BITS_SET[value] <= missing)
        while len(going):
            missing[going] -= BITS_SET[value[going]]
            byte[going] += 1
            value[going] = self.high[byte[going]]
            going = going[BITS_SET[value[going]] <= missing[going]]
        passed = np.cumsum(np.unpackbits(value[:, None], axis=1), axis=1, dtype=np.int64) <= missing[:, None]
        place = byte * 8 + passed.sum(axis=1)
        return ((place - index) << self.low_bits) | self._low(index)


def pack(ids: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    """``ends``: for each document, the number of ids up to its end."""
    b = Boundaries.of(ends)
    head = HEADER.pack(MARK, width, b.low_bits, 1, b.count, len(ids), len(b.high))
    return b"".join([head, ids.astype(f"<u{width}").tobytes(), b.low.tobytes(), b.high.tobytes(),
                     b.samples.astype("<u4").tobytes()])


def unpack(raw: bytes) -> tuple[np.ndarray, Boundaries]:
    mark, width, low_bits, version, count, n_ids, n_high = HEADER.unpack_from(raw)
    if mark != MARK or version != 1:
        raise ValueError("not a block of token ids")
    at = HEADER.size
    ids = np.frombuffer(raw, f"<u{width}", n_ids, at)
    at += n_ids * width
    n_low = -(-count * low_bits // 8)
    low = np.frombuffer(raw, np.uint8, n_low, at)
    high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
    samples = np.frombuffer(raw, "<u4", -(-count // SAMPLE), at + n_low + n_high)
    return ids, Boundaries(count, low_bits, low, high, samples)


def _visible() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordEncoder:
    """Encode texts by their parts, each distinct part once.

    Exact for tokenizers that drop white space: no token then spans a space or line feed. Plain words (Latin
    letters, then perhaps punctuation) are two parts; the letters go straight to the tokenizer's model in lower
    case. All other words go through the whole tokenizer as they are.
    """

    PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
    PARTS = r"^(?s:(?P<stem>.*?)(?P<tail>[,.!?|%#$&*:;]*))$"

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.visible = _visible()
        self.memory = PartMemory(self._parts)
        probe = ["word", "wörter", "été", "øre", "naïve", "straße", "that"]
        self.direct = all(self._plain(w) == self._whole(w) == self._whole(w.capitalize()) for w in probe)

    def _whole(self, part: str) -> list[int]:
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _plain(self, part: str) -> list[int]:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.visible)
        return [t.id for t in self.tokenizer.model.tokenize(part)]

    def _parts(self, parts: list[str]) -> list[list[int]]:
        plain = pc.match_substring_regex(pa.array(parts, pa.string()), self.PLAIN).to_pylist()
        return [self._plain(n) if p and self.direct else self._whole(n) for n, p in zip(parts, plain, strict=True)]

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, ``end`` after each, and the number of ids up to each text's end."""
        self.memory.start_batch()
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        cut = pc.extract_regex(words.dictionary, self.PARTS)
        stem, tail = cut.field("stem"), cut.field("tail")
        plain = pc.match_substring_regex(stem, self.PLAIN)
        stem = pc.if_else(plain, pc.utf8_lower(stem), words.dictionary)
        tail = pc.if_else(plain, tail, "")
        parts = pa.concat_arrays([stem, tail]).dictionary_encode()
        place = self.memory.places(parts.dictionary)[parts.indices.to_numpy()].reshape(2, -1)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        ids, done = self.memory.gather(place[:, words.indices.to_numpy()].T.ravel())  # stem, tail, stem, ...
        until = np.concatenate([[0], done])[2 * bounds[1:]]
        return np.insert(ids, until, np.uint32(end)), until + np.arange(1, len(texts) + 1)


_encoders: dict[int, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer."""
    key = zlib.crc32(definition.encode())
    if key not in _encoders:
        _encoders[key] = WordEncoder(definition)
    return _encoders[key]


def write_tokens(documents: DataFrame, path: str, definition: str, end_id: int) -> None:
    """Encode ``documents(doc_id, text)`` with the tokenizer ``definition`` (the text of its JSON file), append
    ``end_id`` to every document (a null text is empty) and write the blocks to ``path``.

    Documents go in ascending id order, those without an id first, rows of one id by text.
    """
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(definition)  # the tokenizer's file, a few MB
    size = len(json.loads(definition)["model"]["vocab"]) + len(json.loads(definition).get("added_tokens", []))
    width = 2 if max(size, end_id + 1) <= 1 << 16 else 4

    def run(batches):
        encoder = _encoder(sent.value)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []

        def full(limit: int) -> Iterator[pa.RecordBatch]:
            nonlocal block, before, held
            while held and sum(len(ids) for _, ids, _ in held) >= limit:
                names = np.concatenate([n for n, _, _ in held])
                ids = np.concatenate([i for _, i, _ in held])
                sizes = np.concatenate([s for _, _, s in held])
                done = np.cumsum(sizes)
                count = min(len(done), int(np.searchsorted(done, BLOCK_IDS)) + 1)
                total = int(done[count - 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
                     pa.array([total], pa.int64()), pa.array([list(names[:count])], pa.list_(pa.int64())),
                     pa.array([pack(ids[:total], done[:count], width)], pa.binary())],
                    names=["part", "block", "before", "n_ids", "doc_ids", "payload"])
                block, before = block + 1, before + total
                held = [(names[count:], ids[total:], sizes[count:])] if count < len(names) else []

        for batch in slices(batches):
            ids, ends = encoder.encode(batch.column("text"), end_id)
            held.append((np.array(batch.column("doc_id").to_pylist(), object), ids, np.diff(ends, prepend=0)))
            yield from full(BLOCK_IDS)
        yield from full(0)

    ordered = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    (ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, SCHEMA).write.parquet(path))


def _places(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """The blocks that hold ``wanted`` documents, with their places there. Only ids and places are shuffled, and blocks if many."""
    ids = wanted.select(F.col("doc_id").cast("long")).distinct()
    places = table.select("part", "block", F.posexplode("doc_ids").alias("place", "doc_id")).join(ids, "doc_id")
    return table.join(places.groupBy("part", "block").agg(F.sort_array(F.collect_list("place")).alias("places")), ["part", "block"])


def read_tokens(spark: SparkSession, path: str, ids: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """Read blocks: one row ``(doc_id, start, n_tokens, ids_crc32)`` for each document, and its ``ids`` if asked.

    ``start`` counts the ids of all documents before it; the CRC is over little-endian 32-bit ids. Where a document
    starts and ends is selected from its block's boundaries. With ``wanted(doc_id)`` only documents of these ids are
    read (all rows of a repeated id; null finds none), and boundaries of no others.
    """
    table = spark.read.schema(SCHEMA).parquet(path)
    totals = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # a row a task
    base, so_far = {}, 0
    for part in sorted(totals):
        base[part] = so_far
        so_far += totals[part]
    table = table.withColumn("places", F.lit(None).cast("array<int>")) if wanted is None else _places(table, wanted)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in ("part", "before", "doc_ids", "payload", "places")}
                block, bounds = unpack(row["payload"].as_py())
                places = row["places"].values.to_numpy() if row["places"].is_valid else np.arange(bounds.count)
                ends = bounds.select(places)
                starts = np.zeros(len(places), np.int64)
                starts[places > 0] = bounds.select(places[places > 0] - 1)
                first = base[row["part"].as_py()] + row["before"].as_py()
                parts = [block[a:b].astype("<u4") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [row["doc_ids"].values.take(pa.array(places)), pa.array(first + starts), pa.array(ends - starts),
                           pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if ids:
                    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
                    flat = np.concatenate([*parts, np.zeros(0, "<u4")])
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int32))))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    return table.mapInArrow(run, schema)
