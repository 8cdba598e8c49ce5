"""Word and n-gram hashes of whole batches of texts, taken from Arrow buffers.

A batch is one byte array and words are runs of word bytes. Each distinct word of a batch is
hashed once; the hash of an n-gram is a difference of prefix sums of a polynomial modulo 2**64 over
word hashes. All functions run inside Arrow batches of Spark tasks.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

BLOCK = 1 << 18
SLICE_BYTES = 2 << 20
U = np.uint64


class Alphabet(NamedTuple):
    """Which bytes belong to words, and the byte each counts as."""

    word: np.ndarray
    folded: np.ndarray


def _alphabet(separators: set[int], lower: bool) -> Alphabet:
    word = np.ones(256, bool)
    word[sorted(separators)] = False
    folded = np.arange(256)
    if lower:
        folded[65:91] += 32
    return Alphabet(word, folded)


SPACES = {0x20, *range(0x09, 0x0E)}
#: Words are runs of non-space bytes: as they are, with A-Z lower-cased, and without ASCII punctuation.
EXACT = _alphabet(SPACES, lower=False)
LOWER = _alphabet(SPACES, lower=True)
LETTERS = _alphabet({b for b in range(128) if not chr(b).isalnum()}, lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit over all output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@lru_cache(8)
def _base(seed: int) -> tuple[int, int]:
    """An odd multiplier and its inverse modulo 2**64."""
    base = int(mix(np.array([seed * 2 + 1], U) * U(0x9E3779B97F4A7C15))[0]) | 5
    return base, pow(base, -1, 1 << 64)


@lru_cache(8)
def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in _base(seed):
        steps = np.full(size, base, U)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for every pair, independent of the position."""
    size = max(BLOCK, 1 << max(len(values) - 1, 1).bit_length())
    powers, inverse = _powers(seed, size)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers[:len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inverse[starts]


class Words(NamedTuple):
    """``starts``/``ends``: bytes of each word in ``data``; ``offsets``: first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    alphabet: Alphabet

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash (xxh3) of each word's bytes; every distinct word is hashed once."""
        if not len(self.starts):
            return np.zeros(0, U)
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)
        inside = self.alphabet.folded[self.data[self.alphabet.word[self.data]]].astype(np.uint8)
        words = pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(inside)])
        coded = words.dictionary_encode()
        known = np.fromiter((xxh3_64_intdigest(w, seed) for w in coded.dictionary.to_pylist()), U, len(coded.dictionary))
        return known[coded.indices.to_numpy()]


def flat_text(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: empty) and the offsets of each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def split_words(texts: pa.Array, alphabet: Alphabet) -> Words:
    data, bounds = flat_text(texts)
    inside = alphabet.word[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    opens[edge] = inside[edge]
    edge = bounds[1:][bounds[1:] > 0] - 1
    closes[edge] = inside[edge]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds), alphabet)


def ngrams(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hash of every ``size`` consecutive words, across text borders too (the caller drops those)."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, U)
    out = np.empty(count, U)
    step = max(1, BLOCK - size)
    for first in range(0, count, step):
        last = min(count, first + step)
        at = np.arange(last - first)
        out[first:last] = _sums(hashes[first:last + size - 1], at, at + size, seed + 17)
    return mix(out + U(size * 0x9FB21C651E98DF25 % (1 << 64)))


def shingle_sets(words: Words, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    hashes = words.hashes()
    grams = ngrams(hashes, size)
    for first, last in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if last - first >= size:
            yield np.unique(grams[first:last - size + 1])
        elif last > first:
            yield ngrams(hashes[first:last], last - first)
        else:
            yield np.zeros(0, U)


def give_back() -> None:
    """Return freed memory to the system: a Python worker goes on to other tasks and stages, or waits beside those that do."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or one row. Memory is given back before and after."""
    give_back()
    try:
        yield from _sliced(batches, column, limit)
    finally:
        give_back()


def _sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(total, total[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """A column of lists of 64-bit integers."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
