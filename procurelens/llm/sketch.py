"""A merged sketch of the whole corpus: which cells were hit at least twice.

Every task counts its items into cells, saturating at two, and sends the cells
it touched as gaps of about one byte. Reducers add up slices of the sketch. A
cell's sum is at least the count of every item in it, so an item that occurs
twice is never missed; an item alone in its cell is known to be single.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BITS = 22
MIN_BITS = 16
#: The bitmap that tasks receive is 2**MAX_BITS bits (256 MB) at most. Beyond, cells are
#: shared more often: more items go on to the exact step, and none is lost.
MAX_BITS = 31
GAP = 255


def size_bits(expected_items: float, cells_per_item: float) -> int:
    wanted = max(1, int(expected_items * cells_per_item))
    return min(MAX_BITS, max(MIN_BITS, wanted.bit_length()))


def pack(cells: np.ndarray) -> bytes:
    """Sorted cells as gaps: every byte 255 stands for 255 and "go on"."""
    gaps = np.diff(cells, prepend=0)
    more = gaps // GAP
    out = np.full(len(gaps) + int(more.sum()), GAP, np.uint8)
    out[np.cumsum(more + 1) - 1] = gaps % GAP
    return out.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != GAP]


def cells_of(items: np.ndarray, bits: int) -> np.ndarray:
    return (items >> np.uint64(64 - bits)).astype(np.int64)


def _slices_of(cells: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    cells = np.sort(cells)
    keep = np.ones(len(cells), bool)  # two of a kind say enough
    keep[2:] = cells[2:] != cells[:-2]
    cells = cells[keep]
    width = min(bits, SLICE_BITS)
    bounds = np.searchsorted(cells, np.arange((1 << (bits - width)) + 1) << width)
    for i in np.flatnonzero(np.diff(bounds)):
        yield int(i), pack(cells[bounds[i]:bounds[i + 1]] - (int(i) << width))


class Repeated:
    """The cells hit at least twice, as bits."""

    def __init__(self, bits: int, bitmap: np.ndarray):
        self.bits, self.bitmap = bits, bitmap

    def __call__(self, items: np.ndarray) -> np.ndarray:
        cells = cells_of(items, self.bits)
        return (self.bitmap[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 > 0


def repeated(df: DataFrame, items: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
             bits: int, pending: int = 1 << 20) -> Repeated:
    """Count ``items`` (arrays of 64-bit hashes for each batch) of all rows of ``df``."""
    def count(batches):
        held: list[np.ndarray] = []

        def send():
            found = list(_slices_of(np.concatenate(held), bits))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
                names=["slice", "cells"])

        for batch in batches:
            for part in items(batch):
                held.append(cells_of(part, bits))
                if sum(map(len, held)) > pending:
                    yield send()
        if held:
            yield send()

    width = min(bits, SLICE_BITS)

    def add(batches):
        at, counts = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([np.packbits(counts >= 2).tobytes()], pa.binary())],
                names=["slice", "bitmap"])

        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i != at:
                    if at is not None:
                        yield done()
                    at, counts = i, np.zeros(1 << width, np.uint8)
                cells = unpack(raw)
                twice = cells[1:][cells[1:] == cells[:-1]]
                counts[cells] = np.minimum(counts[cells] + 1, 2)
                counts[twice] = 2
        if at is not None:
            yield done()

    merged = (df.mapInArrow(count, "slice int, cells binary")
              .repartition(max(1, min(1 << (bits - width), 4096)), F.col("slice")).sortWithinPartitions("slice")
              .mapInArrow(add, "slice int, bitmap binary"))
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    step = (1 << width) // 8
    for row in merged.collect():  # 2**bits bits in all
        bitmap[row["slice"] * step:(row["slice"] + 1) * step] = np.frombuffer(row["bitmap"], np.uint8)
    return Repeated(bits, bitmap)
