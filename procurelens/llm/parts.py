"""A worker's memory of encoded text parts, laid out for gathering by index."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


class PartMemory:
    """Ids of distinct parts, each encoded once; forgotten together beyond ``limit`` parts."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.first, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def start_batch(self) -> None:
        if len(self.place) > self.limit or self.used > 16 * self.limit:
            self.clear()

    def _remember(self, parts: list[str], ids: list[list[int]]) -> None:
        flat = np.fromiter((i for each in ids for i in each), np.uint32)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        count, last = len(self.place), self.used + len(flat)
        while len(self.ids) < last:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.first) < count + len(parts):
            self.first, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.size))
        self.ids[self.used:last] = flat
        self.size[count:count + len(parts)] = sizes
        self.first[count:count + len(parts)] = self.used + np.cumsum(sizes) - sizes
        self.place.update(zip(parts, range(count, count + len(parts)), strict=True))
        self.used = last

    def places(self, parts: pa.Array) -> np.ndarray:
        """Where each of the distinct ``parts`` stands."""
        names = parts.to_pylist()
        new = [n for n in names if n not in self.place]
        if new:
            self._remember(new, self.encode(new))
        return np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts at ``places`` one after another, and how many there are up to each part's end."""
        take = self.size[places]
        done = np.cumsum(take)
        at = np.repeat(self.first[places] - (done - take), take)
        at += np.arange(len(at))
        return self.ids[at], done
