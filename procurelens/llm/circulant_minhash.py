"""Near duplicates by circulant MinHash.

Shingles are places in a circle of 2**32. One permutation ``sigma`` shuffles the places, another one, ``pi``,
is turned by ``k`` places for coordinate ``k`` of a signature: the least ``pi(sigma(x) + k)`` of a set's shingles ``x``. Two
permutations so give all coordinates, each of which is equal for two sets with the probability of their similarity.

1. Documents with equal sets are one *class*; it gets one signature, in ``BANDS`` bands of ``ROWS`` coordinates.
2. Classes with an equal band share a *bucket*. A pair at similarity 0.8 misses all buckets with a chance of 3.4e-9.
3. Every pair in a bucket is confirmed on full sets, unless links join it already. Buckets
   that hang together are a *region*; a small one is confirmed in one task. In a large one, a few hubs meet
   all others part by part, which joins most copies; pairs that are still apart are then confirmed
   in blocks: those that are joined with the most others meet only those outside of them.

Tables of a row for each document, class or link are joined by merging at any size (``hint("merge")``): a broadcast passes
through the driver, and its size is guessed from packed files, in which sets of near copies are far smaller than in memory.
Only tables of a row for each large region may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .store import saved
from .wordhash import LOWER, U, lists, mix, shingle_sets, signed, slices, split_words

BANDS, ROWS = 64, 6
#: Regions and blocks within these bounds are confirmed in one task.
TASK_CLASSES, TASK_SHINGLES = 512, 1_000_000
HUBS = 8
#: Shingles that are permuted together: two arrays of them stay in a core's cache.
CACHED = 1 << 15
W = np.uint32


def sigma(shingles: np.ndarray) -> np.ndarray:
    """Places of 64-bit shingle hashes after the first permutation."""
    return (mix(shingles ^ U(0xA0761D6478BD642F)) >> U(32)).astype(W)


def turned(places: np.ndarray, turn: int, out: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation after a turn: ``pi(places + turn)``, into ``out``."""
    np.add(places, W(turn), out=out)
    for shift, factor in ((16, 0x21F0AAAD), (15, 0xD35A2D97)):
        np.right_shift(out, W(shift), out=spare)
        np.bitwise_xor(out, spare, out=out)
        np.multiply(out, W(factor), out=out)
    np.right_shift(out, W(15), out=spare)
    return np.bitwise_xor(out, spare, out=out)


def signatures(sets: list[np.ndarray], coordinates: int = BANDS * ROWS) -> np.ndarray:
    """One row of ``coordinates`` for each (non-empty) set."""
    out = np.empty((len(sets), coordinates), W)
    ends = np.cumsum([len(s) for s in sets])
    first = 0
    while first < len(sets):
        base = ends[first] - len(sets[first])
        last = max(first + 1, int(np.searchsorted(ends, base + CACHED, "right")))
        places = sigma(np.concatenate(sets[first:last]))
        starts = np.concatenate([[0], ends[first:last - 1] - base])
        turn, spare = np.empty_like(places), np.empty_like(places)
        for k in range(coordinates):
            out[first:last, k] = np.minimum.reduceat(turned(places, k, turn, spare), starts)
        first = last
    return out


def bands(found: np.ndarray, count: int = BANDS) -> np.ndarray:
    """A 64-bit key of each band; bands of different places never share a key but by chance."""
    parts = found.reshape(len(found), count, -1).astype(U)
    keys = np.broadcast_to(mix(np.arange(1, count + 1, dtype=U)), parts.shape[:2])
    for i in range(parts.shape[2]):
        keys = mix(keys * U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys


def _digests(sets: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array([int(mix(s ^ U(salt)).sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64())
            for salt in (0x452821E638D01377, 0xBE5466CF34E90C6C)]


def _signed_rows(size: int):
    """``(doc_id, n, d1, d2, bands)``; rows without words have no bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = list(shingle_sets(split_words(part.column("text"), LOWER), size))
            full = [s for s in sets if len(s)]
            keys = iter(signed(bands(signatures(full))) if full else ())
            rows = [next(keys) if len(s) else np.zeros(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *_digests(sets), lists(rows)],
                names=["doc_id", "n", "d1", "d2", "bands"])

    return run


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = list(shingle_sets(split_words(part.column("text"), LOWER), size))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *_digests(sets),
                 lists([signed(s) for s in sets])], names=["doc_id", "n", "d1", "d2", "shingles"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets (distinct values) are similar by at least ``percent``."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _rows(table: pa.Table, name: str) -> list[np.ndarray]:
    column = table.column(name).combine_chunks()
    flat, bounds = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[bounds[i]:bounds[i + 1]] for i in range(len(table))]


def _confirmed(ids: np.ndarray, sets: list[np.ndarray], label: np.ndarray, pairs, percent: int) -> pa.Table:
    """Links among candidate ``pairs`` of places, none between places that links join already."""
    label, tested, found = label.copy(), set(), []
    for i, j in pairs:
        if label[i] == label[j] or (i, j) in tested:
            continue
        tested.add((i, j))
        if linked(sets[i], sets[j], percent):
            label[label == label[j]] = label[i]
            found.append((i, j))
    at = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(ids[at[:, 0]]), "b": pa.array(ids[at[:, 1]])})


def _sharing(keys: list[np.ndarray], order: list[int], apart: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of places that share a key, earlier ones in ``order`` first; of different blocks if ``apart`` names them."""
    met: dict[int, list[int]] = {}
    for i in order:
        for key in keys[i].tolist():
            met.setdefault(key, []).append(i)
    for members in met.values():
        for place, i in enumerate(members):
            for j in members[:place]:
                if apart is None or apart[i] != apart[j]:
                    yield j, i


def _in_region(percent: int):
    """Confirm pairs of a region that share a bucket."""
    def run(table: pa.Table) -> pa.Table:
        ids, keys = table.column("cid").to_numpy(), _rows(table, "buckets")
        pairs = _sharing(keys, np.argsort(ids, kind="stable").tolist())
        return _confirmed(ids, _rows(table, "shingles"), np.arange(len(ids)), pairs, percent)

    return run


def _in_blocks(percent: int):
    """Confirm pairs that share a bucket, of one block of a region or of two blocks with each other."""
    def run(table: pa.Table) -> pa.Table:
        ids, keys, block = table.column("cid").to_numpy(), _rows(table, "buckets"), table.column("block").to_numpy()
        alone = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        pairs = _sharing(keys, np.argsort(ids, kind="stable").tolist(), None if alone else block)
        _, label = np.unique(table.column("label").to_numpy(), return_inverse=True)
        return _confirmed(ids, _rows(table, "shingles"), label, pairs, percent)

    return run


def _to_hubs(percent: int):
    def run(members: pa.Table, hubs: pa.Table) -> pa.Table:
        ids, centres = members.column("cid").to_numpy(), hubs.column("cid").to_numpy()
        found = [(a, b) for b, hub in zip(centres, _rows(hubs, "shingles"), strict=True)
                 for a, own in zip(ids, _rows(members, "shingles"), strict=True) if a != b and linked(own, hub, percent)]
        at = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(at[:, 0]), "b": pa.array(at[:, 1])})

    return run


LINKS = "a long, b long"


def _blocks(members: str, shingles: str):
    """How many blocks within the bounds so many classes and shingles need."""
    return F.ceil(F.greatest(F.expr(members) / (TASK_CLASSES / 2), F.expr(shingles) / (TASK_SHINGLES / 2))).cast("long")


def _large_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links with the components of large regions. ``sets(cid, n, shingles, buckets, region)``."""
    sizes = sets.groupBy("region").agg(_blocks("count(*)", "sum(n)").alias("parts"))
    rows = saved(sets.join(sizes, "region").withColumn("part", F.expr("pmod(xxhash64(cid), parts)")), "circulant-large")
    order = Window.partitionBy("region").orderBy(F.xxhash64("cid"), "cid")
    hubs = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HUBS)
    hubs = saved(hubs.select("region", "cid", "shingles", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part")),
                 "circulant-hubs")
    links = saved(rows.groupBy("region", "part").cogroup(hubs.groupBy("region", "part"))
                  .applyInArrow(_to_hubs(percent), LINKS), "circulant-hub-links")
    # the least hub that a class, or a hub of it, is linked to: classes of one label are surely in one component
    near = links.groupBy("a").agg(F.min("b").alias("m"))
    of_hub = near.select(F.col("a").alias("b"), F.least("a", "m").alias("m2"))
    label = links.join(of_hub.hint("merge"), "b", "left").groupBy(F.col("a").alias("cid")).agg(F.min(F.least("b", "m2")).alias("hub"))
    named = rows.select("region", "cid", "n").join(label.hint("merge"), "cid", "left").select(
        "region", "cid", "n", F.coalesce("hub", "cid").alias("label"))
    top = (named.groupBy("region", "label").count().groupBy("region")
           .agg(F.max(F.struct("count", "label"))["label"].alias("top")))
    named = saved(named.join(top.hint("merge"), "region").withColumn("outside", F.col("label") != F.col("top")), "circulant-labels")

    bounds = named.groupBy("region").agg(
        _blocks("count_if(outside)", "coalesce(sum(n) filter (where outside), 0)").alias("out"),
        _blocks("count_if(not outside)", "coalesce(sum(n) filter (where not outside), 0)").alias("ins")).where("out > 0")
    dealt = (named.join(bounds.hint("merge"), "region")
             .withColumn("block", F.expr("if(outside, pmod(xxhash64(cid), out), out + pmod(xxhash64(cid), ins))"))
             .withColumn("other", F.explode(F.expr("sequence(0L, if(outside, out + ins, out) - 1)")))
             .select("region", "cid", "label", "block", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high")))
    blocks = dealt.join(rows.select("cid", "shingles", "buckets").hint("merge"), "cid")
    return links.unionByName(blocks.groupBy("region", "low", "high").applyInArrow(_in_blocks(percent), LINKS))


class Links(NamedTuple):
    """``rows(doc_id, n, d1, d2, bands)`` of all documents; ``classes(d1, d2, n, cid, rep, copies, component)``."""

    rows: DataFrame
    classes: DataFrame


def circulant_links(documents: DataFrame, percent: int = 80, size: int = 2) -> Links:
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = saved(documents.mapInArrow(_signed_rows(size), "doc_id long, n long, d1 long, d2 long, bands array<bigint>"),
                 "circulant-rows")
    classes = (rows.where("n > 0").groupBy("d1", "d2", "n")
               .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands")))
    classes = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "circulant-classes")

    # a class without any id cannot be looked up again, and is linked with nothing
    met = classes.where("rep is not null").select("cid", F.explode("bands").alias("bucket"))
    same = Window.partitionBy("bucket")
    buckets = saved(met.select("bucket", "cid", F.count("*").over(same).alias("many"), F.min("cid").over(same).alias("first"))
                    .where("many > 1").select("bucket", "cid", "first"), "circulant-buckets")
    stars = buckets.select(F.col("cid").alias("a"), F.col("first").alias("b"))
    region = components(stars, "circulant-region").select(F.col("id").alias("cid"), F.col("component").alias("region"))
    region = saved(region.join(classes.select("cid", "rep", "d1", "d2", "n").hint("merge"), "cid"), "circulant-regions")
    large = (region.groupBy("region").agg(F.count("*").alias("many"), F.sum("n").alias("words"))
             .where((F.col("many") > TASK_CLASSES) | (F.col("words") > TASK_SHINGLES)).select("region"))
    large = saved(large, "circulant-large-regions")

    needed = region.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
    texts = documents.join(needed, "doc_id", "left_semi")
    sets = texts.mapInArrow(_set_rows(size), "doc_id long, n long, d1 long, d2 long, shingles array<bigint>")
    sets = (sets.join(region.withColumnRenamed("rep", "doc_id").hint("merge"), ["doc_id", "d1", "d2", "n"])
            .groupBy("cid").agg(F.first("n").alias("n"), F.first("region").alias("region"), F.first("shingles").alias("shingles")))
    keys = buckets.groupBy("cid").agg(F.collect_list("bucket").alias("buckets"))  # BANDS at most
    sets = saved(sets.join(keys.hint("merge"), "cid"), "circulant-sets")
    small = sets.join(large, "region", "left_anti")
    links = small.groupBy("region").applyInArrow(_in_region(percent), LINKS)
    if not large.isEmpty():
        links = links.unionByName(_large_links(sets.join(large, "region"), percent))
    joined = saved(components(links, "circulant-joined"), "circulant-components")
    least = (joined.join(classes.select(F.col("cid").alias("id"), "rep").hint("merge"), "id")
             .groupBy("component").agg(F.min("rep").alias("least")))
    named = joined.join(least.hint("merge"), "component").select(F.col("id").alias("cid"), "least")
    classes = (classes.select("d1", "d2", "n", "cid", "rep", "copies").join(named.hint("merge"), "cid", "left")
               .withColumn("component", F.coalesce("least", "rep")).drop("least"))
    return Links(rows, classes)


def near_duplicates(documents: DataFrame, percent: int = 80, size: int = 2) -> DataFrame:
    """One row ``(doc_id, n_shingles, component_id, kept)`` for each row of ``documents(doc_id, text)``.

    A document's set holds its distinct ``size``-word shingles (A-Z lower-cased, words between ASCII spaces; a
    shorter text is one shingle). ``component_id`` is the smallest id reachable by links, ``kept`` says whether that is the
    row's own. A null or wordless text has an empty set and is its own component. Repeated rows give equal rows; rows of
    one id with different texts are judged by their own texts. A row without an id has the component of the rows with an
    equal set, or null, and is kept only in the latter case. Other columns are ignored.
    """
    found = circulant_links(documents, percent, size)
    several = found.classes.where("copies > 1 or component <> rep").select("d1", "d2", "n", "component")
    joined = found.rows.select("doc_id", "n", "d1", "d2").join(several.hint("merge"), ["d1", "d2", "n"], "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))
