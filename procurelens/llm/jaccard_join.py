"""N-gram Jaccard self-join as a join in a metric space, exact at any size.

The Jaccard distance of shingle sets is a metric, so pivots cut the documents into
Voronoi regions, and by the triangle inequality a partner of ``x`` within ``r`` lies in
a region whose pivot is at most ``d(x, home pivot) + 2 r`` away from ``x``: only those
regions get a copy of ``x``. Regions are cut again until they are small, and joined there
against pivots whose distances rule out most pairs.

Almost all pairs of documents are at distance 1, where no pivot tells them apart. So

1. equal sets become one *class* with one representative;
2. a representative with a partner at similarity ``t`` shares ``t`` of its shingles with it; a
   corpus-wide sketch (never under-counting) shows that nearly all documents do not, and
   they are done;
3. the rest meet in first regions: each looks at its rarest shingles, of which linked sets
   share at least one (``n - ceil(t n) + 1`` of them, ordered by true frequency, ties by
   hash); the components of "shares such a shingle" hold every link;
4. large regions are cut by Voronoi rounds on the cluster, and regions within the bounds are joined exactly;
5. a region that no cut makes smaller (thousands of texts within the window of each other) is linked to its
   pivots in parts; then only documents outside its largest component meet the others, block by block.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .sketch import repeated, size_bits
from .store import saved
from .wordhash import LOWER, U, lists, mix, shingle_sets, signed, slices, split_words

#: Cells per shingle of the sketch (rounded up to a power of two).
CELLS = 1
#: Regions of more documents, or of more shingles, are cut on the cluster first.
REGION_DOCUMENTS, REGION_SHINGLES, PIVOTS, CUTS, SHRINK = 4000, 4_000_000, 8, 5, 0.7
#: Documents and shingles of a large region that one task compares with pivots.
PART_DOCUMENTS, PART_SHINGLES = 1000, 500_000


class Links(NamedTuple):
    """``classes(rep, d1, d2, n, component)``: classes that are linked or have several rows;
    ``sizes(<key>, n, d1, d2)``: one row for each document."""

    sizes: DataFrame
    classes: DataFrame


def _digests(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    return tuple([int(mix(s ^ U(salt)).sum().view(np.int64)) if len(s) else 0 for s in sets]
                 for salt in (0x243F6A8885A308D3, 0x13198A2E03707344))


def _set_sizes(size: int):
    def run(batches):
        for part in slices(batches):
            sets = list(shingle_sets(split_words(part.column("text"), LOWER), size))
            one, two = _digests(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["doc_id", "n", "d1", "d2"])

    return run


def _shared_sets(size: int, percent: int, seen):
    """Documents of which at least ``percent`` of the shingles may occur elsewhere, with their sets."""
    def run(batches):
        known = seen.value
        for part in slices(batches):
            sets = list(shingle_sets(split_words(part.column("text"), LOWER), size))
            sizes = np.array([len(s) for s in sets], np.int64)
            ends = np.cumsum(sizes)
            hits = np.concatenate([[0], np.cumsum(known(np.concatenate(sets)))])
            shared = hits[ends] - hits[ends - sizes]
            kept = np.flatnonzero((sizes > 0) & (100 * shared >= percent * sizes))
            if len(kept):
                sets = [sets[i] for i in kept]
                one, two = _digests(sets)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(kept)), pa.array(sizes[kept]),
                     pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists([signed(s) for s in sets])],
                    names=["doc_id", "n", "d1", "d2", "shingles"])

    return run


class _Sets:
    """Shingle sets of a region with postings, for the overlap of one set with all."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.ends = np.cumsum(self.sizes)
        flat = np.concatenate(sets)
        _, self.codes = np.unique(flat, return_inverse=True)
        order = np.argsort(self.codes, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(self.codes))])

    def overlaps(self, i: int) -> np.ndarray:
        codes = self.codes[self.ends[i] - self.sizes[i]:self.ends[i]]
        first, count = self.begin[codes], self.begin[codes + 1] - self.begin[codes]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        return np.bincount(self.owner[at], minlength=len(self.sizes))


def _listed(table: pa.Table) -> list[np.ndarray]:
    """The column ``shingles`` as one array for each row."""
    column = table.column("shingles").combine_chunks()
    flat, bounds = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[bounds[i]:bounds[i + 1]] for i in range(len(table))]


def join_region(sets: list[np.ndarray], percent: int, known: np.ndarray | None = None) -> np.ndarray:
    """The component (an index) of every set, by links of at least ``percent`` similarity.

    Sets with equal labels in ``known`` are in one component already. Each set in turn is a pivot for
    those after it; a set is compared only with sets of other components whose distances to all pivots so
    far differ by at most ``r`` from its own.
    """
    data, count = _Sets(sets), len(sets)
    radius = 1 - percent / 100 + 1e-9
    label = np.arange(count)
    if known is not None:
        _, first, place = np.unique(known, return_index=True, return_inverse=True)
        label = first[place]
    pivots: list[np.ndarray] = []
    for i in range(count):
        open_ = label != label[i]
        open_[:i] = False
        for far in pivots:
            if not open_.any():
                break
            open_ &= np.abs(far - far[i]) <= radius
        if not open_.any():
            continue
        both = data.overlaps(i)
        union = data.sizes + data.sizes[i] - both
        linked = np.unique(label[np.flatnonzero(100 * both >= percent * union)])
        label[np.isin(label, linked)] = linked[0]
        if len(pivots) < 32:
            pivots.append(1 - both / union)
        if (label == label[0]).all():
            break
    return label


def _join_regions(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        sets = _listed(table)
        known = table.column("label").to_numpy()[order] if "label" in table.column_names else None
        label = join_region([sets[i] for i in order], percent, known)
        return pa.table({"a": pa.array(ids[order]), "b": pa.array(ids[order][label])})

    return run


def _overlaps(documents: pa.Table, pivots: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of intersection and union of each document's set with each pivot's."""
    own, centres = _listed(documents), _listed(pivots)
    both = np.array([[np.isin(each, centre, assume_unique=True).sum() for centre in centres] for each in own], np.int64)
    both = both.reshape(len(own), len(centres))
    sizes = [np.array([len(s) for s in sets], np.int64) for sets in (own, centres)]
    return both, sizes[0][:, None] + sizes[1] - both


def _to_pivots(percent: int):
    """Give documents of a region to the region of the nearest pivot, and to those within the window."""
    radius = 1 - percent / 100

    def run(documents: pa.Table, pivots: pa.Table) -> pa.Table:
        pivots = pivots.sort_by("doc_id")
        both, union = _overlaps(documents, pivots)
        far = 1 - both / union
        within = far <= far.min(axis=1)[:, None] + 2 * radius + 1e-9
        row, pivot = np.nonzero(within)
        out = documents.select(["doc_id", "n", "shingles"]).take(pa.array(row))
        centre_ids = pivots.column("doc_id").to_numpy()[pivot]
        old = documents.column("region").to_numpy()[row].astype(U)
        new = mix(old * U(0x9E3779B97F4A7C15) + centre_ids.astype(U))
        return out.append_column("region", pa.array(signed(new))).append_column("parent", pa.array(old.view(np.int64)))

    return run


def _pivot_links(percent: int):
    """Links of a region's documents with its pivots."""
    def run(documents: pa.Table, pivots: pa.Table) -> pa.Table:
        if not len(pivots):  # every document of the region is in its largest component
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        both, union = _overlaps(documents, pivots)
        row, pivot = np.nonzero(100 * both >= percent * union)
        return pa.table({"a": documents.column("doc_id").combine_chunks().take(pa.array(row)),
                         "b": pivots.column("doc_id").combine_chunks().take(pa.array(pivot))})

    return run


def _big(regions: DataFrame) -> DataFrame:
    sizes = regions.groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("words"))
    return sizes.where((F.col("docs") > REGION_DOCUMENTS) | (F.col("words") > REGION_SHINGLES))


def _in_parts(rows: DataFrame, big: DataFrame) -> DataFrame:
    """Documents of large regions, each region in parts of bounded size."""
    return (rows.join(big, "region")
            .withColumn("parts", F.ceil(F.greatest(F.col("docs") / PART_DOCUMENTS, F.col("words") / PART_SHINGLES)).cast("long"))
            .withColumn("part", F.expr("pmod(xxhash64(doc_id), parts)")))


def _pivots(rows: DataFrame, step: int) -> DataFrame:
    """Some documents of each region, chosen by hash, a copy for each part."""
    order = Window.partitionBy("region").orderBy(F.xxhash64("doc_id", F.lit(step)), "doc_id")
    chosen = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
    return saved(chosen.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
                 .select("region", "part", "doc_id", "shingles"), "jaccard-pivots")


def _cut(regions: DataFrame, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Cut regions above the bounds by Voronoi rounds: regions within the bounds, and those that stay above.

    A region whose largest part keeps more than ``SHRINK`` of it (its documents all lie within the window of each
    other, mostly in one component) is not cut.
    """
    whole = None
    schema = "doc_id long, n long, shingles array<bigint>, region long, parent long"
    columns = ["doc_id", "n", "shingles", "region"]
    regions = regions.select(columns)
    for step in range(CUTS + 1):
        big = saved(_big(regions), "jaccard-big")
        if big.isEmpty():
            break
        large = _in_parts(regions, big)
        small = regions.join(big, "region", "left_anti").select(columns)
        if step == CUTS:
            stuck, regions = large.select(columns), small
        else:
            pivots = _pivots(large, step)
            dealt = saved(large.groupBy("region", "part").cogroup(pivots.groupBy("region", "part"))
                          .applyInArrow(_to_pivots(percent), schema), "jaccard-cut")
            largest = (dealt.groupBy("parent", "region").count().groupBy("parent").agg(F.max("count").alias("largest"))
                       .join(big, F.col("parent") == big.region).where(F.col("largest") <= SHRINK * F.col("docs")).select("parent"))
            done = saved(largest, "jaccard-shrunk")
            stuck = large.join(done, F.col("region") == done.parent, "left_anti").select(columns)
            shrunk = dealt.join(done, "parent", "left_semi").select(columns)
            regions = saved(small.unionByName(shrunk), "jaccard-regions")
        whole = stuck if whole is None else whole.unionByName(stuck)
    return regions, whole


def _join_large(large: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that have the components of regions of any size; a task holds a part of a region, or two.

    Rounds link documents outside their region's largest component so far to pivots from among themselves, while that
    takes many of them in. Pairs inside the largest component need no look any more; all others meet in blocks.
    """
    big = saved(_big(large), "jaccard-big")
    rows = saved(_in_parts(large, big).select("doc_id", "n", "shingles", "region", "parts", "part"), "jaccard-large")
    outside, links, before = rows, None, None
    for step in range(CUTS):
        found = saved(rows.groupBy("region", "part").cogroup(_pivots(outside, step).groupBy("region", "part"))
                      .applyInArrow(_pivot_links(percent), "a long, b long"), "jaccard-pivot-links")
        links = found if links is None else links.unionByName(found)
        joined = components(links, "jaccard-large")
        named = (rows.select("region", "doc_id", "n").join(joined, F.col("doc_id") == F.col("id"), "left")
                 .select("region", "doc_id", "n", F.coalesce("component", "doc_id").alias("label")))
        top = (named.groupBy("region", "label").count().groupBy("region")
               .agg(F.max(F.struct("count", "label"))["label"].alias("top")))
        named = saved(named.join(top, "region").withColumn("outside", F.col("label") != F.col("top")), "jaccard-labels")
        left = named.where("outside").count()
        if not left or before is not None and left > SHRINK * before:
            break
        before = left
        outside = rows.join(named.where("outside"), ["region", "doc_id"], "left_semi").select(rows.columns)

    def blocks(which: str):
        docs, words = F.expr(f"count_if({which})"), F.expr(f"coalesce(sum(n) filter (where {which}), 0)")
        return F.ceil(F.greatest(docs / (REGION_DOCUMENTS / 2), words / (REGION_SHINGLES / 2))).cast("long")

    bounds = named.groupBy("region").agg(blocks("outside").alias("out"), blocks("not outside").alias("ins")).where("out > 0")
    block = F.expr("if(outside, pmod(xxhash64(doc_id), out), out + pmod(xxhash64(doc_id), ins))")
    other = F.explode(F.expr("sequence(0L, if(outside, out + ins, out) - 1)"))
    dealt = (rows.select("region", "doc_id", "shingles").join(named.join(bounds, "region").select(
                "region", "doc_id", "label", block.alias("block"), other.alias("other")), ["region", "doc_id"])
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    return links.unionByName(dealt.groupBy("region", "low", "high").applyInArrow(_join_regions(percent), "a long, b long"))


def jaccard_links(documents: DataFrame, percent: int = 80, size: int = 5) -> Links:
    """Link documents of ``documents(doc_id long, text)`` whose sets of distinct ``size``-word
    shingles (A-Z lower-cased, words between ASCII spaces; a shorter text is one shingle) are
    similar by at least ``percent``. See ``linked_documents`` for the rows.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long"), "text")
    sizes = saved(documents.mapInArrow(_set_sizes(size), "doc_id long, n long, d1 long, d2 long"), "jaccard-sizes")
    classes = (sizes.where("n > 0").groupBy("d1", "d2", "n")
               .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("rep is not null"))
    # classes have numbers of their own: an id may stand on rows of several of them
    classes = saved(classes.withColumn("class", F.monotonically_increasing_id()), "jaccard-classes")
    total = sizes.agg(F.sum("n")).first()[0] or 0

    def items(batch):
        for part in slices([batch]):
            yield np.concatenate(list(shingle_sets(split_words(part.column("text"), LOWER), size)))

    seen = spark.sparkContext.broadcast(repeated(documents.select("text"), items, size_bits(total, CELLS)))
    open_ = documents.mapInArrow(_shared_sets(size, percent, seen),
                                 "doc_id long, n long, d1 long, d2 long, shingles array<bigint>")
    reps = classes.select(F.col("rep").alias("doc_id"), "d1", "d2", "n", "class")
    open_ = saved(open_.join(reps, ["doc_id", "d1", "d2", "n"]).dropDuplicates(["class"])
                  .select(F.col("class").alias("doc_id"), "n", "shingles"), "jaccard-open")

    each = open_.select("doc_id", "n", F.explode("shingles").alias("s"))
    counts = each.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    met = each.join(counts, "s")
    by_document = Window.partitionBy("doc_id")
    prefix = (met.withColumn("place", F.row_number().over(by_document.orderBy("df", "s")))
              .withColumn("unmet", F.col("n") - F.count("*").over(by_document))
              .where(F.expr(f"place + unmet <= n - ceil({percent} * n / 100.0) + 1")).select("doc_id", "s"))
    prefix = saved(prefix, "jaccard-prefix")
    first = prefix.groupBy("s").agg(F.min("doc_id").alias("b"), F.count("*").alias("many")).where("many > 1")
    stars = prefix.join(first, "s").select(F.col("doc_id").alias("a"), "b")
    region = components(stars, "jaccard-region").select(F.col("id").alias("doc_id"), F.col("component").alias("region"))
    regions, large = _cut(saved(open_.join(region, "doc_id"), "jaccard-regions"), percent)
    links = regions.groupBy("region").applyInArrow(_join_regions(percent), "a long, b long")
    if large is not None:
        links = links.unionByName(_join_large(large, percent))
    joined = saved(components(links, "jaccard-joined"), "jaccard-components")
    least = (joined.join(classes.select(F.col("class").alias("id"), "rep"), "id")
             .groupBy("component").agg(F.min("rep").alias("least")))
    named = joined.join(least, "component").select("id", "least")
    classes = (classes.join(named, F.col("class") == F.col("id"), "left")
               .where("copies > 1 or least is not null")
               .select("d1", "d2", "n", "rep", "copies", F.coalesce("least", "rep").alias("component")))
    return Links(sizes, classes)


def linked_documents(documents: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """One row ``(doc_id, n_shingles, component_id)`` for each row of ``documents``.

    ``component_id`` is the smallest id reachable by links. A null or wordless text has an empty
    set, size 0, and is its own component. Repeated rows (equal id and text) give equal rows; rows
    of one id with different texts are judged by their own texts. Without an id, a row has the
    component of its equals, or null. Other columns are ignored.
    """
    found = jaccard_links(documents, percent, size)
    classes = found.classes.select("d1", "d2", "n", "component")
    return (found.sizes.join(classes, ["d1", "d2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc_id").alias("component_id")))


def one_of_each(documents: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The documents that are the first of their component; all columns are kept.

    Of rows that repeat an id and text one stays. An id of which some row belongs to an earlier
    document's component goes with all its rows; rows without an id stay.
    """
    rows = saved(linked_documents(documents, percent, size), "jaccard-rows")
    gone = saved(rows.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-gone")
    again = saved(rows.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"),
                  "jaccard-repeated")
    kept = documents.join(gone, "doc_id", "left_anti").select(documents.columns)
    if again.isEmpty():
        return kept
    repeated_rows = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return (kept.join(again, "doc_id", "left_anti").unionByName(repeated_rows)).select(documents.columns)
