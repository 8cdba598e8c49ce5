"""Clustering with loosened bounds against plain Lloyd rounds."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from procurelens.llm import centroid_clusters as cc
from procurelens.llm import queries
from tests.compare import connect, difference

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"


def plain(rows, clusters=8, rounds=10, dimensions=64, scale=1024):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), i, v) for i, v in kept if i is not None)
    centres = [v for _, _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = [[] for _ in centres]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centres)]
    last = [nearest(v) for _, v in kept]
    each = [sum(d for d, j in last if j == n) for n in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, each[j], sum(each), digest[j]) for (i, _), (d, j) in zip(kept, last)), key=repr)


def found(spark, rows, **parameters):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    return sorted(map(tuple, cc.inertia_report(df, **parameters).collect()), key=repr)


def vectors(seed, count, dimensions=64, groups=5):
    random.seed(seed)
    middles = [[random.gauss(0, 1) for _ in range(dimensions)] for _ in range(groups)]
    return [(i, [random.gauss(m, 0.4) for m in random.choice(middles)]) for i in range(count)]


def test_equals_plain_rounds_with_odd_rows(spark):
    rows = vectors(1, 150)
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63),
             (905, [float("nan")] + [0.0] * 63), (906, [float("-inf")] + [0.0] * 63), (907, [0.0] * 64),
             (None, [0.25] * 64), rows[3], rows[3], (3, [0.5] * 64)]
    assert found(spark, rows) == plain(rows)


def test_ties_and_repeated_rows(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(40)]
    assert found(spark, rows) == plain(rows)


def test_few_or_no_vectors(spark):
    few = vectors(2, 5)
    assert found(spark, few) == plain(few)
    assert found(spark, [(1, None), (2, [1.0])]) == []
    assert found(spark, []) == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        found(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])


@settings(deadline=None, max_examples=200)
@given(st.integers(0, 10**6), st.floats(0, 30), st.sampled_from([0.1, 1.0, 10.0]))
def test_loosening_is_a_bound_and_at_most_the_drift(seed, radius, length):
    rng = np.random.default_rng(seed)
    dimensions = int(rng.integers(1, 5))
    old, centre = rng.normal(0, 10, dimensions), rng.normal(0, 10, dimensions)
    new = old + rng.normal(0, length, dimensions)
    bound = cc.loosening(old, new, centre, radius)
    assert bound <= np.linalg.norm(new - old) * (1 + 1e-12)
    rays = rng.normal(0, 1, (400, dimensions))
    points = centre + radius * rays / np.linalg.norm(rays, axis=1)[:, None] * rng.choice([1, 1, 0.5], 400)[:, None]
    nearer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
    assert nearer.max() <= bound + 1e-9


def test_bounds_save_most_comparisons_and_geometry_more_than_drift():
    rows = np.array([v for _, v in vectors(4, 4000, 8, 30)])
    vectors_ = np.floor(1024 * rows).astype(np.int64)

    def compared(full_drift):
        centres = vectors_[:30].copy()
        exact = cc.squared(vectors_, centres)
        cluster, lower = exact.argmin(axis=1), np.sqrt(exact)
        upper, scanned = lower[np.arange(len(lower)), cluster], 0
        for _ in range(12):
            after = np.array([vectors_[cluster == j].sum(axis=0) // max(1, (cluster == j).sum()) if (cluster == j).any()
                              else c for j, c in enumerate(centres)])
            radii = np.array([upper[cluster == j].max(initial=0) for j in range(len(centres))])
            step = cc.moved(centres, after, radii)
            if full_drift:
                step = step._replace(loosen=np.tile(step.drift, (len(centres), 1)))
            cluster, upper, lower, many = cc.assign(vectors_, cluster, upper, lower, step)
            assert (cluster == cc.squared(vectors_, after).argmin(axis=1)).all()
            centres, scanned = after, scanned + many
        return scanned

    assert compared(False) < compared(True) < 4000 * 12 / 2


def test_query_equals_its_sql(spark, small):
    result = queries.op11_centroid_clusters(spark, small)
    assert difference(result, connect(small), queries.SQL["op11_centroid_clusters"]) is None
