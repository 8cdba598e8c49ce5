"""Circulant MinHash against plain sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from procurelens.llm import circulant_minhash as cm
from procurelens.llm import components, queries
from procurelens.llm.store import saved
from tests.compare import connect, difference

from .test_joins import SPACE


def shingles(text, size=2):
    words = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def plain(rows):
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {x: min(i for (i, _), y in zip(rows, label) if x == y) for x in set(label)}
    return sorted((i, len(s), least[x], i == least[x]) for (i, _), s, x in zip(rows, sets, label))


def found(df):
    return sorted(map(tuple, cm.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()))


def corpus(seed, groups=6, copies=6, words=60, edits=(0, 0, 1, 2, 3, 4, 5)):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", " \t\x0b\n", "one", "ONE", "one  two", "One\ttwo", "é" * 20000, "a b a b a b", "A b a"]
    for _ in range(groups):
        base = rng.choices(vocabulary, k=words)
        for _ in range(copies):
            copy = base[:]
            for _ in range(rng.choice(edits)):
                copy[rng.randrange(words)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += texts[-3:]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(documents, seed):
    texts = corpus(seed)
    assert found(documents(texts)) == plain(list(enumerate(texts)))


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_large_regions_by_hubs_and_blocks(documents, monkeypatch, seed):
    monkeypatch.setattr(cm, "TASK_CLASSES", 4)
    monkeypatch.setattr(cm, "HUBS", seed - 2)
    texts = corpus(seed, groups=3, copies=20, edits=(0, 2, 4, 6, 8))
    assert found(documents(texts)) == plain(list(enumerate(texts)))


def test_a_very_long_text_and_its_copy(documents):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]
    copy = words[:]
    for i in range(0, len(words), 25):
        copy[i] = "edited"
    texts = [" ".join(words), "other words", " ".join(copy)]
    assert found(documents(texts)) == plain(list(enumerate(texts)))


def test_only_tables_of_large_regions_are_broadcast(spark, documents, monkeypatch):
    """A broadcast passes through the driver: tables that grow with the input are merged, whatever the threshold."""
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return saved(df, name)

    monkeypatch.setattr(cm, "saved", noted)
    monkeypatch.setattr(components, "saved", noted)
    monkeypatch.setattr(cm, "TASK_CLASSES", 4)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1g")
    try:
        texts = corpus(9, groups=3, copies=20, edits=(0, 2, 4, 6, 8))
        result = cm.near_duplicates(documents(texts))
        rows = sorted(map(tuple, result.collect()))
        plans.append(result._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set(limit, before)
    assert rows == plain(list(enumerate(texts)))
    merged, sent = (set().union(*(re.findall(rf"{kind} \[(\w+?)#\d+L?.*?\], \w+(?:, (Build\w+))?", p) for p in plans))
                    for kind in ("SortMergeJoin(?:\\(skew=true\\))?", "Broadcast\\w+Join"))
    assert {key for key, _ in merged} >= {"u", "cid", "b", "id", "component", "doc_id", "d1"}
    assert sent <= {("region", "BuildRight")}


def test_repeated_ids_and_missing_ids(documents):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    near_a, near_b = a.replace("a7 ", "x "), b.replace("b7 ", "x ")
    texts, ids = [a, b, near_a, near_b, a, a, near_b, "alone here", None], [1, 1, 2, 3, 1, None, None, None, None]
    rows = sorted(map(tuple, cm.near_duplicates(documents(texts, ids)).collect()), key=repr)
    n, m = len(shingles(a)), len(shingles(near_a))
    assert rows == sorted([(1, n, 1, True), (1, n, 1, True), (1, n, 1, True), (2, m, 1, False), (3, m, 1, False),
                           (None, n, 1, False), (None, m, 1, False), (None, 1, None, True), (None, 0, None, True)], key=repr)


def test_empty_table(documents):
    assert cm.near_duplicates(documents([]).limit(0)).collect() == []


def test_coordinates_agree_as_often_as_sets_do():
    rng = np.random.default_rng(7)
    for share in (0.5, 0.8, 0.95):
        common, own = int(1000 * share), int(1000 * (1 - share))
        seen = []
        for _ in range(20):
            pool = rng.integers(0, 2**63, common + 2 * own).astype(np.uint64)
            a, b = np.unique(pool[:common + own]), np.unique(np.concatenate([pool[:common], pool[common + own:]]))
            x, y = cm.signatures([a, b])
            seen.append((x == y).mean())
        true = common / (common + 2 * own)
        assert abs(np.mean(seen) - true) < 4 * np.sqrt(true * (1 - true) / (20 * x.size))


def test_turns_are_permutations_and_signatures_minima(monkeypatch):
    places = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    spare = np.empty_like(places)
    one, two = (cm.turned(places, k, np.empty_like(places), spare) for k in (0, 5))
    assert len(np.unique(one)) == len(places)
    assert (two == cm.turned(places + np.uint32(5), 0, np.empty_like(places), spare)).all()
    rng = np.random.default_rng(8)
    sets = [rng.integers(0, 2**63, size).astype(np.uint64) for size in (1, 700, 3, 50, 2000)]
    whole = cm.signatures(sets, 9)
    for i, s in enumerate(sets):
        p = cm.sigma(s)
        assert whole[i].tolist() == [int(cm.turned(p, k, np.empty_like(p), np.empty_like(p)).min()) for k in range(9)]
    monkeypatch.setattr(cm, "CACHED", 60)
    assert (cm.signatures(sets, 9) == whole).all()


def test_words_whose_polynomials_collide_are_told_apart(documents):
    """Two complementary words of a and b, as any polynomial modulo 2**64 confuses them."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 12))
    two = one.translate(str.maketrans("ab", "ba"))
    texts = [one, two, f"x {one} y", f"x {two} y"]
    assert found(documents(texts)) == plain(list(enumerate(texts)))


def test_query_equals_its_sql(spark, small):
    result = queries.op13_circulant_minhash(spark, small)
    assert difference(result, connect(small), queries.SQL["op13_circulant_minhash"]) is None
