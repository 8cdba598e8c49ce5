"""Near duplicates and repeated passages against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from procurelens.llm import jaccard_join, queries, sketch, substring_dedup
from procurelens.llm.components import components

SPACE = r"[^\x20\x09-\x0D]+"


def shingles(text):
    words = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, i), i)
    return sorted((i, len(s), least[x]) for (i, _), s, x in zip(rows, sets, label, strict=True))


def corpus(seed, groups=6, copies=5, words=40):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = " ".join(random.choices(vocabulary, k=12))
    texts = [None, "", "  \t\n", "one two three four", "One  two three FOUR", "é" * 30000, "a b c d e"]
    for _ in range(groups):
        base = random.choices(vocabulary, k=words)
        for _ in range(copies):
            copy = base[:]
            for _ in range(random.choice([0, 0, 1, 1, 2, 3])):
                copy[random.randrange(words)] = random.choice(vocabulary)
            texts.append(" ".join(copy) + (" " + common if random.random() < 0.3 else ""))
    texts += texts[-3:]
    random.shuffle(texts)
    return texts


def joined(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked_documents(df).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_all_pairs(documents, seed):
    texts = corpus(seed)
    assert joined(documents(texts)) == plain_components(list(enumerate(texts)))


def test_an_id_on_rows_with_several_texts_loses_no_link(documents):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    texts, ids = [a, b, a.replace("a7 ", "x "), b.replace("b7 ", "x ")], [1, 1, 2, 3]
    assert [(i, c) for i, _, c in joined(documents(texts, ids))] == [(1, 1), (1, 1), (2, 1), (3, 1)]


def test_words_whose_polynomials_collide_are_told_apart(documents):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 12))
    two = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(40))
    texts = [one, two, f"{rest} {one}", f"{two} {rest}"]
    assert joined(documents(texts[:2])) == plain_components(list(enumerate(texts[:2])))
    windows = [f"{one} " + " ".join(["v"] * 34), f"{two} " + " ".join(["v"] * 34)]
    rows = substring_dedup.without_repeats(documents(windows)).collect()
    assert [r["n_removed"] for r in rows] == [0, 0]


def test_voronoi_rounds_lose_no_link(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "REGION_DOCUMENTS", 3)
    texts = corpus(3, groups=3, copies=14, words=60)
    assert joined(documents(texts)) == plain_components(list(enumerate(texts)))


@pytest.mark.parametrize("shrink", [0.0, 0.7])
@pytest.mark.parametrize("seed", [4, 5])
def test_regions_that_no_cut_makes_smaller(documents, monkeypatch, seed, shrink):
    """With ``SHRINK`` 0 every large region goes to the pivots and then block by block."""
    monkeypatch.setattr(jaccard_join, "REGION_DOCUMENTS", 4)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)
    monkeypatch.setattr(jaccard_join, "PART_DOCUMENTS", 5)
    monkeypatch.setattr(jaccard_join, "SHRINK", shrink)
    texts = corpus(seed, groups=2, copies=30, words=50)
    assert joined(documents(texts)) == plain_components(list(enumerate(texts)))


def test_known_labels_join_without_a_link():
    sets = [np.arange(10) + 100 * i for i in range(4)]
    assert jaccard_join.join_region(sets, 80, np.array([9, 5, 9, 7])).tolist() == [0, 1, 0, 3]


def test_join_region_equals_all_pairs():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 10_000, 60)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.integers(10_000, 20_000, rng.integers(0, 6))])).astype(np.int64)
            for _ in range(60)]
    label = jaccard_join.join_region(sets, 80)
    want = plain = list(range(60))
    for i in range(60):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                want = [plain[j] if x == plain[i] else x for x in plain]
                plain = want
    assert len({(a, b) for a, b in zip(label.tolist(), want, strict=True)}) == len(set(want)) == len(set(label.tolist()))


def test_empty_table_and_null_ids(spark, documents):
    assert joined(documents([])) == []
    df = documents(["a b c d e f", "a b c d e f", "x"], ids=[None, 7, None])
    rows = [tuple(r) for r in jaccard_join.linked_documents(df).collect()]
    assert sorted(rows, key=repr) == sorted([(7, 2, 7), (None, 2, 7), (None, 1, None)], key=repr)


def test_one_of_each_keeps_the_first_and_all_columns(documents):
    df = documents(["a b c d e f", "A b c d e f", "other", "other text", "other"], ids=[3, 2, 5, 6, 5])
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 6]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r["id"]: r["component"] for r in components(links, "chain").collect()}
    assert all(found[i] == 0 for i in range(41)) and found[101] == 100


def plain_repeats(rows, size):
    words = [re.findall(SPACE, t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for at in range(len(w) - size + 1):
            if seen[tuple(w[at:at + size])] > 1:
                gone[at:at + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def cut(df, size):
    rows = substring_dedup.without_repeats(df, size).drop("kept_text").collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=repr)


@pytest.mark.parametrize("size", [1, 5, 35])
def test_repeats_equal_the_plain_version(documents, size, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARE", 50)  # several shares a task
    random.seed(size)
    passage = [f"p{i}" for i in range(50)]
    texts = [None, "", " \n ", "again " * 100, "x y " * 60, "word"]
    for k in range(12):
        own = [f"o{random.randrange(3000)}" for _ in range(random.randrange(0, 90))]
        at = random.randrange(len(own) + 1)
        texts.append(" ".join(own[:at] + passage[random.randrange(10):40 + random.randrange(10)] * (k % 2) + own[at:]))
    texts += [texts[-1], " ".join(passage[:35]), " ".join(passage[:34])]
    assert cut(documents(texts), size) == plain_repeats(list(enumerate(texts)), size)


def test_repeats_of_repeated_ids_and_extra_columns(documents):
    text = " ".join(f"w{i}" for i in range(40))
    df = documents([text, text, "short", text + " more"], ids=[1, 1, 1, None])
    assert cut(df, 35) == plain_repeats([(1, text), (1, text), (1, "short"), (None, text + " more")], 35)
    kept = substring_dedup.without_repeats(df, 35, keep=["score", "text"])
    assert kept.columns[:2] == ["doc_id", "others"] and {r["others"]["score"] for r in kept.collect()} == {0.5}
    assert cut(documents([]), 35) == []


def test_gaps_pack_and_unpack():
    for cells in ([], [0], [0, 0, 254, 255, 510, 511, 5000, 5000]):
        assert sketch.unpack(sketch.pack(np.array(cells, np.int64))).tolist() == cells


def test_queries_on_small_tables(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = queries.op8_jaccard_join(spark, small).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == plain_components(rows)
    got = queries.op9_substring_dedup(spark, small).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=repr) == plain_repeats(rows, 35)
