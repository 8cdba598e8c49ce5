"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from procurelens.llm import collocations as cl
from procurelens.llm import queries
from tests.compare import connect, difference

SCHEMA = "doc_id long, text string, lang string, n long, score string, phrase string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 7, "s", "p") for i, (lang, t) in enumerate(rows)], SCHEMA)


def plain(rows, longest=3, least=10, percent=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rated = []
        for p, a in frequent.items():
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            inside = (b for q, b in frequent.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if not any(100 * b >= percent * a for b in inside):
                rated.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df, **parameters):
    return sorted(map(tuple, cl.collocations(df, **parameters).collect()))


def corpus(seed, count=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["Édition", "ÉDITION", "ß x", "new line"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = ["New York City", "as well as", "of the", "x\ty  z"]
    rows = [(None, None), ("en", ""), ("en", " .,;\n"), (None, "one"), ("", "a b. A b! a\x0bb? a\tb"), ("xx", "never twice")]
    for _ in range(count):
        words = rng.choices(vocabulary, weights, k=rng.randrange(1, 40))
        for _ in range(3):
            words.insert(rng.randrange(len(words) + 1), rng.choice(fixed))
        joined = "".join(w + rng.choice([" ", " ", " ", ", ", "\t", ".", "\n", "\r\n", " ; "]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None, ""]), joined))
    return rows + rows[-5:]


@pytest.mark.parametrize("longest, least, percent", [(3, 10, 50), (4, 3, 80), (2, 2, 50)])
def test_equals_plain_counts(spark, longest, least, percent):
    rows = corpus(longest)
    assert found(table(spark, rows), longest=longest, least=least, percent=percent) == plain(rows, longest, least, percent)


@pytest.mark.parametrize("budget", [10, 60, 200])
def test_prefixes_above_the_budget_are_made_longer(spark, budget):
    rows = corpus(9)
    df = table(spark, rows)
    plan = cl.plan_groups(df.select("lang", "text"), df.sparkSession.createDataFrame(
        [(lang, w, f) for (lang, w), f in words_of(rows).items()], "lang string, phrase string, f long"), 3, budget)
    assert len(plan.longer) and plan.first + plan.rest > 10
    assert found(df, budget=budget, least=4) == plain(rows, least=4)


def words_of(rows):
    counts = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            counts.update(("und" if lang is None else lang, w) for w in re.findall(r"[^\x20\x09]+", piece))
    return counts


def test_top_and_ties(spark):
    rows = [("en", ". ".join(f"{c} {d}" for c in "abc" for d in "xyz"))] * 12
    assert found(table(spark, rows), top=4) == plain(rows, top=4)
    assert [r[2] for r in found(table(spark, rows), top=4)] == ["a x", "a y", "a z", "b x"]


def test_a_very_long_text_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(cl, "CHUNK", 1000)
    rng = random.Random(3)
    rows = [("en", " ".join(f"w{rng.randrange(40)}" for _ in range(200_000))), ("en", "w1 w2")]
    assert found(table(spark, rows), budget=5000) == plain(rows)


def test_empty_table(spark):
    assert found(table(spark, [("en", "a")]).limit(0)) == []


def test_counts_whose_products_pass_64_bits(spark):
    """Frequencies up to 10**15 are rated without rounding."""
    rng = random.Random(5)
    for _ in range(50):
        left, right = (rng.randrange(10**12, 10**15) for _ in range(2))
        a = rng.randrange(10**11, min(left, right))
        row = spark.sql(f"SELECT (CAST(1000000 AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0))) div "
                        f"(CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0))) AS s").first()
        assert row["s"] == 10**6 * a * a // (left * right)


def test_groups_are_filled_up_to_the_budget():
    groups, count = cl.packed_groups([9, 6, 5, 4, 1, 1], 10)
    assert (groups, count) == ([0, 1, 2, 2, 2, 3], 4)
    assert cl.packed_groups([], 10) == ([], 0)


def test_equal_rows_are_merged_in_order():
    rng = np.random.default_rng(1)
    columns = [rng.integers(-1, 4, 500), rng.integers(0, 1 << 40, 5)[rng.integers(0, 5, 500)], rng.integers(-1, 1 << 20, 3)[rng.integers(0, 3, 500)]]
    first, counts = cl._unique(columns)
    rows = list(zip(*(c.tolist() for c in columns)))
    assert [rows[i] for i in first] == sorted(set(rows))
    assert dict(zip((rows[i] for i in first), counts.tolist())) == Counter(rows)


def test_query_equals_its_sql(spark, small):
    result = queries.op12_collocations(spark, small)
    assert difference(result, connect(small), queries.SQL["op12_collocations"]) is None
