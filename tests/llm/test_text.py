"""Operators on single texts against plain versions, round trips and held-out labels."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from procurelens.llm import (decontaminate, elias_fano, license_scan, mil_quality, one_permutation, queries, sp_viterbi, store)
from procurelens.llm.wordhash import LETTERS, split_words

ODD = st.text(st.sampled_from(list("abcXYZ éÉßÀ'.,!|<>\n\t\r ̣́ΣςİıÅ中文ªº01☃😀\x1c\x1f\x85▁")), max_size=60)


@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def pieces():
    return sp_viterbi.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def test_word_encoder_equals_the_tokenizer(definition):
    whole, own = Tokenizer.from_str(definition), elias_fano.WordEncoder(definition)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.one_of(st.none(), ODD), min_size=1, max_size=6))
    def run(texts):
        ids, ends = own.encode(pa.array(texts, pa.string()), 2)
        for text, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
            assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids + [2]

    run()


@given(st.lists(st.integers(0, 10 ** 6), max_size=300))
@settings(max_examples=60, deadline=None)
def test_elias_fano_gives_every_number_back(numbers):
    values = np.sort(np.array(numbers, np.int64))
    held = elias_fano.Boundaries.of(values)
    assert held.select(np.arange(len(values))).tolist() == values.tolist()
    some = np.arange(len(values))[::-3]
    assert held.select(some).tolist() == values[some].tolist()


def test_blocks_are_small_and_round_trip():
    ids, ends = np.arange(5000) % 49408, np.arange(25, 5001, 25)
    raw = elias_fano.pack(ids, ends, 2)
    assert len(raw) < 2 * len(ids) + len(ends) * 9 / 8 + 4 * len(ends) / 64 + 60
    back, bounds = elias_fano.unpack(raw)
    assert back.tolist() == ids.tolist() and bounds.select(np.arange(len(ends))).tolist() == ends.tolist()


def test_token_files(spark, documents, definition, monkeypatch):
    monkeypatch.setattr(elias_fano, "BLOCK_IDS", 16)
    texts = [None, "", "The cat, the CAT.", "word " * 60, "zwölf Übel\n\n", "x"]
    ids = [9, -3, 4, 4, None, 2]
    path = store.new_path(spark, "tokens")
    elias_fano.write_tokens(documents(texts, ids), path, definition, 2)
    whole = Tokenizer.from_str(definition)
    want, start = [], 0
    for i, text in sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        encoded = whole.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(encoded), zlib.crc32(np.array(encoded, "<u4").tobytes()), encoded))
        start += len(encoded)
    got = elias_fano.read_tokens(spark, path, ids=True).orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    some = spark.createDataFrame([(4,), (2,), (2,), (77,), (None,)], "doc_id long")
    got = elias_fano.read_tokens(spark, path, ids=True, wanted=some).orderBy("start").collect()
    assert [tuple(r) for r in got] == [w for w in want if w[0] in (2, 4)]
    path = store.new_path(spark, "tokens")
    elias_fano.write_tokens(documents([]), path, definition, 2)
    assert elias_fano.read_tokens(spark, path).collect() == []


def best_cut(pieces, text):
    """Plain Viterbi over the whole text."""
    if not text:
        return []
    text = sp_viterbi.MARK + text.replace(sp_viterbi.MARK, sp_viterbi.LITERAL).replace(" ", sp_viterbi.MARK)
    best = [(0.0, 0, [])] + [(-math.inf, 0, [])] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - pieces.longest), end):
            known = pieces.pieces.get(text[start:end])
            if known and best[start][0] + known[1] > best[end][0]:
                best[end] = (best[start][0] + known[1], start, [known[0]])
        if text[end - 1] not in pieces.pieces:
            raw = pieces._bytes(text[end - 1])
            if best[end - 1][0] + pieces.byte_score * len(raw) > best[end][0]:
                best[end] = (best[end - 1][0] + pieces.byte_score * len(raw), end - 1, raw)
    out, end = [], len(text)
    while end:
        _, start, ids = best[end]
        out, end = ids + out, start
    return out


def test_pieces_equal_plain_viterbi_and_round_trip(pieces):
    encoder = sp_viterbi.Encoder(pieces)

    @settings(max_examples=100, deadline=None)
    @given(st.lists(st.one_of(st.none(), ODD, st.text(max_size=30)), min_size=1, max_size=5))
    def run(texts):
        ids, ends = encoder.encode(pa.array(texts, pa.string()))
        assert encoder.decode(ids, ends).to_pylist() == [t or "" for t in texts]
        for text, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
            assert ids[a:b].tolist() == best_cut(pieces, text)

    run()


def test_stream_commits_early(pieces):
    text = sp_viterbi.MARK + sp_viterbi.MARK.join(["there", "is", "a", "long", "text"] * 50)
    parts = list(pieces.stream(text))
    assert len(parts) >= 250 and [i for p in parts for i in p] == best_cut(pieces, text[1:].replace(sp_viterbi.MARK, " "))


def test_encode_and_decode_frames(spark, documents, pieces):
    texts = [None, "", "Hello  world\n a", "x" * 5000, "😀▁"]
    df = documents(texts).withColumnRenamed("source", "ids")  # a clashing name
    encoded = sp_viterbi.encode_pieces(df, pieces)
    assert all(r["round_trip"] for r in encoded.collect())
    back = sp_viterbi.decode_pieces(encoded, pieces).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {i: t or "" for i, t in enumerate(texts)}
    assert sp_viterbi.encode_pieces(documents([]), pieces).collect() == []


def test_quality_on_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op2_mil_quality(spark, folder).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_quality_of_odd_texts(spark, documents):
    df = documents([None, "", " \n", "x" * 50_000, "some words here", "some words here"])
    labels = spark.createDataFrame([(4, 1), (3, 0), (3, None), (77, 0)], "doc_id long, quality int")
    model = mil_quality.train(df, labels)
    got = {r["doc_id"]: r["score"] for r in mil_quality.score(df, model).collect()}
    assert got[0] == got[1] == got[2] == 0 and got[4] == got[5] and len(got) == 6
    untaught = mil_quality.train(df, labels.where("quality = 1"))
    assert {r["p"] for r in mil_quality.score(df, untaught, "p").where("doc_id > 2").collect()} == {0.5}
    assert mil_quality.score(documents([]), model).collect() == []


def test_leaks_exact_edited_and_clean(spark, documents):
    random.seed(5)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [" ".join(random.choices(vocabulary, k=30)) for _ in range(5)]
    edited = items[1].split()
    edited[4], edited[15] = "new", "other"
    del edited[22]
    noise = lambda n: " ".join(random.choices(vocabulary, k=n))
    texts = [f"{noise(50)} {items[0]}, {noise(30)}", f"{noise(9)} {' '.join(edited).upper()}! {noise(5)}", noise(300), None, "",
             f"{noise(20)} {' '.join(items[2].split()[:8])} {noise(20)}", items[3] + " " + noise(3) + " " + items[4]]
    benchmark = spark.createDataFrame([*enumerate(items), (7, None), (8, ""), (9, items[0])], "item_id long, text string")
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(texts), benchmark).collect()]
    assert sorted(found) == [(0, 0), (1, 1), (6, 3), (6, 4)]
    row = decontaminate.leaks(documents(texts[:1]), benchmark).first()
    assert (row["score"], row["first_word"], row["last_word"]) == (1.0, 50, 80)
    assert decontaminate.leaks(documents([]), benchmark).collect() == []
    assert decontaminate.leaks(documents(texts), benchmark.where("item_id > 6 and item_id < 9")).collect() == []


def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -decontaminate.COST),
                          h[i - 1, j] - decontaminate.COST, h[i, j - 1] - decontaminate.COST)
    return h.max()


@given(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.lists(st.integers(0, 3), min_size=1, max_size=15))
@settings(max_examples=80, deadline=None)
def test_alignment_equals_the_plain_table(a, b):
    assert decontaminate.align(np.array(a), np.array(b))[0] == pytest.approx(plain_align(a, b))


@pytest.mark.parametrize("bits", [None, 7])
def test_leaks_equal_the_alignment_of_every_item_with_every_document(spark, documents, monkeypatch, bits):
    if bits:  # bitmaps so full that nearly all grams go on to the join
        monkeypatch.setattr(decontaminate, "MIN_BITS", bits)
        monkeypatch.setattr(decontaminate, "MAX_BITS", bits)
    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(300)]
    word = lambda: rng.choice(common if rng.random() < 0.4 else rare)
    noise = lambda n: [word() for _ in range(n)]
    items = [noise(n) for n in (15, 20, 33, 40, 40)] + [rng.choices(common, k=20)]
    texts = [noise(60), noise(200), rng.choices(common, k=150), items[2] + items[2], noise(3) + items[3] + noise(2) + items[3]]
    for item in items:
        for step in (3, 4, 5, 6, 7):  # a changed word, or one more, in every few
            texts.append(noise(20) + [word() if i % step == 0 else w for i, w in enumerate(item, 1)] + noise(20))
            texts.append(noise(9) + [x for i, w in enumerate(item, 1) for x in ([w, word()] if i % step == 0 else [w])] + noise(9))
        for rate in (0.05, 0.1, 0.15, 0.2, 0.25):
            texts.append(noise(20) + [word() if rng.random() < rate else w for w in item] + noise(20))
        texts.append(noise(5) + [x for w in item for x in (w, word())] + noise(5))
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    got = defaultdict(list)
    for r in decontaminate.leaks(documents([" ".join(t) for t in texts]), benchmark).collect():
        got[r["doc_id"], r["item_id"]].append((r["score"], r["first_word"], r["last_word"]))
    number = {w: i for i, w in enumerate(common + rare)}
    texts, items = [[np.array([number[w] for w in t]) for t in part] for part in (texts, items)]
    scores = {(d, i): plain_align(item, text) / len(item) for d, text in enumerate(texts) for i, item in enumerate(items)}
    want = {pair: score for pair, score in scores.items() if score >= decontaminate.LIKENESS}
    assert {pair: max(rows)[0] for pair, rows in got.items()} == want and len(want) > 80
    for (d, i), rows in got.items():
        assert all(plain_align(items[i], texts[d][a:b]) / len(items[i]) == score for score, a, b in rows)
        assert sorted(rows) == sorted(decontaminate.passages(items[i], texts[d], decontaminate.LIKENESS))
    assert len(got[3, 2]) == len(got[4, 3]) == 2


def test_seeds_are_pairs_of_words_joined_to_the_corpus(spark, documents):
    rng = random.Random(8)
    common = [f"c{i}" for i in range(20)]
    item = rng.choices(common, k=30)
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    corpus = documents([" ".join(rng.choices(common, k=400)) for _ in range(5)] + [" ".join(item)]).select(
        "text", F.unhex(F.md5("text")).alias("key"))
    items = decontaminate._items(benchmark)
    grams = decontaminate._grams(items)
    words = split_words(pa.array([" ".join(item)]), LETTERS).hashes()
    assert grams.count() == 59 and {r["gram"] for r in grams.collect()} >= set(words.view(np.int64).tolist())
    wanted = spark.sparkContext.broadcast(decontaminate._Bitmap.of(grams))
    counts = {r["gram"]: r["times"] for r in decontaminate._counts(corpus, wanted).collect()}
    assert counts[None] == 2030 and sum(counts.get(g, 0) for g in set(words.view(np.int64).tolist())) <= 2030
    times = spark.createDataFrame([(g, n) for g, n in counts.items() if g is not None], "gram long, times long")
    seeds = decontaminate._seeds(grams, times, 2030, 0.5).collect()
    pairs = set(decontaminate.pair_hashes(words).view(np.int64).tolist())
    assert sum(r["gram"] in pairs for r in seeds) > len(seeds) / 2  # words are common here, pairs are rare
    found = decontaminate._candidates(decontaminate._hits(corpus, wanted), spark.createDataFrame(
        seeds, "gram long, item_id long, needed int, span int"), items).collect()
    assert any(f["item_id"] == 1 for r in found for f in r["found"])


def test_leaks_of_repeated_and_long_texts(spark, documents):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [[word() for _ in range(n)] for n in (1, 2, 30)]
    benchmark = spark.createDataFrame([(i, " ".join(item), "x") for i, item in enumerate(items)],
                                      "item_id long, text string, doc_id string")
    long = [word() for _ in range(60_000)]
    long[40_000:40_030] = items[2]
    texts = [" ".join(long), " ".join(items[2]), " ".join(items[2]), items[0][0], "none"]
    got = decontaminate.leaks(documents(texts, [5, 6, 6, None, 8]), benchmark)
    rows = Counter((r["doc_id"], r["item_id"]) for r in got.collect())
    assert rows[6, 2] == 2 and rows[None, 0] == 1 and rows[5, 2] == 1 and not any(d == 8 for d, _ in rows)
    assert rows[5, 0] == long.count(items[0][0])
    assert (40_000, 40_030) in [(r["first_word"], r["last_word"]) for r in got.where("doc_id = 5 and item_id = 2").collect()]


def set_of(text):
    words = re.split("[\x20\x09-\x0d]+", text.lower().strip(" \t\n\x0b\x0c\r"))
    if words == [""]:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_fingerprints(documents):
    random.seed(2)
    texts = [" ".join(f"w{random.randrange(900)}" for _ in range(n)) for n in (400, 400, 30, 7, 3)]
    texts += ["", None, texts[0], "é" * 999, texts[0].replace("w1", "W1", 50)]
    ids = [10, 20, 30, 40, 50, 60, 70, 80, 90, 100]
    rows = {r["doc_id"]: r for r in one_permutation.fingerprints(documents(texts, ids)).collect()}
    texts = [t or "" for t in texts]
    for k, (i, text) in enumerate(zip(ids, texts, strict=True)):
        after = texts[(k + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        row = rows[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row["near_edited"] == pytest.approx(likeness(set_of(text), set_of(edited)), abs=0.16)
        assert row["near_next"] == pytest.approx(likeness(set_of(text), set_of(after)), abs=0.16)
    assert rows[10]["fingerprint"] == rows[80]["fingerprint"] == rows[100]["fingerprint"] != rows[20]["fingerprint"]
    assert rows[60]["fingerprint"] == "" and len(rows[50]["fingerprint"]) == 256
    assert one_permutation.fingerprints(documents([])).collect() == []


def test_fingerprints_of_repeated_and_null_ids(documents):
    rows = one_permutation.fingerprints(documents(["abcdefgh", "zzzz", "bbbb", "x"], [1, 2, 2, None])).collect()
    got = Counter((r["doc_id"], r["edited_sha256"]) for r in rows)
    want = [(1, "abcdefbb"), (2, "zzza"), (2, "bbba"), (None, "x")]
    assert got == Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in want)


def plain_licenses(files):
    words = lambda t: re.findall(license_scan.WORD, t.lower())
    passages = []
    for path, text in files:
        if text is not None:
            if re.search(license_scan.LICENSE_FILE, path.rsplit("/", 1)[-1]):
                passages.append((path, words(text)))
            passages += [(path, words(s)) for s in re.split(license_scan.SENTENCE, text) if re.search(license_scan.NOTICE, s)]
    passages = [(p, w) for p, w in passages if w]
    df = Counter(w for _, p in passages for w in set(p))
    idf = defaultdict(lambda: math.log(1 + len(passages)) + 1, {w: math.log((1 + len(passages)) / (1 + n)) + 1 for w, n in df.items()})
    vector = lambda ws: {w: n * idf[w] for w, n in Counter(ws).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own = {}
    for path, ws in passages:
        v = vector(ws)
        for place, (name, text) in enumerate(license_scan.TEMPLATES):
            t = vector(words(text))
            score = sum(x * t.get(w, 0) for w, x in v.items()) / norm(v) / norm(t)
            if score >= license_scan.LEAST:
                grants = name != license_scan.RESERVED
                own[path] = max(own.get(path, (False, 0, 0, "")), (grants, round(score, 9), -place, name))
    return {path: best[1:] for path, best in own.items()}


def test_licenses_and_inheritance(spark):
    files = [("LICENSE", "Released under the MIT License."), ("a.txt", "Nothing here."), ("src/b.txt", "plain"),
             ("src/x/LICENSE.txt", "Licensed under the Apache License, Version 2.0."), ("src/x/y/c.txt", None),
             ("src/x/d.txt", "Words. This work is licensed under the GNU General Public License, version 3. More."),
             ("src/x/e.txt", "A licence to wander among many hills and rivers of far lands"), ("src/z/COPYING", ""),
             ("src/b.txt", "plain"), ("q/NOTICE", "Licensed under CC BY-NC 4.0.\nCopyright somebody")]
    df = spark.createDataFrame([(p, t, 1) for p, t in files] + [(None, "Released under the MIT License.", 2)],
                               "path string, text string, license int")
    rows = license_scan.scan(df).collect()
    assert len(rows) == len(files) + 1
    got = {r["path"]: r for r in rows}
    own = plain_licenses(files)
    assert {p: (r["own_license"], round(r["score"], 6)) for p, r in got.items() if r["own_license"]} == {
        p: (name, round(score, 6)) for p, (score, _, name) in own.items()}
    assert {p: (r["license"], r["origin"]) for p, r in got.items()} == {
        "LICENSE": ("MIT", "LICENSE"), "a.txt": ("MIT", "LICENSE"), "src/b.txt": ("MIT", "LICENSE"),
        "src/x/LICENSE.txt": ("Apache-2.0", "src/x/LICENSE.txt"), "src/x/y/c.txt": ("Apache-2.0", "src/x/LICENSE.txt"),
        "src/x/d.txt": ("GPL-3.0", "src/x/d.txt"), "src/x/e.txt": ("Apache-2.0", "src/x/LICENSE.txt"),
        "src/z/COPYING": ("MIT", "LICENSE"), "q/NOTICE": ("CC-BY-NC-4.0", "q/NOTICE"), None: (None, None)}
    assert license_scan.scan(df.limit(0)).collect() == []


@pytest.mark.parametrize("often", [1000, 2])
def test_licenses_with_a_common_word_at_two_corpus_sizes(spark, monkeypatch, often):
    monkeypatch.setattr(license_scan, "OFTEN", often)
    lines = ["Licensed under the Apache License, Version 2.0, see LICENSE.txt", "Released under the MIT License.",
             "This work is licensed under the GNU General Public License, version 3.", "Copyright of others, see elsewhere"]
    scores = []
    for times in (10, 1000):
        df = spark.range(times * len(lines)).selectExpr("concat('f', id) path", "array({})[id % {}] text".format(
            ", ".join(f"'{x}'" for x in lines), len(lines)))
        rows = license_scan.scan(df).where("path in ('f0', 'f3')").orderBy("path").collect()
        assert [r["license"] for r in rows] == ["Apache-2.0", None]
        scores.append(rows[0]["score"])
    passages = [re.findall(license_scan.WORD, x.lower()) for x in lines * 1000]
    df = Counter(w for p in passages for w in set(p))
    vector = lambda ws: {w: n * (math.log((1 + len(passages)) / (1 + df[w])) + 1) for w, n in Counter(ws).items()}
    a, b = vector(passages[0]), vector(re.findall(license_scan.WORD, license_scan.TEMPLATES[0][1].lower()))
    norms = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    assert scores[1] == pytest.approx(sum(x * b.get(w, 0) for w, x in a.items()) / norms)
    assert scores[0] == pytest.approx(scores[1], abs=0.02)


def test_a_grant_counts_before_reserved_rights(spark):
    head = "Copyright (c) 2020, Some Holder. All rights reserved.\n"
    files = [("a.c", head + license_scan._BSD_2, "BSD-2-Clause"), ("b.c", head + license_scan._BSD_2 + "\n" + license_scan._BSD_3, "BSD-3-Clause"),
             ("c.c", head + "int f();", license_scan.RESERVED), ("d.c", head + "Released under the MIT License.", "MIT")]
    rows = license_scan.scan(spark.createDataFrame(files, "path string, text string, want string")).collect()
    assert {r["path"]: r["own_license"] for r in rows} == {path: want for path, _, want in files}
    plain = plain_licenses([(path, text) for path, text, _ in files])
    assert {r["path"]: (r["own_license"], round(r["score"], 6)) for r in rows} == {p: (n, round(x, 6)) for p, (x, _, n) in plain.items()}


def test_licenses_of_spdx_headers_and_whole_texts(spark):
    texts = dict(license_scan.TEXTS[i] for i in range(len(license_scan.TEXTS)))
    files = [(f"a{i}/x.c", f"/* SPDX-License-Identifier:  {code} */ int f();\nmore", name)
             for i, (name, code) in enumerate(license_scan.IDENTIFIERS)]
    files += [("b/x.py", "# SPDX-License-Identifier: ISC", None), ("c/x.rs", "// SPDX-License-Identifier: (MIT OR Apache-2.0) by A", "MIT"),
              ("d/x.py", "# SPDX-License-Identifier: GPL-2.0+", "GPL-2.0"), ("e/x.py", "# spdx-license-identifier: MIT-0", None)]
    wrap = lambda text: re.sub(r"((?:\S+ ){9}\S+) ", r"\1\n", text)
    files += [(f"{name}/LICENSE", "Copyright (c) 2020 Some Holder\n\n" + wrap(text), name) for name, text in texts.items()]
    rows = license_scan.scan(spark.createDataFrame(files, "path string, text string, want string")).collect()
    assert {r["path"]: r["own_license"] for r in rows} == {path: want for path, _, want in files}
    whole = license_scan.own_licenses(spark.createDataFrame(files[-3:], "path string, text string, want string"))
    assert all(r["score"] > 0.8 for r in whole.collect())
