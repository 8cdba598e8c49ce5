"""Hosts, conversations and the pipeline."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from procurelens.llm import decontaminate, host_reputation, queries, quotation_chat, sp_viterbi

from .test_joins import plain_components
from .test_text import best_cut, plain_align


def test_hosts_rules_and_verdicts(spark):
    pages = [(1, "HTTP://Blog.Example.NET/en/x?y#z"), (2, "http://example.net/de"), (3, "http://a.example.com/de/1"),
             (4, None), (5, "no scheme"), (6, "http://x.org"), (7, "http://x.org/fr/"), (8, "http://badexample.net/en/"),
             (9, "http://good.test/a"), (10, "http://bad.test/a"), (11, "http://new.test/b?c"), (12, "a://b://c/d")]
    pages += [(100 + i, "http://good.test/") for i in range(30)] + [(200 + i, "http://bad.test/") for i in range(30)]
    frame = spark.createDataFrame([(i, u, "h") for i, u in pages], "page_id long, url string, host string")
    labels = [(100 + i, 1) for i in range(30)] + [(200 + i, 0) for i in range(30)] + [(1, None), (100, 1)]
    outcomes = spark.createDataFrame(labels, "page_id long, good int")
    got = {r["page_id"]: r for r in host_reputation.judge(frame, outcomes, queries.RULES).collect()}
    parts = {i: (r["host"], r["path"], r["rule"]) for i, r in got.items() if i < 100}
    assert parts == {
        1: ("blog.example.net", "/en/x", "example.net/en/"), 2: ("example.net", "/de", "net/"),
        3: ("a.example.com", "/de/1", "example.com/de/"), 4: ("", "", None), 5: ("", "", None), 6: ("x.org", "", None),
        7: ("x.org", "/fr/", "org/fr/"), 8: ("badexample.net", "/en/", "net/"), 9: ("good.test", "/a", None),
        10: ("bad.test", "/a", None), 11: ("new.test", "/b", None), 12: ("b:", "//c/d", None)}
    assert [got[i]["verdict"] for i in (1, 2, 3, 7, 9, 10)] == ["allow", "block", "block", "allow", "allow", "block"]
    assert got[10]["mean"] < got[11]["mean"] < got[9]["mean"]
    none = host_reputation.judge(frame, outcomes.limit(0), ()).collect()
    assert {r["verdict"] for r in none} == {"block"} and {round(r["mean"], 9) for r in none} == {0.5}
    assert host_reputation.judge(frame.limit(0), outcomes, queries.RULES).collect() == []


def test_rules_of_equal_length_and_names_of_hosts(spark):
    pages = spark.createDataFrame([(1, "http://a.org/a/x")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, good int")
    one, two = host_reputation.Rule("block", "a.org", "/"), host_reputation.Rule("allow", "org", "/a/")
    assert [host_reputation.judge(pages, none, rules).first()["rule"] for rules in ((one, two), (two, one))] == ["a.org/", "org/a/"]
    hosts = {"10.0.0.1": ("10.0.0.1", ""), "10.9.0.1:80": ("10.9.0.1", ""), "user@x.org": ("x.org", "org"), "[::1]:8080": ("[::1]", ""),
             "a.b.co.uk:": ("b.co.uk", "co.uk"), "a.b.co.il": ("b.co.il", "co.il"), "localhost": ("localhost", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain = host_reputation.domain_of(F.col("host"), (*host_reputation.TWO_LABEL_SUFFIXES, "co.il"))
    named = df.withColumn("domain", domain).withColumn("suffix", host_reputation.suffix_of(F.col("domain")))
    assert {r["host"]: (r["domain"], r["suffix"]) for r in named.collect()} == hosts


def plain_reputations(rows, suffixes=host_reputation.TWO_LABEL_SUFFIXES):
    """Posterior mean and bound by host, from (host, good) rows, step by step."""
    def domain(host):
        labels = host.split(".")
        return ".".join(labels[-3:] if ".".join(labels[-2:]) in suffixes else labels[-2:])

    def strength(groups):
        groups = [g for g in groups if g[0]]
        g, t, good = len(groups), sum(n for n, _ in groups), sum(s for _, s in groups)
        low, high = host_reputation.STRENGTHS
        if g <= 1 or t <= g:
            return high
        between = max((sum(s * s / n for n, s in groups) - good * good / t) / (g - 1), 0)
        within = max((good - sum(s * s / n for n, s in groups)) / (t - g), 1e-9)
        size = (t - sum(n * n for n, _ in groups) / t) / (g - 1)
        share = (between - within) / (between + (size - 1) * within)
        return min(max(1 / max(share, 1e-6) - 1, low), high)

    hosts, domains, suffix_sums = {}, {}, {}
    for host, good in rows:
        for table, key in ((hosts, host), (domains, domain(host)), (suffix_sums, domain(host).partition(".")[2])):
            n, s = table.get(key, (0, 0))
            table[key] = (n + (good is not None), s + (good or 0))
    prior = (sum(s for _, s in hosts.values()) + 1) / (sum(n for n, _ in hosts.values()) + 2)
    a, b, c = (strength(list(t.values())) for t in (suffix_sums, domains, hosts))
    by_suffix = {k: (s + a * prior) / (n + a) for k, (n, s) in suffix_sums.items()}
    by_domain = {k: (s + b * by_suffix[k.partition(".")[2]]) / (n + b) for k, (n, s) in domains.items()}
    out = {}
    for host, (n, s) in hosts.items():
        mean = (s + c * by_domain[domain(host)]) / (n + c)
        out[host] = (n, mean, mean - host_reputation.BOUND * (mean * (1 - mean) / (n + c + 1)) ** 0.5)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_reputations_equal_plain_shrinkage(spark, seed):
    rng = random.Random(seed)
    names = [f"{h}.{d}" for d in ("a.com", "b.com", "c.co.uk", "d.net") for h in ("www", "x", "y")]
    odds = {n: rng.random() for n in names}
    rows = [(n, rng.choice([None, int(rng.random() < odds[n])])) for n in rng.choices(names, range(1, 13), k=400)]
    got = host_reputation.reputations(spark.createDataFrame(rows, "host string, good int")).collect()
    want = plain_reputations(rows)
    assert {r["host"] for r in got} == set(want)
    for r in got:
        assert (r["labelled"], r["mean"], r["lower"]) == pytest.approx(want[r["host"]])
    assert len({lower >= host_reputation.LEAST for _, _, lower in want.values()}) == 2  # some are blocked, some not


def test_quotes_link_and_order(spark):
    rows = [(1, 0, "user", "First point.\n\nSecond point here."), (1, 1, "user", "Other thread"),
            (1, 2, "assistant", "On Monday, A wrote:\n> second   POINT here.\n\nMy answer"),
            (1, 3, "user", ">> Second point here.\n> My answer\nThanks"), (1, 4, "user", "> nobody said this\nhm"),
            (1, 5, None, None), (2, 1, "user", "> Other thread\nnot there"), (None, 0, "user", "lost"),
            (1, 5, None, None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, position int")
    got = quotation_chat.reply_ordered(df).collect()
    assert len(got) == len(rows)
    first = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["position"])
    assert [(r["turn"], r["reply_to"], r["thread"]) for r in first] == [
        (0, None, 0), (2, 0, 0), (3, 2, 0), (1, None, 1), (4, None, 4), (5, None, 5), (5, None, 5)]
    assert [r["text"] for r in first[:3]] == ["First point.\n\nSecond point here.", "My answer", "Thanks"]
    assert [r["quote_levels"] for r in first[:5]] == [0, 1, 2, 0, 1] and [r["position"] for r in first] == list(range(7))
    assert first[1]["formatted"] == "<|im_start|>assistant\nMy answer<|im_end|>\n"
    assert [(r["reply_to"], r["position"]) for r in got if r["conv_id"] == 2] == [(None, 0)]
    assert quotation_chat.reply_ordered(df.limit(0)).collect() == []


@pytest.mark.parametrize("text, own", [
    ("On Monday, A wrote:\n\n> q\nmine", "mine"), ("On Mon, 3 May 2021 at 10:00, Alice Long Name\n<alice@x.org> wrote:\n \n> q\nmine", "mine"),
    ("Intro.\nAm Montag schrieb B:\n> q\nmine", "Intro.\nmine"), ("On " + "x " * 400 + "wrote:\n> q\nmine", "mine"),
    ("He wrote:\nnot quoted", "He wrote:\nnot quoted"), ("On top of it,\n\nshe writes:\n> q\nend", "On top of it,\n\nend"),
    ("> q\nOn Monday, A wrote:\n>> deep\nend", "end")])
def test_announcements_of_quotes_go(text, own):
    assert quotation_chat.own_words(quotation_chat.levels(text)) == own


def test_latest_earlier_message_across_steps(spark, monkeypatch):
    monkeypatch.setattr(quotation_chat, "STEP", 4)
    rows = [(1, t, "user", "same words" if t in (1, 6) else f"> same words\nreply {t}" if t in (0, 5, 7, 30) else f"t{t}")
            for t in range(31)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r["reply_to"] for r in quotation_chat.reply_ordered(df).collect() if r["turn"] in (0, 5, 7, 30)}
    assert got == {0: None, 5: 1, 7: 6, 30: 6}


def test_long_reply_chains_have_one_thread(spark):
    rows = [(1, 0, "user", "m0")] + [(1, t, "user", f"> m{t - 1}\nm{t}") for t in range(1, 20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {r["thread"] for r in quotation_chat.reply_ordered(df).collect()} == {0}


def test_every_row_of_the_small_tables(spark, small):
    for query, table, key in ((queries.op10_quotation_chat, "conversations", "conv_id"), (queries.op7_host_reputation, "pages", "page_id"),
                              (queries.op1_license_scan, "documents", "doc_id")):
        want = sorted(r[0] for r in spark.read.parquet(f"{small}/{table}.parquet").select(key).collect())
        assert sorted(r[key] for r in query(spark, small).collect()) == want


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    start, steps = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, small).cache()
        steps[name] = (before, docs)
        assert name == "piece_ids" or docs.columns == before.columns
    texts = {r["doc_id"]: r["text"] for r in start.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in steps["quality"][1].collect()}
    assert all((i in kept) == (labels[i] == 1) for i in set(texts) & set(labels))
    benchmark = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    before, after = steps["benchmark_leaks"]
    left = {r["doc_id"] for r in after.collect()}
    assert not any(item in r["text"] for r in after.collect() for item in benchmark)
    assert all(any(set(item.split()) & set(r["text"].split()) for item in benchmark)
               for r in before.collect() if r["doc_id"] not in left)
    rows = docs.collect()
    assert {r["doc_id"] for r in rows} == left and all(r["round_trip"] for r in rows)
    again = corpus_pipeline.run(spark, small).select("doc_id", "ids_crc32").collect()
    assert sorted(map(tuple, again)) == sorted((r["doc_id"], r["ids_crc32"]) for r in rows)


def plain_cut(texts, size=35):
    words = {i: t.split() for i, t in texts.items()}
    seen = Counter(tuple(w[a:a + size]) for w in words.values() for a in range(len(w) - size + 1))
    out = {}
    for i, w in words.items():
        gone = {b for a in range(len(w) - size + 1) if seen[tuple(w[a:a + size])] > 1 for b in range(a, a + size)}
        if len(gone) < len(w) or not w:
            out[i] = " ".join(x for b, x in enumerate(w) if b not in gone) if gone else texts[i]
    return out


def plain_clean(texts, items):
    number = {w: i for i, w in enumerate(sorted({w for t in [*texts.values(), *items] for w in t.split()}))}
    coded = lambda t: np.array([number[w] for w in t.split()], int)
    return {i: t for i, t in texts.items()
            if not any(plain_align(coded(item), coded(t)) >= decontaminate.LIKENESS * len(item.split()) for item in items)}


def test_every_stage_and_run_equal_plain_versions(spark, tmp_path):
    rng = random.Random(8)
    noise = lambda n, kind="w": [f"{kind}{rng.randrange(300)}" for _ in range(n)]
    changed = lambda words, step: [noise(1)[0] if k % step == 0 else w for k, w in enumerate(words, 1)]
    items, passage, base = [noise(24, "b") for _ in range(4)], noise(45, "p"), [noise(90) for _ in range(4)]
    good = [noise(rng.randrange(40, 90)) for _ in range(12)] + base + [changed(b, 60) for b in base] + [changed(b, 9) for b in base]
    good += [noise(10 + k) + passage[k:40 + k] + noise(20) for k in range(4)] + [passage[:40], passage[5:]]
    good += [noise(20) + changed(items[k], step) + noise(20) for k, step in enumerate((4, 5, 6, 7))]
    good += [noise(20) + items[0] + noise(20), noise(20) + items[1][:9] + noise(20)]
    bad = [noise(60, "zzz!!") for _ in range(20)]
    texts = {i: " ".join(t) for i, t in enumerate(rng.sample(good + bad, len(good + bad)))}
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int("!!" not in t)) for i, t in texts.items()], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [" ".join(item) for item in items]
    spark.createDataFrame([*enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = sp_viterbi.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    plain = {"quality": lambda t: {i: x for i, x in t.items() if "!!" not in x},
             "near_duplicates": lambda t: {i: t[i] for i, _, first in plain_components([*t.items()]) if i == first},
             "repeated_passages": plain_cut, "benchmark_leaks": lambda t: plain_clean(t, items),
             "piece_ids": lambda t: {i: best_cut(pieces, x) for i, x in t.items()}}
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), [len(texts)]
    for name, stage in corpus_pipeline.STAGES:
        texts = plain[name](texts)
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert {r["doc_id"]: r["ids" if name == "piece_ids" else "text"] for r in docs.collect()} == texts, name
        left.append(len(texts))
    assert len(set(left)) == len(left) - 1  # every stage but the last drops some
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == texts


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, small, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, others int, found string"
    rows = [(1, None, None, None, None, None, None, None), (None, "x y", "en", "s", 3, 0.1, 1, "f"),
            (2, "w " * 5000, "en", "s", 3, 0.1, 1, "f"), (2, "w " * 5000, "en", "s", 3, 0.1, 1, "f"), (3, "", "en", "s", 0, 0.1, 1, "f")]
    for part in (rows, []):
        out = stage(spark, spark.createDataFrame(part, schema), small)
        out.collect()
