"""How much a worker takes to encode pieces, whatever it is given at once."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from procurelens.llm import sp_viterbi


def small_pieces():
    letters = ["▁", *"abcdefghij"]
    names = [*letters, "ab", "cde", "▁a", *[f"<0x{b:02X}>" for b in range(256)]]
    kinds = ["piece"] * (len(letters) + 3) + ["byte"] * 256
    return sp_viterbi.Pieces(names, [-float(1 + i % 7) for i in range(len(names))], kinds)


def words(count):
    return ["".join("abcdefghij"[int(d)] for d in f"{i * 7919 % 10**9:09d}") for i in range(count)]


def test_many_new_parts_are_searched_in_small_groups():
    pieces, parts = small_pieces(), words(40_000)
    search = sp_viterbi.Search(pieces)
    tracemalloc.start()
    try:
        found = search(parts)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak - held < 10 << 20
    assert all(found[i] == [x for part in pieces.stream(parts[i]) for x in part] for i in range(0, len(parts), 997))


def test_remembered_parts_stay_few():
    encoder = sp_viterbi.Encoder(small_pieces())
    texts = words(260_000)
    most = 0
    for first in range(0, len(texts), 10_000):
        some = texts[first:first + 10_000]
        ids, ends = encoder.encode(pa.array([" ".join(some)]))
        assert encoder.decode(ids, ends).to_pylist() == [" ".join(some)]
        most = max(most, len(encoder.memory.place))
    assert most <= sp_viterbi.PARTS + 10_001
