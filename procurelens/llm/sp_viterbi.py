"""SentencePiece encoding by streaming Viterbi, and decoding.

The pieces of a SentencePiece model and their scores are taken as a unigram model: the encoding of a text is
the cut into pieces with the highest sum of scores (ties: the longer last piece). Spaces are written as the piece
mark, one is put before the text, and characters that no piece has become byte pieces, so decoding gives
every text back exactly.

The search runs along the text and keeps only positions since the last committed boundary; the next piece can
start at any of the last ``longest`` of them. Whenever the backpointer paths of all of these meet in
one boundary, the ids before it are committed and forgotten. Between two characters that no piece has side by side,
all paths meet at once. A task remembers the ids of such stretches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .parts import PartMemory
from .wordhash import give_back, mix, slices

MARK = "▁"
#: Stands for a piece mark that the text itself has; no valid text holds it.
LITERAL = "\udc81"
#: Before a word that follows a line feed, so has no space before it; texts that hold it are searched whole.
JOIN = "\x1f"
#: Cost of a byte piece below the worst score of a real piece.
BYTE_COST = 10.0
#: Text encoded at a time: ids, their places and the decoded bytes of a slice take about 40 times as much.
SLICE_BYTES = 512 << 10
#: Parts a worker remembers, about 150 bytes each.
PARTS = 200_000


class Pieces:
    """A vocabulary: pieces with scores, byte pieces, and what each id decodes to."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces = {p: (i, s) for i, (p, s, k) in enumerate(zip(pieces, scores, kinds, strict=True)) if k == "piece"}
        self.bytes = [i for i, k in enumerate(kinds) if k == "byte"]
        if len(self.bytes) != 256:
            raise ValueError("the model needs all 256 byte pieces")
        self.longest = max(map(len, self.pieces), default=1)
        self.pairs = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.byte_score = min((s for _, s in self.pieces.values()), default=0.0) - BYTE_COST
        rank = {i: b for b, i in enumerate(self.bytes)}
        self.raw = [bytes([rank[i]]) if k == "byte" else p.replace(MARK, " ").encode() if k == "piece" else b""
                    for i, (p, k) in enumerate(zip(pieces, kinds, strict=True))]

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kinds = ["byte" if model.is_byte(i) else "none" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
                 else "piece" for i in ids]
        return cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], kinds)

    def _bytes(self, char: str) -> list[int]:
        return [self.bytes[b] for b in (MARK if char == LITERAL else char).encode()]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of ``text`` (with piece marks for spaces), committed stretch by stretch."""
        pieces, pairs, longest, count = self.pieces, self.pairs, self.longest, len(text)
        base = 0  # the last committed boundary
        best, back = [0.0], [0]  # for base and each place after it

        def ids(until: int) -> list[int]:
            out: list[list[int]] = []
            while until > base:
                start = back[until - base]
                part = text[start:until]
                out.append([pieces[part][0]] if part in pieces else self._bytes(part))
                until = start
            return [i for part in reversed(out) for i in part]

        for end in range(1, count + 1):
            top, origin = -np.inf, -1
            for start in range(max(base, end - longest), end):
                known = pieces.get(text[start:end])
                if known is not None and best[start - base] + known[1] > top:
                    top, origin = best[start - base] + known[1], start
            char = text[end - 1]
            if char not in pieces:
                score = best[end - 1 - base] + self.byte_score * len(self._bytes(char))
                if score > top:
                    top, origin = score, end - 1
            best.append(top)
            back.append(origin)
            meet = base
            if end == count or text[end - 1:end + 1] not in pairs:
                meet = end
            elif (end - base) % (2 * longest) == 0:
                alive = set(range(end - longest + 1, end + 1))
                while len(alive) > 1:
                    last = max(alive)
                    alive.remove(last)
                    alive.add(back[last - base])
                meet = alive.pop()
            if meet > base:
                yield ids(meet)
                best, back, base = best[meet - base:], back[meet - base:], meet

    def encode(self, text: str) -> list[int]:
        text = text.replace(MARK, LITERAL).replace(" ", MARK)
        return [i for part in self.stream(MARK + text) for i in part] if text else []


class Search:
    """Viterbi over many short stretches at once, position by position; long ones go through ``Pieces.stream``.

    Substrings are looked up by a 64-bit hash in an open table that is checked, when built, to hold every piece apart.
    """

    WIDTH, SLOT_BITS, AT_ONCE = 32, 20, 1 << 13

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        names = [p for p in pieces.pieces if len(p) <= self.WIDTH]
        self.ids = np.array([pieces.pieces[p][0] for p in names] + [0], np.int64)
        self.scores = np.array([pieces.pieces[p][1] for p in names] + [-np.inf])
        codes = [np.array([ord(c) for c in p], np.uint64) for p in names]
        for seed in range(1, 1000):
            self.base = mix(np.array([seed], np.uint64))[0] | np.uint64(1)
            self.powers = np.multiply.accumulate(np.full(self.WIDTH + 1, self.base)) * pow(int(self.base), -1, 1 << 64)
            keys = np.zeros(len(names) + 1, np.uint64)
            for i, c in enumerate(codes):
                keys[i] = ((c + np.uint64(1)) * self.powers[:len(c)][::-1]).sum()
            keys = mix(keys)
            if len(np.unique(keys[:-1])) == len(names):
                break
        self.keys, left = keys, np.arange(len(names))
        self.tables = []
        while len(left):  # what shares a slot goes to the next table
            slot = self._slots(keys[left], len(self.tables))
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << self.SLOT_BITS, len(names), np.int32)
            table[slot[first]] = left[first]
            self.tables.append(table)
            left = np.delete(left, first)
        self.known = set(pieces.pieces)

    def _slots(self, keys: np.ndarray, table: int) -> np.ndarray:
        return (keys << np.uint64(5 * table) >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        out = self.tables[0][self._slots(keys, 0)]
        out = np.where(self.keys[out] == keys, out, len(self.ids) - 1)
        for i, table in enumerate(self.tables[1:], 1):
            other = table[self._slots(keys, i)]
            out = np.where(self.keys[other] == keys, other, out)
        return out

    def __call__(self, parts: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(parts)
        short = [i for i, p in enumerate(parts) if 0 < len(p) <= self.WIDTH and "\0" not in p and self.known.issuperset(p)]
        done = set(short)
        for i, p in enumerate(parts):
            if i not in done and p:
                out[i] = [x for part in self.pieces.stream(p) for x in part]
        for first in range(0, len(short), self.AT_ONCE):
            chosen = sorted(short[first:first + self.AT_ONCE], key=lambda i: -len(parts[i]))
            for i, ids in zip(chosen, self._many([parts[i] for i in chosen]), strict=True):
                out[i] = ids
        return out

    def _many(self, parts: list[str]) -> list[list[int]]:
        """``parts``: longest first, every character a piece."""
        sizes = np.array([len(p) for p in parts])
        count, width = len(parts), int(sizes[0])
        codes = np.array(parts, f"<U{width}").view("<u4").reshape(count, width).T.astype(np.uint64)
        sums = np.zeros((width + 1, count), np.uint64)
        best = np.full((width + 1, count), -np.inf)
        best[0] = 0
        size, piece = np.zeros((width + 1, count), np.int8), np.zeros((width + 1, count), np.int32)
        for end in range(1, width + 1):
            live = int(np.searchsorted(-sizes, -end, "right"))
            sums[end, :live] = sums[end - 1, :live] * self.base + codes[end - 1, :live] + np.uint64(1)
            for length in range(min(end, self.pieces.longest), 0, -1):
                start = end - length
                found = self._find(mix(sums[end, :live] - sums[start, :live] * (self.powers[length])))
                score = best[start, :live] + self.scores[found]
                better = score > best[end, :live]
                best[end, :live][better] = score[better]
                size[end, :live][better] = length
                piece[end, :live][better] = found[better]
        at, row = sizes.copy(), np.arange(count)
        steps = []
        while (at > 0).any():
            steps.append(np.where(at > 0, self.ids[piece[at, row]], -1))
            at = at - size[at, row]
        table = np.stack(steps[::-1], axis=1)
        return [[i for i in ids if i >= 0] for ids in table.tolist()]


class Encoder:
    """Encode batches of texts: stretches between sure boundaries are looked up, new ones searched."""

    TAIL = r"^(?s:(?P<stem>.*?)(?P<tail>[,.!?|%#$&*:;]*))$"

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.memory = PartMemory(Search(pieces), PARTS)
        self.pairs = pa.array(sorted(p for p in pieces.pairs if p.isprintable()))
        lengths = [len(r) for r in pieces.raw]
        self.raw = np.frombuffer(b"".join(pieces.raw), np.uint8)
        self.raw_size = np.array(lengths, np.int64)
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        # words are stretches of their own if a mark stands only at the start of a piece or in a run of marks,
        # and lines are if no piece has a line feed
        self.by_word = all((p.strip(MARK) == "" or MARK not in p[1:]) and "\n" not in p for p in pieces.pieces)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids up to each text's end."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, f"^$|^ | $|  |{MARK}|{JOIN}").to_numpy(zero_copy_only=False) | (not self.by_word)
        common = texts.filter(pa.array(~odd))
        ids, ends = self._words(common)
        if not odd.any():
            return ids, ends
        parts = [ids[a:b] for a, b in zip(np.concatenate([[0], ends])[:-1].astype(int).tolist(), ends.tolist(), strict=True)]
        apart = iter(parts)
        out = [np.array(self.pieces.encode(t), np.uint32) if o else next(apart)
               for t, o in zip(texts.to_pylist(), odd.tolist(), strict=True)]
        return np.concatenate(out), np.cumsum([len(o) for o in out])

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For texts of words with single spaces between them."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.memory.start_batch()
        split = pc.split_pattern(pc.replace_substring(texts, "\n", f" \n {JOIN}"), " ")
        words = split.flatten().dictionary_encode()
        names = words.dictionary
        inner = pc.or_(pc.starts_with(names, JOIN), pc.equal(names, "\n"))
        marked = pc.if_else(inner, pc.replace_substring(names, JOIN, ""), pc.binary_join_element_wise(MARK, names, ""))
        cut = pc.extract_regex(marked, self.TAIL)
        stem, tail = cut.field("stem"), cut.field("tail")
        border = pc.binary_join_element_wise(pc.utf8_slice_codeunits(stem, -1), pc.utf8_slice_codeunits(tail, 0, 1), "")
        apart = pc.invert(pc.is_in(border, value_set=self.pairs))
        stem, tail = pc.if_else(apart, stem, marked), pc.if_else(apart, tail, "")
        parts = pa.concat_arrays([stem, tail]).dictionary_encode()
        place = self.memory.places(parts.dictionary)[parts.indices.to_numpy()].reshape(2, -1)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        ids, done = self.memory.gather(place[:, words.indices.to_numpy()].T.ravel())
        return ids, np.concatenate([[0], done])[2 * bounds[1:]]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of ids in a row; ``ends``: the number of ids up to each text's end."""
        size = self.raw_size[ids]
        done = np.cumsum(size)
        at = np.repeat(self.raw_first[ids] - (done - size), size)
        at += np.arange(len(at))
        data = self.raw[at]
        until = np.concatenate([[0], done])[np.concatenate([[0], ends])]
        keep = np.ones(len(data), bool)
        keep[until[:-1][np.diff(until) > 0]] = False  # the space put before each text
        offsets = until - np.concatenate([[0], np.cumsum(np.diff(until) > 0)])
        return pa.LargeStringArray.from_buffers(
            len(ends), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[keep])))


_encoders: dict[int, Encoder] = {}


def _encoder(pieces: Pieces) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    key = zlib.crc32(b"\0".join(pieces.raw))
    if key not in _encoders:
        _encoders[key] = Encoder(pieces)
    return _encoders[key]


def _sums(ids: np.ndarray, ends: np.ndarray) -> list[int]:
    raw, last = memoryview(ids.astype("<u4").tobytes()), 0
    out = []
    for end in ends.tolist():
        out.append(zlib.crc32(raw[4 * last:4 * end]))
        last = end
    return out


def encode_pieces(documents: DataFrame, pieces: Pieces) -> DataFrame:
    """Replace ``text`` of ``documents(text, ...)`` by ``ids`` (array of int), ``n_tokens``, ``ids_crc32`` (over
    little-endian 32-bit ids) and ``round_trip`` (the decoded ids are the text).

    A null or empty text has no ids and decodes to the empty text. Other columns stay; columns that
    have the names of new ones are replaced. Rows are neither merged nor dropped.
    """
    sent = documents.sparkSession.sparkContext.broadcast(pieces)  # the model's pieces, about 2 MB
    new = ["ids", "n_tokens", "ids_crc32", "round_trip"]
    names = [f.name for f in documents.schema.fields if f.name not in [*new, "text"]]

    def run(batches):
        encoder = _encoder(sent.value)
        for part in slices(batches, limit=SLICE_BYTES):
            texts = pc.fill_null(part.column("text"), "")
            ids, ends = encoder.encode(texts)
            back = encoder.decode(ids, ends)
            offsets = np.concatenate([[0], ends])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in names],
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))),
                 pa.array(np.diff(offsets), pa.int32()), pa.array(_sums(ids, ends), pa.int64()),
                 pc.equal(back, texts.cast(pa.large_string()))], names=[*names, *new])
        encoder.memory.clear()  # the worker goes on to other work
        give_back()

    kinds = (ArrayType(IntegerType()), IntegerType(), LongType(), BooleanType())
    rest = documents.select([*[f"`{n}`" for n in names], "text"])
    schema = [f for f in rest.schema.fields if f.name != "text"]
    return rest.mapInArrow(run, StructType([*schema, *map(StructField, new, kinds)]))


def decode_pieces(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """Replace ``ids`` of ``encoded(ids, ...)`` by ``text``; null ids give the empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(pieces)
    names = [f.name for f in encoded.schema.fields if f.name not in ("ids", "text")]

    def run(batches):
        encoder = _encoder(sent.value)
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), pa.scalar([], batch.column("ids").type))
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            ids = lists.flatten().to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], encoder.decode(ids, ends).cast(pa.string())], names=[*names, "text"])

    rest = encoded.select([*[f"`{n}`" for n in names], "ids"])
    schema = [f for f in rest.schema.fields if f.name != "ids"]
    return rest.mapInArrow(run, StructType([*schema, StructField("text", StringType())]))


