"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words); only documents carry labels. Every passage is
encoded from its own characters and words, a gated attention learns from the document labels which
passages tell, and the attention-weighted mean passage is scored:

    z = tanh(E x + e)          a = softmax over passages of w . (tanh(V z) * sigmoid(U z))
    score = sigmoid(c . sum(a z) + d)

Passage measurements and scores are computed in the tasks that read the texts. Training uses a sample of
at most ``TRAIN_PER_CLASS`` labelled documents of each class, taken by hash of the id.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .wordhash import EXACT, U, mix, slices, split_words

PASSAGE = 48
TRAIN_PER_CLASS = 1000
HIDDEN, GATE, STEPS, RATE, DECAY, SEED = 16, 8, 250, 0.02, 1e-3, 7

_BYTES = np.arange(256)
_CLASSES = [
    (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122), (_BYTES >= 48) & (_BYTES <= 57),
    _BYTES >= 128, np.isin(_BYTES, [ord(c) for c in ".,;:?'\"-()"]), _BYTES == ord("!"), _BYTES == ord("|"),
    np.isin(_BYTES, [ord(c) for c in "#$%&*+/<=>@\\^_`{}~[]"]), _BYTES == 10]
FEATURES = len(_CLASSES) + 11


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Measurements of every passage, and the first passage of each text (a wordless text has none)."""
    words = split_words(texts, EXACT)
    per_text = np.diff(words.offsets)
    counts = -(-per_text // PASSAGE)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)
    first = np.repeat(words.offsets[:-1], counts) + within * PASSAGE
    last = np.minimum(first + PASSAGE, np.repeat(words.offsets[1:], counts))
    if not len(first):
        return np.zeros((0, FEATURES), np.float32), bounds
    size = (last - first).astype(float)
    begin, end = words.starts[first], words.ends[last - 1]
    span = (end - begin).astype(float)

    def over_bytes(flags):
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[end] - sums[begin]) / span

    def over_words(values):
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
        return (sums[last] - sums[first]) / size

    data, hashes = words.data, words.hashes()
    length = (words.ends - words.starts).astype(float)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    skip = np.zeros(len(hashes), bool)
    skip[2:] = hashes[2:] == hashes[:-2]
    twin = np.zeros(len(data), bool)
    twin[1:] = data[1:] == data[:-1]
    tail = data[words.ends - 1]
    passage = np.repeat(np.arange(len(first)), last - first)
    order = np.sort((passage.astype(U) << U(40)) | (mix(hashes) >> U(24)))
    fresh = np.concatenate([[True], order[1:] != order[:-1]])
    distinct = np.bincount((order[fresh] >> U(40)).astype(np.int64), minlength=len(first)) / size
    mean = over_words(length)
    columns = [over_bytes(c[data]) for c in _CLASSES] + [
        np.log1p(mean), np.sqrt(np.maximum(over_words(length ** 2) - mean ** 2, 0)) / (1 + mean),
        over_words(again), over_words(skip), distinct, over_bytes(twin),
        over_words(_CLASSES[0][data[words.starts]]), over_words(_CLASSES[4][tail]),
        over_words(_CLASSES[7][tail] | _CLASSES[5][tail] | _CLASSES[6][tail]),
        over_words(length <= 3), np.log(size)]
    return np.stack(columns, axis=1).astype(np.float32), bounds


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """``x``: scaled passages of bags that all have some."""
        p = self.weights
        z = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(z @ p["V"]), _sigmoid(z @ p["U"])
        logit = (t * s) @ p["w"]
        counts = np.diff(bounds)
        top = np.repeat(np.maximum.reduceat(logit, bounds[:-1]), counts)
        a = np.exp(logit - top)
        a /= np.repeat(np.add.reduceat(a, bounds[:-1]), counts)
        bag = np.add.reduceat(a[:, None] * z, bounds[:-1])
        return {"z": z, "t": t, "s": s, "a": a, "bag": bag, "y": _sigmoid(bag @ p["c"] + p["d"])}

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Score of each text; one without words has 0."""
        x, bounds = passages(texts)
        out = np.zeros(len(bounds) - 1)
        some = np.diff(bounds) > 0
        if some.any():
            own = np.concatenate([bounds[:-1][some], bounds[-1:]])
            out[some] = self.forward((x - self.mean) / self.scale, own)["y"]
        return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Model:
    """Gradient descent (Adam) on the class-balanced log loss of whole bags."""
    rng = np.random.default_rng(SEED)
    shapes = {"E": (x.shape[1], HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE),
              "w": (GATE,), "c": (HIDDEN,), "d": ()}
    weights = {k: rng.normal(0, 0.5 / np.sqrt(max(s[0], 1)) if len(s) > 1 else 0.1, s) if s else np.zeros(())
               for k, s in shapes.items()}
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3, weights)
    x = (x - model.mean) / model.scale
    share = np.where(labels > 0, 0.5 / max((labels > 0).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    counts = np.diff(bounds)
    moments = {k: (np.zeros(s), np.zeros(s)) for k, s in shapes.items()}
    for step in range(1, STEPS + 1):
        f, p = model.forward(x, bounds), model.weights
        back = share * (f["y"] - labels)
        bag = np.repeat(back[:, None] * p["c"], counts, axis=0)
        to_a = (bag * f["z"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(f["a"] * to_a, bounds[:-1]), counts)
        logit = f["a"] * (to_a - mean)
        t = logit[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2)
        s = logit[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
        z = (f["a"][:, None] * bag + t @ p["V"].T + s @ p["U"].T) * (1 - f["z"] ** 2)
        slopes = {"E": x.T @ z, "e": z.sum(axis=0), "V": f["z"].T @ t, "U": f["z"].T @ s,
                  "w": (f["t"] * f["s"]).T @ logit, "c": f["bag"].T @ back, "d": back.sum()}
        for k, slope in slopes.items():
            slope = slope + DECAY * p[k]
            m, v = moments[k]
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
            moments[k] = m, v
            p[k] = p[k] - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def _bags(batches):
    for part in slices(batches):
        x, bounds = passages(part.column("text"))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("quality"),
             pa.array([x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
            names=["doc_id", "quality", "x"])


def train(documents: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> Model:
    """Learn from ``labels(doc_id, quality)`` (several labels of an id: the lowest counts) and the
    texts of those documents. Without labels of both classes, every text scores one half.
    """
    known = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min(F.col("quality").cast("int")).alias("quality")))
    pick = [F.xxhash64("doc_id"), "doc_id"]
    sample = known.where("quality > 0").orderBy(*pick).limit(per_class).unionAll(
        known.where("quality = 0").orderBy(*pick).limit(per_class))  # at most 2 * per_class rows: bounded
    rows = (documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .mapInArrow(_bags, "doc_id long, quality int, x binary").where("length(x) > 0").collect())
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["x"])))
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    y = np.array([r["quality"] > 0 for r in rows], float)
    if not 0 < y.sum() < len(y):
        rest = {"E": (FEATURES, 1), "e": (1,), "V": (1, 1), "U": (1, 1), "w": (1,), "c": (1,), "d": ()}
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {k: np.zeros(s) for k, s in rest.items()})
    return fit(np.concatenate(bags).astype(float), np.concatenate([[0], np.cumsum([len(b) for b in bags])]), y)


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Add the score (0 to 1) to every row of ``documents(text, ...)``.

    Only the text decides; equal texts score alike. A null or wordless text scores 0. Rows
    are not dropped, merged or reordered; a column of that name is replaced.
    """
    names = [f.name for f in documents.schema.fields if f.name != name]

    def run(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(model.scores(part.column("text")), pa.float64())],
                names=[*names, name])

    rest = documents.select([f"`{n}`" for n in names])
    return rest.mapInArrow(run, StructType([*rest.schema.fields, StructField(name, DoubleType())]))
