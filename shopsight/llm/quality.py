"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of `PASSAGE_WORDS` words. Each passage is encoded
as a row of surface statistics (shares of byte classes, word shapes, repetition);
a small network turns it into a hidden vector, gated attention (tanh and sigmoid
branches) weighs the passages of a bag, and the weighted vector is scored. Only
document labels are given; the attention weights are learned from them.

Training takes a sample of about `max_bags` labelled documents, drawn by a hash of the
identifier alone: long documents are as likely as short ones, and every passage of a
drawn document counts. The encoded sample is stored. Up to `driver_passages` passages
it is fitted on the driver; a larger one stays where it is, and every epoch sums the
gradients on Spark, so what the driver holds is bounded. Encoding and scoring run on
Spark over all passages of every whole text, without a shuffle.

Defined cases: a null, empty or blank text is a bag of one zero row and gets a
score like any other; without labels, or with one class only, every score is the
smoothed share of positive labels; repeated label rows of a document count once,
positive if half of them or more are; null labels are ignored; repeated documents
get equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import map_arrow, utf8, word_starts
from shopsight.llm.fingerprint import slices
from shopsight.sources.scratch import materialize

PASSAGE_WORDS = 64
MAX_BAGS = 2048
DRIVER_PASSAGES = 1 << 17
_CHUNK = 1 << 14  # passages per step of a distributed sum; a longer bag is a step of its own
HIDDEN, ATTENTION, EPOCHS, RATE, DECAY = 24, 12, 120, 0.03, 1e-4

_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b".", b",", b"!", b"?", b"'\"",
    b"()[]{}<>", b"#$%&*@^~|=+_/\\`", b"-:;", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100)),
]
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _members in enumerate(_CLASSES):
    _CLASS[list(_members)] = _i
_LOUD = np.zeros(len(_CLASSES) + 1, bool)
_LOUD[[6, 7, 10]] = True
N_CLASSES = len(_CLASSES) + 1
N_FEATURES = N_CLASSES + 8
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def encode(text: bytes | None) -> np.ndarray:
    """One row of features per passage."""
    line = b" ".join(text.split()) if text else b""
    if not line:
        return np.zeros((1, N_FEATURES), np.float32)
    codes = _CLASS[np.frombuffer(line, np.uint8)]
    starts = word_starts(line)
    begin, end = starts[:-1], starts[1:] - 1
    n_words = len(begin)
    of_word = np.arange(n_words) // PASSAGE_WORDS
    n = int(of_word[-1]) + 1
    bounds = np.append(begin[::PASSAGE_WORDS], len(line))
    of_byte = np.repeat(np.arange(n), np.diff(bounds))
    shares = np.bincount(of_byte * N_CLASSES + codes, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    amount = np.bincount(of_word, minlength=n)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(of_word, weights=flags, minlength=n) / amount

    length = end - begin
    prints = slices(line, begin, end)
    _, different = np.unique(prints + of_word.astype(np.uint64) * _SPREAD, return_index=True)
    repeated = np.zeros(n_words)
    if n_words > 3:
        triples = prints[:-2] + prints[1:-1] * np.uint64(3) + prints[2:] * np.uint64(5)
        order = np.argsort(triples)
        equal = np.diff(triples[order]) == 0
        repeated[:-2][order] = np.append(equal, False) | np.append(False, equal)
    letters = np.cumsum(np.append(0, codes == 1))
    words = np.stack(
        [
            share(length) / 8,
            share(np.minimum(length, 40) ** 2) / 64,
            share(length <= 2),
            np.bincount(of_word[different], minlength=n) / amount,
            share(repeated),
            share((letters[end] - letters[begin]) * 2 > length),
            share(_LOUD[codes[end - 1]]),
            np.log1p(amount) / 4,
        ],
        axis=1,
    )
    return np.concatenate([shares / np.diff(bounds)[:, None], words], axis=1).astype(np.float32)


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Bags of rows of x: `first` row and size of each."""
    h = np.tanh(x @ w["W"] + w["b"])
    t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    energy = (t * s) @ w["a"]
    energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, first), sizes))
    alpha = energy / np.repeat(np.add.reduceat(energy, first), sizes)
    z = np.add.reduceat(alpha[:, None] * h, first, axis=0)
    return {"h": h, "t": t, "s": s, "alpha": alpha, "z": z, "logit": z @ w["c"] + w["d"]}


def _gradients(w, x, sizes, f, error) -> dict[str, np.ndarray]:
    dz = error[:, None] * w["c"]
    dz_row = np.repeat(dz, sizes, axis=0)
    gain = (dz_row * f["h"]).sum(axis=1)
    at = np.append(0, np.cumsum(sizes)[:-1])
    d_energy = f["alpha"] * (gain - np.repeat(np.add.reduceat(f["alpha"] * gain, at), sizes))
    d_gate = d_energy[:, None] * w["a"]
    dt = d_gate * f["s"] * (1 - f["t"] ** 2)
    ds = d_gate * f["t"] * f["s"] * (1 - f["s"])
    dh = f["alpha"][:, None] * dz_row + dt @ w["V"].T + ds @ w["U"].T
    dx = dh * (1 - f["h"] ** 2)
    return {
        "W": x.T @ dx, "b": dx.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
        "a": (f["t"] * f["s"]).T @ d_energy, "c": f["z"].T @ error, "d": error.sum(),
    }


def _slope(w: dict[str, np.ndarray], x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, total: int) -> dict[str, np.ndarray]:
    """What these bags add to the gradient of the mean log loss of `total` bags."""
    f = _forward(w, x, np.append(0, np.cumsum(sizes)[:-1]), sizes)
    return _gradients(w, x, sizes, f, (_sigmoid(f["logit"]) - labels) / total)


def _descend(prior: float, slope: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Full-batch Adam along the gradients that `slope` returns."""
    random = np.random.default_rng(6)
    shapes = {"W": (N_FEATURES, HIDDEN), "b": HIDDEN, "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "a": ATTENTION, "c": HIDDEN}
    w = {k: random.normal(0, 0.3, shape) for k, shape in shapes.items()}
    w["b"], w["d"] = np.zeros(HIDDEN), np.array(np.log(prior / (1 - prior)))
    one, two = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for epoch in range(1, EPOCHS + 1):
        for k, g in slope(w).items():
            g = g + DECAY * w[k]
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.999 * two[k] + 0.001 * g**2
            w[k] = w[k] - RATE * (one[k] / (1 - 0.9**epoch)) / (np.sqrt(two[k] / (1 - 0.999**epoch)) + 1e-8)
    return w


def _constant(prior: float) -> Model:
    return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, prior)


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Full-batch Adam on the log loss."""
    prior = float((labels.sum() + 0.5) / (len(labels) + 1))
    if len(np.unique(labels)) < 2:
        return _constant(prior)
    x = np.concatenate(bags).astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - mean) / scale
    sizes = np.array([len(b) for b in bags])
    return Model(mean, scale, _descend(prior, lambda w: _slope(w, x, sizes, labels, len(labels))), prior)


def _bag(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float32).reshape(-1, N_FEATURES)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, sizes, labels) of whole bags, about _CHUNK rows at a time; the batch has (label, bag)."""
    bags, labels, rows = [], [], 0
    for i in range(batch.num_rows):
        labels.append(batch.column(0)[i].as_py())
        bags.append(_bag(batch.column(1)[i].as_py()))
        rows += len(bags[-1])
        if rows >= _CHUNK or i + 1 == batch.num_rows:
            yield np.concatenate(bags).astype(np.float64), np.array([len(b) for b in bags]), np.array(labels)
            bags, labels, rows = [], [], 0


def _summed(sample: DataFrame, of: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of a vector over all chunks of the stored sample, added up per batch on Spark."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sum(of(*c) for c in _chunks(batch)).tobytes()], pa.binary())], ["part"])

    parts = map_arrow(sample.select("label", "bag"), run, "part binary").collect()
    return np.sum([np.frombuffer(p.part) for p in parts], axis=0)


def fit_stored(sample: DataFrame) -> Model:
    """`fit` with the bags (label, bag, passages) left on Spark: one job per epoch."""
    total, positive, rows = sample.agg(F.count(F.lit(1)), F.sum("label"), F.sum("passages")).first()
    prior = ((positive or 0.0) + 0.5) / (total + 1)
    if not total or positive in (0, total):
        return _constant(prior)
    mean = _summed(sample, lambda x, sizes, labels: x.sum(axis=0)) / rows
    scale = np.sqrt(_summed(sample, lambda x, sizes, labels: ((x - mean) ** 2).sum(axis=0)) / rows) + 1e-6

    def slope(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        def flat(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> np.ndarray:
            g = _slope(w, (x - mean) / scale, sizes, labels, total)
            return np.concatenate([np.ravel(g[k]) for k in w])

        cut = np.split(_summed(sample, flat), np.cumsum([v.size for v in w.values()])[:-1])
        return {k: part.reshape(v.shape) for (k, v), part in zip(w.items(), cut)}

    return Model(mean, scale, _descend(prior, slope), prior)


def predict(model: Model, bags: list[np.ndarray]) -> np.ndarray:
    if not model.weights:
        return np.full(len(bags), model.prior)
    sizes = np.array([len(b) for b in bags])
    x = np.clip((np.concatenate(bags) - model.mean) / model.scale, -20, 20)
    return _sigmoid(_forward(model.weights, x, np.append(0, np.cumsum(sizes)[:-1]), sizes)["logit"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_bags: int = MAX_BAGS,
    driver_passages: int = DRIVER_PASSAGES,
) -> Model:
    """Fit on about `max_bags` labelled documents at most, drawn by a hash of their identifiers, whatever their length.

    A sample of more than `driver_passages` passages is fitted on Spark, by `fit_stored`.
    """
    marked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg(label) >= 0.5).cast("double").alias("label"))
    )
    total = marked.count()
    share = min(1.0, max_bags / max(1, total))
    drawn = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text"))
    sample = rows.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "label")

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = [encode(text) for text in batch.column(1).to_pylist()]
        sizes, kept = pa.array([len(b) for b in bags], pa.int64()), pa.array([b.tobytes() for b in bags], pa.binary())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), sizes, kept], names=["doc_id", "label", "passages", "bag"]
        )

    stored = materialize(map_arrow(sample, encoded, "doc_id long, label double, passages long, bag binary"), "quality-bags")
    if (stored.agg(F.sum("passages")).first()[0] or 0) > driver_passages:
        return fit_stored(stored)
    found = stored.select("doc_id", "label", "bag").collect()
    found.sort(key=lambda r: (r.doc_id, r.label, bytes(r.bag)))
    return fit([_bag(r.bag) for r in found], np.array([r.label for r in found]))


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    return predict(model, [encode(text) for text in texts.to_pylist()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(model, batch.column(1)))], ["doc_id", "score"])

    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text")), run, "doc_id long, score double"
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents that score at or above the threshold, with all their columns."""
    binary = docs.withColumn("text", utf8("text"))
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_scores(model, batch.column(at)) >= threshold))

    return map_arrow(binary, run, binary.schema).withColumn("text", F.col("text").cast("string"))
