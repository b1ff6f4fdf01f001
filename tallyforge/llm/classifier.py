"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Every word has two units, its whole form and its last three bytes, each hashed to a row of a table of fixed size. A
unit's vector sums the sparse random index vectors of the words around it over the whole corpus: exact integer
sums, one aggregate. A document is the mean and the spread of its units' vectors, rare units weighing more, how often
neighbours share a unit, and how many units differ. The network is trained on a bounded sample of labelled documents, and its temperature is set on a part of them
that the training did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import words as W
from tallyforge.llm.tables import join_texts, save

FOLDS = 5


@dataclass(frozen=True)
class Settings:
    rows: int = 8192  # table rows for each of the two kinds of unit
    dims: int = 64
    reach: int = 2  # words to each side
    max_training_rows: int = 20_000  # labelled rows that are fitted; all others are only scored
    hidden: int = 32
    epochs: int = 60
    rate: float = 3e-3
    decay: float = 1e-4
    rare: float = 1e-4
    cut: float = 0.3


def _units(words: W.Words, s: Settings) -> np.ndarray:
    """For each word the table rows of its form and of its last three bytes."""
    start = np.maximum(words.start, words.end - 3)
    tail = np.zeros(len(start), np.uint64)
    for back in range(3):
        at = words.end - 1 - back
        tail = tail * np.uint64(257) + np.where(at >= start, words.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return np.stack([words.hash % np.uint64(s.rows), W.mix(tail, 3) % np.uint64(s.rows) + np.uint64(s.rows)], 1).astype(np.int64)


def _context(s: Settings):
    """Sums of a partition: (cell, value); the last column of a row counts the unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = s.dims + 1
        table = np.zeros(2 * s.rows * width, np.int64)
        for part in W.chunks(batches, "text"):
            words = W.split_words(part["text"])
            units, owner = _units(words, s), words.owner()
            marks = W.mix(units[:, 1].astype(np.uint64), 11)  # the index vector of a word: one +1 and one -1
            plus, minus = (marks % np.uint64(s.dims)).astype(np.int64), ((marks >> np.uint64(32)) % np.uint64(s.dims)).astype(np.int64)
            for unit in (units[:, 0] * width, units[:, 1] * width):
                table += np.bincount(unit + s.dims, minlength=len(table))
                for step in range(1, s.reach + 1):
                    near = owner[step:] == owner[:-step]
                    here, there = np.flatnonzero(near), np.flatnonzero(near) + step
                    for a, b in ((here, there), (there, here)):
                        table += np.bincount(unit[a] + plus[b], minlength=len(table)) - np.bincount(unit[a] + minus[b], minlength=len(table))
        cells = np.flatnonzero(table)
        for a in range(0, len(cells), 100_000):
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cells[a : a + 100_000]), "value": pa.array(table[cells[a : a + 100_000]])})

    return run


def word_vectors(docs: DataFrame, s: Settings, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of all table rows, and each row's weight; 2 * rows * (dims + 1) numbers reach the driver."""
    sums = docs.select(F.col(text_col).alias("text")).mapInArrow(_context(s), "cell bigint, value bigint").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    table = np.zeros(2 * s.rows * (s.dims + 1))
    table[sums["cell"].to_numpy()] = sums["value"].to_numpy()
    table = table.reshape(2 * s.rows, s.dims + 1)
    vectors, uses = table[:, : s.dims], table[:, s.dims]
    vectors = np.sign(vectors) * np.log1p(np.abs(vectors))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = uses / max(uses.sum() / 2, 1.0)
    return vectors.astype(np.float32), (s.rare / (s.rare + share)).astype(np.float32)


def _inputs(s: Settings) -> int:
    return 4 * s.dims + 5


def _pooled(texts: pa.Array, vectors: np.ndarray, weights: np.ndarray, s: Settings) -> np.ndarray:
    """Of both kinds of units: weighted mean and spread of vectors, equal neighbours, different units; and the log of the words."""
    words = W.split_words(texts)
    units, first = _units(words, s), words.first
    out = np.zeros((len(first) - 1, _inputs(s)), np.float32)
    for i in range(len(first) - 1):
        own = units[first[i] : first[i + 1]]
        if len(own):
            for kind in range(2):
                row, count = np.unique(own[:, kind], return_counts=True)
                weight = count * weights[row]
                v = vectors[row]
                mean = weight @ v / weight.sum()
                at = 2 * kind * s.dims
                out[i, at : at + s.dims] = mean
                out[i, 4 * s.dims + 2 * kind : 4 * s.dims + 2 * kind + 2] = (own[1:, kind] == own[:-1, kind]).mean() if len(own) > 1 else 0.0, len(row) / len(own)
                out[i, at + s.dims : at + 2 * s.dims] = np.sqrt(np.maximum(weight @ (v * v) / weight.sum() - mean * mean, 0))
            out[i, -1] = np.log1p(len(own))
    return out


@dataclass
class Network:
    """Standardised inputs, one hidden layer, one output whose logit is divided by the temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, s: Settings) -> Network:
    """Adam on the logistic loss over rows not in ``calibrate``; the temperature is the best of a fine grid on the rest."""
    rng = np.random.default_rng(5)
    xt, yt = x[~calibrate].astype(np.float64), y[~calibrate]
    prior = (yt.sum() + 1) / (len(yt) + 2)
    size = x.shape[1]
    net = Network(np.zeros(size), np.ones(size), np.zeros((size, s.hidden)), np.zeros(s.hidden), np.zeros(s.hidden), float(np.log(prior / (1 - prior))))
    if len(np.unique(yt)) < 2:
        return net
    net.shift, net.scale = xt.mean(0), xt.std(0) + 1e-3
    net.w1, net.w2 = rng.normal(0, size**-0.5, net.w1.shape), rng.normal(0, s.hidden**-0.5, s.hidden)
    z = (xt - net.shift) / net.scale
    names = ("w1", "b1", "w2", "b2")
    moments = {k: [np.zeros_like(getattr(net, k), dtype=float)] * 2 for k in names}
    step = 0
    for _ in range(s.epochs):
        for rows in np.array_split(rng.permutation(len(yt)), max(1, len(yt) // 256)):
            step += 1
            hidden = np.tanh(z[rows] @ net.w1 + net.b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -30, 30))) - yt[rows]) / len(rows)
            back = np.outer(error, net.w2) * (1 - hidden**2)
            slopes = {"w1": z[rows].T @ back + s.decay * net.w1, "b1": back.sum(0), "w2": hidden.T @ error + s.decay * net.w2, "b2": error.sum()}
            for k in names:
                m, v = moments[k]
                moments[k] = [0.9 * m + 0.1 * slopes[k], 0.999 * v + 0.001 * slopes[k] ** 2]
                m, v = moments[k][0] / (1 - 0.9**step), moments[k][1] / (1 - 0.999**step)
                setattr(net, k, getattr(net, k) - s.rate * m / (np.sqrt(v) + 1e-8))
    if calibrate.any():
        logits = net.logits(x[calibrate].astype(np.float64))
        net.temperature = min(np.exp(np.linspace(-2, 3, 101)), key=lambda t: _loss(logits / t, y[calibrate]))
    return net


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels count only from ids whose crc32, as text, is no multiple of FOLDS; rows with nulls are left out, and
    of contradicting ones the lower counts. Inputs are the texts' words alone. Null and empty texts have all inputs 0. A
    null id is not held out. Without labels of both kinds the score is the share of ones, smoothed.
    """
    s = settings or Settings()
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    vectors, weights = word_vectors(docs, s)
    shared = spark.sparkContext.broadcast((vectors, weights))

    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(fold != 0)
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    total = max(known.count(), 1)
    share = min(1.0, s.max_training_rows / total)
    known = save(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            x = _pooled(part["text"], *shared.value, s)
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "y": part["y"], "x": pa.array([r.tobytes() for r in x], pa.binary())})

    rows = join_texts(docs, known, "doc_id").select("doc_id", "text", "y").mapInArrow(pooled, "doc_id bigint, y int, x binary").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(len(rows), _inputs(s))
    ids = rows["doc_id"].to_numpy()
    net = fit(x, rows["y"].to_numpy().astype(float), W.mix(ids.astype(np.uint64), 17) % np.uint64(5) == 0, s)
    network = spark.sparkContext.broadcast(net)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "score": pa.array(network.value.scores(_pooled(part["text"], *shared.value, s)), pa.float64())})

    out = docs.mapInArrow(judge, "doc_id bigint, score double")
    return out.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= s.cut).cast("int").alias("predicted"))
