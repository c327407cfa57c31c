"""Quality classifier: random-indexing word vectors, pooled, and a small network.

Every word is two units: its lower-cased form and its shape (runs of capital
letters, small letters, digits, and the signs themselves), each hashed into a
fixed number of units. A unit has a sparse random index vector; its word vector is the
sum, over the whole corpus, of the index vectors of the units next to it.
A document is the frequency-weighted mean of its units' vectors, with
its length, how alike neighbouring words' index vectors are and the norms of
the pooled sums. A two-layer network in numpy maps that to a logit, and a
temperature fitted on documents that it did not learn from turns the logit into
a probability.

The vectors gather the whole corpus; the network learns from at most
``per_class`` labelled documents of each class. A null or empty text pools to
zeros and is scored like any other. With one class only (or no labels) the
score is that class's smoothed share. Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import doc_texts, text_blocks
from quire.llm.exchange import mix
from quire.llm.folds import held_out, labelled_texts
from quire.llm.words import word_ids, words

FORMS, SHAPES = 28_672, 4_096  # units for words and for shapes
UNITS = FORMS + SHAPES
DIM, ONES = 32, 2  # index vectors: so many dimensions, so many of them +1 or -1
CHUNK = 512  # units in one partial sum
POOL_BYTES = 1 << 18  # text pooled at once: a word's vectors take some hundred times its bytes
_BASE = 0x9E3779B97F4A7C15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x30:0x3A], _KIND[0x80:] = 1, 2, 3, 2
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and signs of every unit's index vector."""
    h = mix(np.arange(1, UNITS * ONES + 1, dtype=np.uint64).reshape(UNITS, ONES) * np.uint64(_BASE))
    at = (h % np.uint64(DIM // ONES)).astype(np.int64) + np.arange(ONES) * (DIM // ONES)  # never one dimension twice
    return at, np.where(h >> np.uint64(63), 1.0, -1.0)


_AT, _SIGN = _index_vectors()


def _segment_hashes(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each segment of 64-bit values; ``ends`` ascending from the first."""
    if not len(ends):
        return np.empty(0, np.uint64)
    starts = np.concatenate([[0], ends[:-1]])
    at = np.arange(len(values)) - np.repeat(starts, ends - starts)
    powers = np.full(int(at.max()) + 1 if len(at) else 1, _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[at], dtype=np.uint64)])
    return mix(sums[ends] - sums[starts])


def units(flat: bytes, ends: np.ndarray) -> np.ndarray:
    """(form, shape) units of each word."""
    ids, known = word_ids(flat, ends)
    if not len(known):
        return np.empty((0, 2), np.int64)
    size = np.diff(np.frombuffer(known.buffers()[1], np.int32)[:len(known) + 1]).astype(np.int64)
    raw = np.frombuffer(b"".join(known.to_pylist()), np.uint8)
    stops = np.cumsum(size)
    form = _segment_hashes(_VALUE[_LOWER[raw]], stops) % np.uint64(FORMS)
    kind = _KIND[raw]
    new = np.ones(len(raw), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[stops[:-1]] = True
    shape = _segment_hashes(_VALUE[kind[new]], np.cumsum(new)[stops - 1]) % np.uint64(SHAPES)
    return np.column_stack([form, shape + np.uint64(FORMS)]).astype(np.int64)[ids]


def _neighbours(counts: np.ndarray, lag: int) -> np.ndarray:
    """Positions whose word ``lag`` on is in the same text."""
    n = int(counts.sum())
    text = np.repeat(np.arange(len(counts)), counts)
    return np.flatnonzero(text[:-lag] == text[lag:]) if n > lag else np.empty(0, np.int64)


def context_sums(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of neighbours' index vectors, and occurrences, of every unit."""
    flat, ends, counts = words(texts)
    u = units(flat, ends)
    left = _neighbours(counts, 1)
    sums = np.zeros(UNITS * DIM)
    for a, b in ((left, left + 1), (left + 1, left)):
        for target in range(2):
            for other in range(2):
                for one in range(ONES):
                    flat_at = u[a, target] * DIM + _AT[u[b, other], one]
                    sums += np.bincount(flat_at, _SIGN[u[b, other], one], minlength=UNITS * DIM)
    return sums.reshape(UNITS, DIM), np.bincount(u.reshape(-1), minlength=UNITS).astype(np.float64)


@dataclass(frozen=True)
class Vectors:
    table: np.ndarray  # (UNITS, DIM) word vectors of norm one
    weight: np.ndarray  # of each unit in the pool: less for frequent ones


def word_vectors(docs: DataFrame) -> Vectors:
    """Random-indexing vectors over all texts of ``docs``.

    Each task sums its texts; the partial sums meet by unit range, first those
    of some tasks, then those. The result has a fixed size."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for _, texts in text_blocks(batches):
            s, n = context_sums(texts)
            own = np.column_stack([s, n])
            sums = own if sums is None else sums + own
        if sums is not None:
            parts = [sums[i:i + CHUNK].astype(np.float64).tobytes() for i in range(0, UNITS, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = total = None
        for b in batches:
            for c, raw in zip(b.column("chunk").to_pylist(), b.column("sums").to_pylist()):
                chunk, x = c, np.frombuffer(raw, np.float64)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["chunk", "sums"])

    parts = doc_texts(docs).mapInArrow(partial, "chunk int, sums binary").withColumn("fan", F.spark_partition_id() % 16)
    some = parts.groupBy("chunk", "fan").applyInArrow(add, "chunk int, sums binary")
    rows = some.groupBy("chunk").applyInArrow(add, "chunk int, sums binary").collect()  # UNITS x (DIM + 1) numbers
    whole = np.zeros((UNITS, DIM + 1))
    for r in rows:
        own = np.frombuffer(r.sums, np.float64).reshape(-1, DIM + 1)
        whole[r.chunk * CHUNK:r.chunk * CHUNK + len(own)] = own
    sums, n = whole[:, :DIM], whole[:, DIM]
    table = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    share = n / max(n.sum(), 1.0)
    return Vectors(table.astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32))


_LAGS = (1, 2, 3)
FEATURES = 2 * DIM + len(_LAGS) + 4


def pooled(texts: list[str], vectors: Vectors) -> np.ndarray:
    """The network's input for each text."""
    flat, ends, counts = words(texts)
    u = units(flat, ends)
    out = np.zeros((len(texts), FEATURES), np.float32)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    begin = (np.cumsum(counts) - counts)[some]
    n = counts[some].astype(np.float32)[:, None]
    signs = np.zeros((len(u), DIM), np.float32)
    for one in range(ONES):
        signs[np.arange(len(u)), _AT[u[:, 0], one]] = _SIGN[u[:, 0], one]
    for k in range(2):
        w = vectors.weight[u[:, k]][:, None]
        total = np.add.reduceat(vectors.table[u[:, k]] * w, begin, axis=0)
        mean = total / np.add.reduceat(w, begin, axis=0)
        out[some, k * DIM:(k + 1) * DIM] = mean
        out[some, 2 * DIM + len(_LAGS) + k] = np.linalg.norm(mean, axis=1)
    text = np.repeat(np.arange(len(texts)), counts)
    for i, lag in enumerate(_LAGS):
        at = _neighbours(counts, lag)
        alike = np.einsum("ij,ij->i", signs[at], signs[at + lag]) / ONES
        out[:, 2 * DIM + i] = np.bincount(text[at], alike, minlength=len(texts)) / np.maximum(np.bincount(text[at], minlength=len(texts)), 1)
    out[some, -2] = np.linalg.norm(np.add.reduceat(signs, begin, axis=0), axis=1) / np.sqrt(ONES * n[:, 0]) / 8
    out[some, -1] = np.log1p(n[:, 0]) / 8
    return out


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7) -> Network:
    """Adam on the log loss with weight decay; every fifth document is kept for the temperature."""
    rng = np.random.default_rng(seed)
    n = len(y)
    if n == 0 or y.min() == y.max():
        bias = 0.0 if n == 0 else float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        zero = np.zeros(FEATURES)
        return Network(zero, zero + 1, np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), bias, 1.0)
    order = rng.permutation(n)
    aside, own = order[::5], np.setdiff1d(order, order[::5])
    mean, scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
    z, t = (x[own] - mean) / scale, y[own].astype(float)
    p = [rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for epoch in range(epochs):
        for batch in np.array_split(rng.permutation(len(t)), max(1, len(t) // 64)):
            h = z[batch] @ p[0] + p[1]
            act = np.maximum(h, 0)
            err = (1 / (1 + np.exp(-np.clip(act @ p[2] + p[3], -30, 30))) - t[batch]) / len(batch)
            back = np.outer(err, p[2]) * (h > 0)
            grads = [z[batch].T @ back + 1e-4 * p[0], back.sum(axis=0), act.T @ err + 1e-4 * p[2], err.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - 3e-3 * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs)) * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    raw = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    logit, t = raw.logits(x[aside]), y[aside].astype(float)

    def loss(temp: float) -> float:
        q = np.clip(logit / temp, -30, 30)
        return float(np.mean(np.logaddexp(0, q) - t * q))

    temps = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    return Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), float(min(temps, key=loss)))


@dataclass(frozen=True)
class Model:
    vectors: Vectors
    network: Network

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.network.scores(pooled(texts, self.vectors)).astype(np.float64)


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = 6_000) -> Model:
    """Vectors from all of ``docs``; the network from a bounded labelled sample."""
    vectors = word_vectors(docs)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "text", POOL_BYTES):
            x = pooled(texts, vectors)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "y", "x"])

    rows = (labelled_texts(docs, labels, label_col, per_class)
            .mapInArrow(features, "doc_id bigint, y int, x binary").collect())  # at most 2 * per_class rows
    rows.sort(key=lambda r: (r.doc_id, r.x))
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows]).reshape(-1, FEATURES)
    return Model(vectors, fit(x, np.array([r.y for r in rows], np.int64)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "text", POOL_BYTES):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.scores(texts))], ["doc_id", "score"])

    return doc_texts(docs).mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the model predicts as good."""
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays([batch.column(at).fill_null("")], ["text"])
            kept = [model.scores(texts) >= 0.5 for _, texts in text_blocks([own], "text", POOL_BYTES)]
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.empty(0, bool)))

    return docs.mapInArrow(run, docs.schema)
