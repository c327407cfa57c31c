"""Toxicity classifier, regularised by counterfactual identity swaps.

A document is judged by its worst sentence, so length does not dilute an
insult. A sentence's logit is the sum of weights of hashed features of its
distinct words (the word, and its first four, five and six bytes). Training starts
from the features' log odds in a bounded labelled sample and then follows
the gradient of the log loss through each document's worst sentence. Each
step also takes labelled sentences, swaps an identity term for another (in a
sentence that mentions none, a word is replaced by one and by another) and
penalises the squared change of the logit, so that naming a group does not
move the score, whatever the sample's toxic sentences happen to mention.

A null or empty text has no sentence and scores by the bias alone. With one
class only (or no labels) the score is that class's smoothed share. Texts are
scored whole; repeated rows score alike.
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

FEATURES = 1 << 18  # feature 0 is unused: "no such feature"
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
_BASE = 0x9E3779B97F4A7C15

#: Words that name groups of people; a parameter of ``learn``.
IDENTITY_TERMS = (
    "women", "men", "woman", "man", "girls", "boys", "gay", "lesbian", "bisexual", "transgender", "queer", "straight",
    "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "buddhist", "catholic", "atheist",
    "black", "white", "asian", "african", "arab", "latino", "american", "european", "chinese", "indian", "mexican",
    "immigrant", "immigrants", "refugee", "refugees", "disabled", "blind", "deaf", "elderly", "old", "young",
    "frauen", "männer", "juden", "muslime", "christen", "ausländer", "flüchtlinge", "behinderte",
    "femmes", "hommes", "juifs", "musulmans", "chrétiens", "immigrés", "réfugiés", "handicapés",
    "mujeres", "hombres", "judíos", "musulmanes", "cristianos", "inmigrantes", "refugiados", "discapacitados",
)

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_WORD[0x27] = True
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each word, each word's sentence, each sentence's text); the
    sentences are those that hold a word, in order, a word once in each."""
    lower = [t.lower().encode() for t in texts]
    data = np.frombuffer(b"\n".join(lower) + b"\n", np.uint8)
    inside = _WORD[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty((0, 1 + len(PREFIXES)), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    up = np.full(len(data), _BASE, np.uint64)
    up[0] = 1
    np.multiply.accumulate(up, out=up)
    down = np.full(len(data), pow(_BASE, -1, 1 << 64), np.uint64)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * up, dtype=np.uint64)])
    out = np.zeros((len(starts), 1 + len(PREFIXES)), np.int64)
    for i, size in enumerate((0, *PREFIXES)):
        stop = np.minimum(starts + size, ends) if size else ends
        h = mix((sums[stop] - sums[starts]) * down[starts] + np.uint64(i))
        out[:, i] = 1 + (h % np.uint64(FEATURES - 1)).astype(np.int64)
        if size:
            out[ends - starts < size, i] = 0
    stops = np.cumsum(_STOP[data])[starts]
    text_ends = np.cumsum([len(b) + 1 for b in lower])
    text = np.searchsorted(text_ends, starts, side="right")
    new = np.ones(len(starts), bool)
    new[1:] = (stops[1:] != stops[:-1]) | (text[1:] != text[:-1])
    sentence = np.cumsum(new) - 1
    once = np.sort(np.unique(sentence * FEATURES + out[:, 0], return_index=True)[1])
    return out[once], sentence[once], text[new]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, texts: list[str]) -> np.ndarray:
        words, sentence, text = features(texts)
        out = np.full(len(texts), -np.inf)
        if len(sentence):
            begin = np.flatnonzero(np.diff(sentence, prepend=-1))
            np.maximum.at(out, text, np.add.reduceat(self.weights[words].sum(axis=1), begin))
        return np.where(np.isinf(out), 0.0, out) + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def fit(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, terms: np.ndarray, epochs: int = 12,
        swap_penalty: float = 1.0, decay: float = 1e-3, prior: float = 2.0, seed: int = 7) -> Model:
    """``docs``: each document's word features and sentence numbers; ``terms``:
    the features of each identity term."""
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(FEATURES), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    n_pos, n_neg = int(y.sum()), int(len(y) - y.sum())
    seen = np.zeros((2, FEATURES))
    for (words, _), label in zip(docs, y):
        seen[label, np.unique(words)] += 1
    odds = np.log((seen[1] + prior) / (n_pos + 2 * prior)) - np.log((seen[0] + prior) / (n_neg + 2 * prior))
    error = np.sqrt(1 / (seen[0] + prior) + 1 / (seen[1] + prior))
    sure = np.sign(odds) * np.maximum(np.abs(odds) - 1.5 * error, 0)  # what the counts leave little doubt of
    pace = np.minimum(seen.sum(axis=0) / 60, 1.0) * (seen.sum(axis=0) >= 5)  # rare features learn slowly, the rarest not at all
    pace[0] = 0.0
    w = (pace > 0) * np.clip(sure, -1, 6)
    bias, rate = -3.0, 0.1
    known = {tuple(t) for t in terms.tolist()}
    begins = [np.flatnonzero(np.diff(s, prepend=-1)) for _, s in docs]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(docs)):
            words, begin = docs[i][0], begins[i]
            if not len(words):
                bias -= 0.1 * step * (1 / (1 + np.exp(-bias)) - y[i])
                continue
            logit = np.add.reduceat(w[words].sum(axis=1), begin)
            worst = int(logit.argmax())
            own = words[begin[worst]:begin[worst + 1] if worst + 1 < len(begin) else len(words)]
            balance = len(y) / (2 * (n_pos if y[i] else n_neg))
            err = balance * (1 / (1 + np.exp(-np.clip(logit[worst] + bias, -30, 30))) - y[i])
            bias -= 0.1 * step * err
            f = own[own > 0]
            w[f] -= step * pace[f] * (err + decay * w[f])
            if len(terms) > 1:  # swap an identity term of this sentence, or one put in a word's place
                named = [k for k, word in enumerate(own.tolist()) if tuple(word) in known]
                a = own[named[0]] if named else terms[rng.integers(len(terms))]
                b = terms[rng.integers(len(terms))]
                for a, b in ((a, b), (b, np.zeros_like(b))):  # another group; no group
                    change = w[a].sum() - w[b].sum()
                    if change:
                        w[a[a > 0]] -= step * swap_penalty * change / (2 * a.size)
                        w[b[b > 0]] += step * swap_penalty * change / (2 * a.size)
    return Model(w, float(bias))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = 2_500,
          identity_terms: tuple[str, ...] = IDENTITY_TERMS) -> Model:
    """A model from at most ``per_class`` labelled documents of each class."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "text"):
            words, sentence, text = features(texts)
            at = np.searchsorted(text[sentence] if len(text) else text, np.arange(len(texts) + 1))
            own = list(zip(at[:-1], at[1:]))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array([words[a:b].astype("<i4").tobytes() for a, b in own], pa.binary()),
                 pa.array([sentence[a:b].astype("<i4").tobytes() for a, b in own], pa.binary())], ["doc_id", "y", "words", "sentence"])

    rows = (labelled_texts(docs, labels, label_col, per_class)
            .mapInArrow(run, "doc_id bigint, y int, words binary, sentence binary").collect())  # at most 2 * per_class rows
    rows.sort(key=lambda r: (r.doc_id, r.words))
    own = [(np.frombuffer(r.words, "<i4").reshape(-1, 1 + len(PREFIXES)).astype(np.int64), np.frombuffer(r.sentence, "<i4")) for r in rows]
    terms = np.concatenate([features([t])[0] for t in identity_terms]) if identity_terms else np.empty((0, 1 + len(PREFIXES)), np.int64)
    return fit(own, np.array([r.y for r in rows], np.int64), terms)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.scores(texts))], ["doc_id", "score"])

    return doc_texts(docs).mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
