"""Quality by votes of the nearest labelled documents in a latent semantic space.

A text is counted over ``Settings.buckets`` hashed features: its words (lower case), the shapes of
its words (runs of capitals, other letters, digits, and each other sign), and how often a word or a
line repeats the one before or an earlier one. Counts are damped, weighted by inverse document
frequency and projected on the leading singular vectors of the labelled sample. The score of a
document is the mean label of its ``Settings.neighbours`` nearest labelled vectors by cosine,
weighted by the positive part of the cosine to a power; products are exact and done block by block.

The labelled sample is bounded (``Settings.fit_docs`` documents of at most ``Settings.fit_bytes``
bytes), so what is broadcast is at most ``fit_docs * rank`` numbers; every document is scored
on its whole text.

Defined cases: a null or empty text, or one without any feature in common with the sample, gets the
share of good documents in the sample. Without labels every score is 0.5. Repeated rows are scored
each; a document's contradicting labels count as bad.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import map_rows
from seriesloom.llm.samples import labelled_texts
from seriesloom.llm.words import mix, slices

_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[48:58] = 48
_CLASS[65:91] = 65
_CLASS[97:123] = 97
_CLASS[128:] = 97
_PARTS = 4  # parts of the feature space: words, shapes, repeats; shapes have two of them


@dataclass(frozen=True)
class Settings:
    fit_docs: int = 6000
    fit_bytes: int = 32768
    buckets: int = 2048
    rank: int = 48
    neighbours: int = 25
    power: float = 4.0
    block: int = 512  # documents in one product


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of features
    axes: np.ndarray  # buckets by rank
    vectors: np.ndarray  # of the labelled documents, length 1
    labels: np.ndarray
    share: float


def histograms(texts: pa.Array, buckets: int) -> np.ndarray:
    """Feature counts, texts by buckets."""
    part = buckets // _PARTS
    out = np.zeros((len(texts), buckets), np.float32)
    for a, b, words in slices(texts):
        n = b - a

        def add(ids, rows):
            out[a:b] += np.bincount(rows * buckets + ids.astype(np.int64), minlength=n * buckets).reshape(n, buckets)

        if len(words.starts):
            h = words.hashes()
            add(h % np.uint64(part), words.text)
            # The shape of a word: its classes of characters, equal neighbours once.
            kinds = _CLASS[words.data]
            turn = np.ones(len(kinds), bool)
            turn[1:] = kinds[1:] != kinds[:-1]
            turn[words.starts] = True
            place = np.cumsum(turn) - 1
            start = place[words.starts]
            code = np.zeros(len(words.starts), np.uint64)
            size = place[words.ends - 1] - start + 1
            at = kinds[turn]
            for k in range(int(min(size.max(), 12))):  # further turns of a word add only to its size
                more = size > k
                code[more] = mix(code[more] * np.uint64(31) + at[start[more] + k])
            add(part + mix(code + np.minimum(size, 12).astype(np.uint64)) % np.uint64(2 * part), words.text)
            same = np.flatnonzero((h[1:] == h[:-1]) & (words.text[1:] == words.text[:-1])) + 1
            add(np.full(len(same), 3 * part), words.text[same])
            # Words of the text that it has already had, by how many in ten.
            order = np.lexsort((h, words.text))
            again = np.zeros(len(h), bool)
            again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (words.text[order[1:]] == words.text[order[:-1]])
            tenth = np.bincount(words.text[again], minlength=n) * 10 // np.maximum(words.counts, 1)
            some = np.flatnonzero(words.counts)
            out[a + some, 3 * part + 1 + np.minimum(tenth[some], 10)] += words.counts[some]
        raw = words.data.tobytes()
        for i in range(n):
            lines = raw[words.offsets[i] : words.offsets[i + 1]].split(b"\n")
            out[a + i, 3 * part + 20] = len(lines) - len(set(lines))
    return out


def _damped(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(sample: list[tuple[int, str, int]], s: Settings = Settings()) -> Model:
    y = np.array([label for _, _, label in sample], np.float64)
    if not len(y):
        return Model(np.ones(s.buckets, np.float32), np.zeros((s.buckets, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5)
    x = _damped(histograms(pa.array([text for _, text, _ in sample], pa.string()), s.buckets))
    weights = (np.log((1 + len(y)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    x *= weights
    rank = min(s.rank, *x.shape)
    # Randomized range finder with a few power steps, then the small exact problem.
    q = np.random.default_rng(7).standard_normal((s.buckets, min(rank + 16, s.buckets))).astype(np.float32)
    for _ in range(4):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, right = np.linalg.svd(x @ q, full_matrices=False)
    axes = (q @ right[:rank].T).astype(np.float32)
    return Model(weights, axes, _unit(x @ axes).astype(np.float32), y, float(y.mean()))


def vote(counts: np.ndarray, m: Model, s: Settings) -> np.ndarray:
    """Scores of some documents from their feature counts."""
    out = np.full(len(counts), m.share)
    if not len(m.labels):
        return out
    z = (_damped(counts) * m.weights) @ m.axes
    there = np.linalg.norm(z, axis=1) > 1e-9
    z = _unit(z)
    k = min(s.neighbours, len(m.labels))
    for a in range(0, len(z), s.block):
        cosines = z[a : a + s.block] @ m.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** s.power
        total = weight.sum(1)
        votes = (weight * m.labels[near]).sum(1) / np.maximum(total, 1e-12)
        rows = there[a : a + s.block] & (total > 0)
        out[a : a + s.block][rows] = votes[rows]
    return np.clip(out, 0, 1)


def score_texts(docs: DataFrame, model: Model, keep: list[str], s: Settings = Settings(), text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the settings

    def make():
        def work(texts: pa.Array) -> list:
            scores = [vote(histograms(texts.slice(a, s.block), s.buckets), shared.value, s) for a in range(0, len(texts), s.block)]
            return [pa.array(np.concatenate(scores))]

        return work

    return map_rows(docs, keep, make, [T.StructField("score", T.DoubleType())], text)


def classify(docs: DataFrame, labels: DataFrame, allowed: Column, keep: list[str] = ["doc_id"], s: Settings = Settings()) -> DataFrame:
    """Fit on the labelled documents that meet ``allowed`` and score all of ``docs``."""
    model = fit(labelled_texts(docs, labels, "quality", allowed, s.fit_docs, s.fit_bytes, F.min), s)
    return score_texts(docs, model, keep, s)
