"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence is toxic with probability sigmoid(bias + weights of the features of its different words:
the word in lower case, and its first 3 to 7 bytes, so that inflected forms share weight); a document
is toxic unless every sentence is clean (noisy-or): its score is ``1 - product of (1 - sentence)``.
Only document labels are used: weights are fitted to the likelihood of the document labels by
proximal gradient steps, which leave most words at exactly zero. Sentences at or above a cutoff are
reported as the offending ones.

One rule scores texts of any length. A sentence counts as evidence from a chance of ``Settings.faint``
on: what it adds is ``1 - (1 - sentence) / (1 - faint)``, or nothing where that is negative. The bias, the
chance without any evidence, enters once for a document with a sentence. So ordinary sentences do not add
up with length, evidence does, and adding a sentence never lowers a score.

Fitting uses a bounded sample (``Settings.fit_docs`` documents, ``Settings.fit_bytes`` bytes in all,
each text whole) on the driver; scoring covers every whole text, partition by partition.

Defined cases: a null or empty text has no sentence and scores 0. Repeated rows are scored each.
If the sample has no toxic or no clean document, every score is the share of toxic labels (0
without any label), and no sentence is reported.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import map_rows
from seriesloom.llm.samples import labelled_texts

_PLAIN = bytearray(range(256))
for _c in range(128):
    _PLAIN[_c] = _c + 32 if 65 <= _c <= 90 else _c if 97 <= _c <= 122 else 10 if chr(_c) in ".!?\n" else 32
_PLAIN = bytes(_PLAIN)
BATCH = 256  # texts that a worker holds as Python strings at once
_SENTENCE = re.compile(rb"[^\n]*[^\n ][^\n]*")


@dataclass(frozen=True)
class Settings:
    fit_docs: int = 8000
    fit_bytes: int = 48 << 20  # of all documents together
    least_docs: int = 3  # documents of the sample that a feature must occur in
    kept_words: int = 500_000  # weightless words that a worker remembers
    rounds: int = 300
    rate: float = 0.5
    shrink: float = 0.1
    doubt: float = 2.0  # standard errors taken off a feature's first weight
    cutoff: float = 0.5  # of an offending sentence
    faint: float = 0.2  # chance of a sentence up to which it is no evidence


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[bytes, float]
    share: float | None = None  # constant score, if nothing could be learnt


def sentences(text: bytes) -> list[tuple[int, int, list[bytes]]]:
    """(first byte, end, words in lower case) of each sentence with a word; they end at . ! ? and line feeds."""
    plain = text.translate(_PLAIN)
    return [(m.start(), m.end(), m.group().split()) for m in _SENTENCE.finditer(plain)]


def features(word: bytes) -> list[bytes]:
    return [word, *[word[:k] + b"-" for k in range(3, min(8, len(word)))]]


def _features_of(text: str) -> set[bytes]:
    return {f for w in set(text.encode().translate(_PLAIN).split()) for f in features(w)}


def fit(sample: list[tuple[int, str, int]], s: Settings = Settings()) -> Model:
    y = np.array([label for _, _, label in sample], float)
    if not len(y) or y.min() == y.max():
        return Model(0.0, {}, float(y.mean()) if len(y) else 0.0)
    # Candidates: features surely over-represented in toxic documents. All others keep weight zero, so those of clean
    # documents alone are not counted, and texts are cut again where they are needed: words of all would fill the driver.
    pos_df, neg_df = Counter(), Counter()  # documents with each feature, by label
    for _, text, label in sample:
        if label:
            pos_df.update(_features_of(text))
    for _, text, label in sample:
        if not label:
            neg_df.update(pos_df.keys() & _features_of(text))
    n_pos, n_neg = y.sum(), (1 - y).sum()
    known = [f for f, n in pos_df.items() if n + neg_df[f] >= s.least_docs]
    neg, pos = (np.array([c[f] for f in known], float) for c in (neg_df, pos_df))
    del pos_df, neg_df
    gain = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1)) - s.doubt * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    start = {f: float(x) for f, x in zip(known, gain) if x > 0}
    vocabulary = sorted(start)
    place = {f: i for i, f in enumerate(vocabulary)}
    ids, sizes, doc, idle = [], [], [], np.zeros(len(y))
    for i, (_, text, _) in enumerate(sample):
        d = [words for _, _, words in sentences(text.encode())]
        of = {w: own for w in set().union(*d) if (own := [place[f] for f in features(w) if f in place])}
        for words in d:
            hot = of.keys() & words
            if hot:
                own = sorted({k for w in hot for k in of[w]})
                ids.extend(own)
                sizes.append(len(own))
                doc.append(i)
            else:
                idle[i] += 1  # sentences without a candidate are alike
    ids, doc = np.array(ids, np.int64), np.array(doc, np.int64)
    row = np.repeat(np.arange(len(sizes)), np.array(sizes, np.int64))
    w = np.array([start[f] for f in vocabulary])
    b = -np.log(max(2.0, (idle.sum() + len(sizes)) / len(y))) - 2.0
    sum_w, sum_b = np.full(len(w), 1e-8), 1e-8
    for _ in range(s.rounds):
        z = b + np.bincount(row, w[ids], len(sizes))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + np.exp(-b))
        clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + idle * np.log1p(-p0)  # log of "no sentence fires"
        fires = np.maximum(-np.expm1(clean), 1e-9)
        # d loss / d z of a sentence is its p times this: a clean document wants each down, a toxic one its likeliest up.
        pull = np.where(y > 0, -np.exp(clean) / fires, 1.0)
        grad = p * pull[doc]
        g = np.bincount(ids, grad[row], len(w))
        gb = grad.sum() + p0 * (idle * pull).sum()
        sum_w += g * g
        sum_b += gb * gb
        step = s.rate / np.sqrt(sum_w)
        w = w - step * g
        w = np.sign(w) * np.maximum(0, np.abs(w) - step * s.shrink)
        b -= s.rate * gb / np.sqrt(sum_b)
    return Model(float(b), {word: float(v) for word, v in zip(vocabulary, w) if v != 0})


def score_texts(docs: DataFrame, model: Model, keep: list[str], s: Settings = Settings(), text: str = "text") -> DataFrame:
    """``keep``, score, and the offending sentences (first code point, length in code points, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most as many words as the sample has
    spot = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("score", T.DoubleType())])
    fields = [T.StructField("score", T.DoubleType()), T.StructField("sentences", T.ArrayType(spot))]
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())]))

    def make():
        m = shared.value
        idle = float(np.log1p(np.exp(m.bias)))  # -log(1 - p) of a sentence without a weighted word
        bar = float(np.log(s.cutoff / (1 - s.cutoff)))
        faint = max(idle, float(-np.log1p(-s.faint)))
        weightless: set[bytes] = set()

        def weigh(words: set[bytes]) -> set[bytes]:
            """Those words that have a weighted feature."""
            found = set()
            for w in words - weightless:
                if m.weights.keys().isdisjoint(features(w)):
                    weightless.add(w)
                else:
                    found.add(w)
            if len(weightless) > s.kept_words:
                weightless.clear()
            return found

        def one(raw: bytes):
            if m.share is not None:
                return (m.share if raw.strip() else 0.0), []
            plain = raw.translate(_PLAIN)
            weighted = weigh(set(plain.split()))
            if not weighted:
                return (float(-np.expm1(-idle)) if _SENTENCE.search(plain) else 0.0), []
            evidence, spots, found = 0.0, [], False
            for match in _SENTENCE.finditer(plain):
                found = True
                words = weighted.intersection(match.group().split())
                if words:
                    z = m.bias + sum(m.weights.get(f, 0.0) for f in sorted({f for w in words for f in features(w)}))
                    evidence += max(0.0, float(np.logaddexp(0, z)) - faint)
                    if z >= bar:
                        start = len(raw[: match.start()].decode())
                        spots.append({"start": start, "length": len(raw[match.start() : match.end()].decode()), "score": float(1 / (1 + np.exp(-z)))})
            return float(-np.expm1(-(evidence + idle * found))), spots

        def work(texts: pa.Array) -> list:
            out = [one(t.encode()) for a in range(0, len(texts), BATCH) for t in texts.slice(a, BATCH).to_pylist()]
            return [pa.array([x for x, _ in out], pa.float64()), pa.array([x for _, x in out], arrow)]

        return work

    return map_rows(docs, keep, make, fields, text)


def detect(docs: DataFrame, labels: DataFrame, allowed: Column, keep: list[str] = ["doc_id"], s: Settings = Settings()) -> DataFrame:
    """Fit on the labelled documents that meet ``allowed`` and score all of ``docs``."""
    model = fit(labelled_texts(docs, labels, "toxic", allowed, s.fit_docs, s.fit_bytes, total=True), s)
    return score_texts(docs, model, keep, s)
