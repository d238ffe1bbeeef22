import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import neighbours
from seriesloom.llm.samples import labelled_texts
from tests.llm.conftest import make_text


def corpus(n=200):
    docs, labels = [], []
    for i in range(n):
        text = make_text(i, 70)
        if i % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 10 else " ".join(w + "$$$" for w in text.split())
        docs.append((i, text))
        labels.append((i, int(i % 5 != 0), 0))
    return docs, labels


def test_held_out_accuracy(docs_of, labels_of, odd_rows):
    docs, labels = corpus()
    table = docs_of(docs + [(1000 + (r[0] or 0), r[1]) for r in odd_rows])
    got = {r["doc_id"]: r["score"] for r in neighbours.classify(table, labels_of(labels), F.col("doc_id") < 150).collect()}
    assert np.mean([(got[i] >= 0.3) == bool(y) for i, y, _ in labels[150:]]) > 0.95
    share = np.mean([y for i, y, _ in labels[:150]])
    assert got[1001] == got[1002] == pytest.approx(share)
    assert all(0 <= s <= 1 for s in got.values())


def test_votes_by_brute_force():
    docs, labels = corpus(60)
    s = neighbours.Settings(neighbours=5, rank=8)
    m = neighbours.fit([(i, t, y[1]) for (i, t), y in zip(docs, labels)], s)
    counts = neighbours.histograms(pa.array([t for _, t in docs[:10]]), s.buckets)
    got = neighbours.vote(counts, m, s)
    for row, score in zip(counts, got):
        z = (np.sqrt(row / row.sum()) * m.weights) @ m.axes
        cos = m.vectors @ (z / np.linalg.norm(z))
        best = np.argsort(-cos)[:5]
        weight = np.maximum(cos[best], 0).astype(float) ** s.power
        assert score == pytest.approx((weight * m.labels[best]).sum() / weight.sum(), abs=1e-3)


def test_no_rows_and_no_labels(docs_of, labels_of):
    assert neighbours.classify(docs_of([]), labels_of([]), F.lit(True)).collect() == []
    assert [r["score"] for r in neighbours.classify(docs_of([(1, "a b"), (None, None)]), labels_of([(1, None, 1)]), F.lit(True)).collect()] == [0.5, 0.5]


def test_the_sample_does_not_depend_on_partitions(docs_of, labels_of):
    """An id with several texts gives the same one however rows are dealt."""
    rows = [(i % 20, make_text(i, 12)) for i in range(200)] + [(3, None), (4, "")]
    labels = labels_of([(i, i % 2, 0) for i in range(20)])
    found = [labelled_texts(docs_of(rows).repartition(n), labels, "quality", F.lit(True), 100, 10_000, total=total) for n in (1, 3, 7) for total in (False, True)]
    assert len(found[0]) == 20 and all(f == found[0] for f in found)
