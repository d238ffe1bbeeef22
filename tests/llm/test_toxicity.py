import math
import tracemalloc

import pytest
from pyspark.sql import functions as F

from seriesloom.llm import toxicity
from seriesloom.llm.samples import labelled_texts
from tests.llm.conftest import make_text


def corpus(n=240):
    docs, labels = [], []
    for i in range(n):
        text = make_text(i, 60)
        if i % 4 == 0:
            words = text.split(" ")
            words.insert(30, ("idiot", "clownish")[i % 8 // 4])
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, 1, int(i % 4 == 0)))
    return docs, labels


@pytest.fixture(scope="module")
def scored(docs_of, labels_of, odd_rows):
    docs, labels = corpus()
    model = toxicity.fit([(i, t, y[2]) for (i, t), y in zip(docs[:160], labels)])
    table = docs_of(docs + [(1000 + (r[0] or 0), r[1]) for r in odd_rows])
    return docs, labels, model, {r["doc_id"]: r for r in toxicity.score_texts(table, model, ["doc_id"]).collect()}


def test_held_out_documents_and_places(scored):
    docs, labels, _, got = scored
    for (i, text), (_, _, y) in list(zip(docs, labels))[160:]:
        assert (got[i]["score"] >= 0.7) == bool(y)
        found = [text[s["start"] : s["start"] + s["length"]] for s in got[i]["sentences"]]
        assert bool(found) == bool(y)
        assert all("idiot" in f or "clown" in f for f in found)


def by_hand(text, m, faint=toxicity.Settings().faint):
    """Score by products of chances, over all sentences whatever their number."""
    found = toxicity.sentences(text.encode())
    clean = 1 - 1 / (1 + math.exp(-m.bias)) if found else 1.0
    for _, _, words in found:
        z = m.bias + sum(m.weights.get(f, 0.0) for f in {f for w in words for f in toxicity.features(w)})
        clean *= min(1.0, (1 - 1 / (1 + math.exp(-z))) / (1 - faint))
    return 1 - clean


def test_noisy_or_by_hand(scored):
    docs, _, m, got = scored
    for i, text in docs[160:180]:
        assert got[i]["score"] == pytest.approx(by_hand(text, m), abs=1e-9)


def test_score_never_falls_with_more_sentences(docs_of):
    """Six weak sentences (chance 0.4) keep their score beside any number of clean ones, and every added sentence may only raise it."""
    weight = math.log(0.4 / 0.6) + 9
    m = toxicity.Model(-9.0, {b"weak": weight, b"mild": -3.0, b"strong": 12.0})
    weak = "weak one here. " * 6
    texts = [(n, weak + "clean words here. " * n) for n in (0, 90, 2000, 5000)]
    grown = ["clean a.", "mild b.", "weak c.", "mild weak d.", "clean e.", "strong f.", "mild g."]
    texts += [(10_000 + k, " ".join(grown[:k])) for k in range(len(grown) + 1)]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs_of(texts), m, ["doc_id"]).collect()}
    assert all(got[i] == pytest.approx(by_hand(text, m), abs=1e-9) for i, text in texts)
    assert got[0] > 0.7 and got[0] == got[90] == got[2000] == got[5000]
    rising = [got[10_000 + k] for k in range(len(grown) + 1)]
    assert rising == sorted(rising) and rising[0] == 0.0 and rising[-1] > 0.9


def test_odd_rows(scored, odd_rows):
    got = scored[3]
    assert got[1001]["score"] == got[1002]["score"] == got[1003]["score"] == 0.0
    assert all(0 <= got[1000 + (r[0] or 0)]["score"] <= 1 for r in odd_rows)


def test_fit_holds_no_words_of_all_texts():
    """Words of clean documents alone are no candidates; the driver holds the texts, not every word and prefix of them."""
    docs, labels = corpus()
    rows = [(i, t, y[2]) for (i, t), y in zip(docs, labels)]
    digits = str.maketrans("0123456789", "ghijklmnop")
    rows += [(1000 + i, " ".join(f"z{i:03}{k:03}".translate(digits) + "." * (k % 10 == 9) for k in range(300)), 0) for i in range(400)]
    tracemalloc.start()
    m = toxicity.fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {b"idiot", b"clownish"} <= m.weights.keys() and peak < 6 * sum(len(t) for _, t, _ in rows)


def test_no_rows_and_no_labels(docs_of, labels_of):
    assert toxicity.detect(docs_of([]), labels_of([]), F.lit(True)).collect() == []
    out = toxicity.detect(docs_of([(1, "some text"), (None, "x")]), labels_of([]), F.lit(True)).collect()
    assert [r["score"] for r in out] == [0.0, 0.0]
    only = toxicity.detect(docs_of([(1, "some text"), (2, None)]), labels_of([(1, 1, 1), (None, 1, 0), (2, None, None)]), F.lit(True)).collect()
    assert sorted(r["score"] for r in only) == [0.0, 1.0]


def test_length_alone_is_not_toxic(docs_of, labels_of):
    """Evidence-free sentences do not add up, one toxic sentence still counts, and long labelled texts are in the fit whole."""
    docs, labels = corpus()
    model = toxicity.fit([(i, t, y[2]) for (i, t), y in zip(docs[:160], labels)])
    long = " ".join(make_text(5000 + i % 500, 12) + "." for i in range(50_000))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs_of([(1, long), (2, long + " you are an idiot.")]), model, ["doc_id"]).collect()}
    assert got[1] < 0.7 <= got[2]
    small = labelled_texts(docs_of([(1, "a " * 20_000), (2, "b"), (3, "c " * 20_000)]), labels_of([(1, 1, 0), (2, 1, 1), (3, 1, 0)]), "toxic", F.lit(True), 10, 100_000, total=True)
    assert [(i, len(t)) for i, t, _ in small] == [(1, 40_000), (2, 1), (3, 40_000)]
    few = labelled_texts(docs_of([(i, "x" * 100) for i in range(20)]), labels_of([(i, 1, 0) for i in range(20)]), "toxic", F.lit(True), 10, 550, total=True)
    assert len(few) == 5
