import math
import re
from collections import Counter

import numpy as np

from seriesloom.llm import rules
from tests.llm.conftest import make_text


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(zip(words, words[1:], words[2:]))
    repeat = {i + k for i, r in enumerate(zip(words, words[1:], words[2:])) if runs[r] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


def test_counts(docs_of, labels_of, odd_rows):
    rows = odd_rows + [(30, "a b c a b c a\na b\n\n\na b\r\na b\r", "a"), (31, "x # y\nx # y\n|" * 30, "a"), (32, "w w w w w w", "b")]
    got = rules.judge(docs_of(rows), labels_of([])).collect()
    want = sorted((r[0] or -1, *by_hand(r[1])) for r in rows)
    assert sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])  # nothing is certified without labels
    assert rules.judge(docs_of([]), labels_of([])).collect() == []


def test_tail_is_the_binomial_sum():
    for k, n, p in ((0, 10, 0.1), (3, 40, 0.02), (7, 500, 0.01)):
        assert math.isclose(rules.tail(k, n, p), sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel_tol=1e-9)


def test_cutoffs_hold_and_need_enough_labels():
    g = rules.Guarantee()
    good, bad = np.zeros(41, int), np.zeros(41, int)
    good[0], good[2], bad[30] = 8000, 100, 80
    none = {(s, r): (np.zeros(41, int), np.zeros(41, int)) for s in range(3) for r in rules.RULES}
    chosen = rules.choose(none | {(0, "symbols"): (good, bad)}, g)
    assert set(chosen) == {(0, "symbols")} and 2 < chosen[0, "symbols"] <= 30
    few = {(0, "symbols"): (good // 50, bad)}
    assert rules.choose(few, g) == {}  # 100 good documents cannot prove a risk of 1%


def test_guarantee_over_random_labels():
    """Over many draws, a cutoff that truly rejects too many is hardly ever certified."""
    r = np.random.default_rng(1)
    wrong = 0
    for _ in range(200):
        good = np.bincount(np.where(r.random(2000) < 0.015, 20, 0), minlength=41)
        bad = np.bincount([25] * 300, minlength=41)
        chosen = rules.choose({(0, "symbols"): (good, bad)}, rules.Guarantee(price=0.0))
        wrong += chosen.get((0, "symbols"), 41) <= 20
    assert wrong <= 5


def test_copies_of_one_document_prove_nothing(docs_of, labels_of):
    """A labelled id is one trial, in its lowest stratum and at its highest levels, however many rows it has."""
    docs = [(1, make_text(1, 60))] * 3000 + [(2, " ".join(w + " #" for w in make_text(2, 60).split()))] * 300 + [(3, make_text(3, 300)), (3, make_text(3, 80) + " #" * 20)]
    labels = labels_of([(1, 1, 0), (2, 0, 0), (3, 1, 0)])
    counted = rules.text_counts(docs_of(docs), ["doc_id"])
    assert rules.calibrate(counted, labels, rules.Guarantee(price=0.0)) == {}
    seen = {}
    original = rules.choose
    try:
        rules.choose = lambda counts, g: seen.update(counts) or {}
        rules.calibrate(counted, labels)
    finally:
        rules.choose = original
    assert sum(int(good.sum()) for (s, r), (good, _) in seen.items() if r == "symbols") == 2
    assert sum(int(bad.sum()) for (s, r), (_, bad) in seen.items() if r == "symbols") == 1
    assert seen[0, "symbols"][0][1:].sum() == 1  # id 3 by its shorter row, with the symbols of that row


def test_all_rules_together_keep_the_risk():
    """Four rules that each reject other good documents: their sum stays within the risk."""
    g = rules.Guarantee(price=0.0)
    r = np.random.default_rng(2)
    over = 0
    for _ in range(100):
        rates = {rule: 0.004 for rule in rules.RULES}  # 1.6% in all, each below 1%
        counts = {(0, rule): (np.bincount(np.where(r.random(20000) < p, 20, 0), minlength=41), np.bincount([25] * 300, minlength=41)) for rule, p in rates.items()}
        chosen = rules.choose(counts, g)
        over += sum(rates[rule] for (_, rule), cut in chosen.items() if cut <= 20) > g.risk
    assert over <= 5


def test_bad_documents_fall_and_good_ones_stay(docs_of, labels_of):
    docs = [(i, make_text(i, 60) if i % 6 else " ".join(w + " #" for w in make_text(i, 60).split())) for i in range(6000)]
    labels = [(i, int(i % 6 != 0), 0) for i in range(6000)] + [(None, 1, 0), (1, None, None)]
    got = {r["doc_id"]: r["kept"] for r in rules.judge(docs_of(docs), labels_of(labels)).collect()}
    assert all(got[i] == bool(i % 6) for i in got)
