import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import suffix_tree
from seriesloom.llm.words import Words


def sentences(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = ["start"]
        while len(words) < 30:
            words.append({"start": "red", "red": "fox"}.get(words[-1]) or r.choice(["start", "red", "dog", f"rare{r.randint(0, 400)}"]))
        out.append((i, " ".join(words)))
    return out


def split(text):
    return (text or "").encode().lower().split() + [None]


@pytest.fixture(scope="module")
def result(docs_of, odd_rows):
    rows = sentences(300, 1) + [(1000 + (r[0] or 0), r[1]) for r in odd_rows]
    docs = docs_of(rows)
    settings = suffix_tree.Settings(head_share=0.001, word_share=0.002, context_share=0.01, entry_share=0.001)
    held_out = F.col("doc_id") % 3 == 0
    tree, unigrams = suffix_tree.grow(docs.filter(~held_out), settings)
    return rows, tree, suffix_tree.score_texts(docs, tree, unigrams, held_out).collect()


def test_base_by_brute_force(result):
    rows, tree, got = result
    counts = Counter(w for i, t in rows if i % 3 for w in split(t))
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, t in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in split(t))
        want.setdefault(i, []).append((len(split(t)), sum(counts[w] > 0 for w in split(t)), base))
    for r in got:
        tokens, known, base = want[r["doc_id"]][0]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_model_beats_the_base_on_held_out_text(result):
    _, tree, got = result
    held = [r for r in got if r["held_out"] and r["doc_id"] < 300]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.97
    assert len(tree.keys1) and (tree.rest1 > 0).all() and (tree.rest1 <= 1).all()


def test_states_are_distributions(result):
    """In every state, what the known words get and what is left for the rest adds up to 1."""
    _, m, _ = result
    for s in np.flatnonzero(m.rest1 < 1):
        own = (m.keys1 >> suffix_tree.SHIFT) == s
        assert m.shares1[own].sum() + m.rest1[s] == pytest.approx(1)
    for s in range(len(m.pairs)):
        own = (m.keys2 >> suffix_tree.SHIFT) == s
        assert m.shares2[own].sum() + m.rest2[s] == pytest.approx(1)


def test_longest_suffix_is_used(result):
    _, m, _ = result
    data = np.frombuffer(b"start red fox", np.uint8)
    t, text = suffix_tree.tokens(Words(data, np.array([0, len(data)])))
    count, base, score = suffix_tree.token_scores(m, t, text)
    ids = suffix_tree.find(m.words, t)
    root = (m.head_counts[suffix_tree.find(m.head, t)] + 1) / (m.tokens + m.kinds + 1)
    at = suffix_tree.find(m.keys1, np.array([(ids[0] << suffix_tree.SHIFT) | ids[1]]))[0]
    p1 = (m.shares1[at] if at >= 0 else 0) + m.rest1[ids[0]] * root[1]
    assert score[0] == pytest.approx(math.log10(root[0])) and score[1] == pytest.approx(math.log10(p1)) and score[1] > base[1] + 0.3


def test_no_training_texts(docs_of):
    docs = docs_of([(1, "a b"), (2, None), (None, "")])
    tree, unigrams = suffix_tree.grow(docs.filter("false"))
    got = suffix_tree.score_texts(docs, tree, unigrams, F.lit(True)).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 3] and {r["base_score"] for r in got} == {r["score"] for r in got} == {0.0}
    assert suffix_tree.score_texts(docs.filter("false"), tree, unigrams, F.lit(True)).collect() == []


def by_loops(training, texts, s, deepest):
    """Score of each text by a tree that is grown in plain loops, and the number of states of each depth."""
    counts = [Counter() for _ in range(deepest + 2)]
    for t in training:
        w = tuple(split(t))
        for k in range(1, deepest + 2):
            counts[k].update(w[i : i + k] for i in range(len(w) - k + 1))
    n, v = sum(counts[1].values()), len(counts[1])
    states, sizes = {}, []

    def probability(context, word):
        if not context:
            return (counts[1][(word,)] + 1) / (n + v + 1)
        lower = probability(context[1:], word)
        if context not in states:
            return lower
        shares, rest = states[context]
        return shares.get(word, 0.0) + rest * lower

    for d in range(1, deepest + 1):
        following = {}
        for gram, c in counts[d + 1].items():
            if c >= s.least:
                following.setdefault(gram[:-1], {})[gram[-1]] = c
        fresh = {}
        for context, words in following.items():
            total, seen = counts[d][context], sum(words.values())
            lower = {w: probability(context[1:], w) for w in words}
            gain = sum(c * math.log(c / total / lower[w]) for w, c in words.items())
            if total > seen:
                gain += (total - seen) * math.log((total - seen) / total / max(1 - sum(lower.values()), 1e-12))
            if gain > 0.5 * len(words) * math.log(total):
                fresh[context] = {w: (c - s.discount) / total for w, c in words.items()}, 1 - (seen - s.discount * len(words)) / total
        if not fresh:
            break
        states |= fresh
        sizes.append(len(fresh))
    out = []
    for t in texts:
        w = split(t)
        out.append(sum(math.log10(probability(tuple(w[max(0, i - len(sizes)) : i]), w[i])) for i in range(len(w))))
    return out, sizes


def phrases(n, seed):
    r = random.Random(seed)
    lines = ["one small step for a man", "two small step for a horse", "the step for a man is small", "a horse is a horse"]
    return [" ".join(r.choice(lines) if r.random() < 0.5 else f"w{r.randint(0, 300)}" for _ in range(12)) for _ in range(n)]


@pytest.mark.parametrize("deepest", [2])
def test_scores_by_brute_force(docs_of, deepest):
    """Whatever the head and the bits hold, the tables give the same tree."""
    texts = phrases(120, 3) + ["", None]
    docs = docs_of(list(enumerate(texts)))
    settings = suffix_tree.Settings(head_share=0.02, entry_share=0.01, least=4, bits=15)
    held_out = F.col("doc_id") % 4 == 0
    tree, unigrams = suffix_tree.grow(docs.filter(~held_out), settings)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(docs, tree, unigrams, held_out).collect()}
    want, sizes = by_loops([t for i, t in enumerate(texts) if i % 4], texts, settings, deepest)
    assert tree.depth == len(sizes)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-9)


def test_states_stay_when_the_corpus_grows(docs_of):
    """A context seen 40 times is a state, however many other tokens there are."""
    rare = [f"f{i} open sesame now" for i in range(40)]
    for others in (20, 400):
        r = random.Random(7)
        texts = rare + [" ".join(f"u{r.randint(0, 50)}" for _ in range(500)) for _ in range(others)]
        docs = docs_of(list(enumerate(texts)))
        tree, unigrams = suffix_tree.grow(docs, suffix_tree.Settings(context_share=0.01, entry_share=0.01, word_share=0.01))
        got = {r["doc_id"]: r for r in suffix_tree.score_texts(docs.filter("doc_id < 40"), tree, unigrams, F.lit(False)).collect()}
        assert all(r["score"] > r["base_score"] + 3 for r in got.values())


def test_parts_are_scored_in_turns(docs_of, monkeypatch):
    """Only one turn's asks, answers and texts are on disk at once; each row is scored in one of them, as if alone."""
    monkeypatch.setattr(suffix_tree, "PART", 2)
    monkeypatch.setattr(suffix_tree, "WAVE_PARTS", 1)
    turns, write = [], suffix_tree.materialize
    monkeypatch.setattr(suffix_tree, "materialize", lambda df, name: turns.append((name, write(df, name))) or turns[-1][1])
    texts = phrases(120, 5) + ["", None, "one small step"]
    docs = docs_of(list(enumerate(texts)))
    settings = suffix_tree.Settings(head_share=0.02, entry_share=0.01, least=4, bits=15)
    tree, unigrams = suffix_tree.grow(docs, settings)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(docs, tree, unigrams, F.lit(False)).collect()}
    want, _ = by_loops(texts, texts, settings, tree.depth)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-9)
    sizes = [df.count() for name, df in turns if name == "tree-scores"]
    assert len(sizes) == suffix_tree.WAVES and sum(sizes) == len(texts) and max(sizes) < len(texts)


def test_n_grams_travel_packed():
    """One row for a range of hashes, not one for an n-gram."""
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 50_000, dtype=np.uint64) * np.uint64(2))
    batches = list(suffix_tree.packed(suffix_tree.ranges_of(keys, 6), 6, {"key": keys, "n": np.arange(len(keys))}, part=7))
    rows = [r for b in batches for r in b.to_pylist()]
    assert [r["range"] for r in rows] == list(range(64)) and {r["part"] for r in rows} == {7}
    assert (np.frombuffer(b"".join(r["key"] for r in rows), np.uint64) == keys).all()
    assert (np.frombuffer(b"".join(r["n"] for r in rows), np.int64) == np.arange(len(keys))).all()
    assert list(suffix_tree.packed(np.zeros(0, int), 6, {"key": keys[:0]})) == []
