import random
from collections import Counter

import numpy as np
import pytest

from seriesloom.llm import jaccard
from seriesloom.llm.components import components
from tests.llm.conftest import make_text


def sets_of(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)] if w else [])


def by_hand(rows, width, over, under):
    sets = [sets_of(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and under * both >= over * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            first[find(i)] = min(first.get(find(i), r[0]), r[0])
    return Counter((r[0], len(s), (first.get(find(i)) if s else r[0])) for i, (r, s) in enumerate(zip(rows, sets)))


def edited(seed, base, n):
    r = random.Random(seed)
    words = base.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randint(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("width,over,under", [(3, 90, 100), (5, 80, 100)])
def test_components_by_brute_force(docs_of, odd_rows, width, over, under):
    base = [make_text(1000 + i, n) for i, n in enumerate((12, 25, 60, 150, 400))]
    rows = list(odd_rows)
    for k, b in enumerate(base):
        rows += [(100 + 100 * k + i, edited(i, b, i % 7)) for i in range(40)]
    rows += [(900 + i, make_text(i, 3 + i % 9)) for i in range(60)]
    got = jaccard.near_duplicates(docs_of(rows), width, over, under).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_hand(rows, width, over, under)


def test_large_components_are_cut_into_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 600)
    base = make_text(5, 150)
    rows = [(i, edited(i, base, i % 6)) for i in range(60)]
    got = jaccard.near_duplicates(docs_of(rows), 3, 90, 100).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_hand(rows, 3, 90, 100)


def test_chains_of_false_candidates_send_each_set_a_few_times(docs_of, monkeypatch):
    """Windows over one long text: neighbours share signatures, but only a few are linked."""
    words = make_text(6, 3200).split()
    rows = [(i, " ".join(words[10 * i : 10 * i + 60])) for i in range(300)]
    rows += [(1000 + i, edited(i, rows[i][1], 1)) for i in range(0, 300, 10)]
    sent = []

    def verified(grouped, over, under, old=jaccard._verified):
        sent.append(grouped.count())
        return old(grouped, over, under)

    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 600)
    monkeypatch.setattr(jaccard, "_verified", verified)
    got = jaccard.near_duplicates(docs_of(rows), 5, 80, 100).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == by_hand(rows, 5, 80, 100)
    assert sent[0] <= 5 * len(rows)


@pytest.mark.parametrize("across", [False, True])
def test_linked_sets_of_one_task(across):
    r = np.random.default_rng(3)
    sets = []
    for n in (1, 2, 9, 30, 90, 400):
        base = r.integers(0, 2**63, n).astype(np.uint64)
        sets += [np.unique(np.where(r.random(n) < share, r.integers(0, 2**63, n).astype(np.uint64), base)[: n - cut]) for share in (0, 0.05, 0.1, 0.5) for cut in (0, n // 20, n // 8)]
    sets = sorted((x for x in sets if len(x)), key=len)
    side = r.integers(0, 2, len(sets)) if across else np.zeros(len(sets), int)

    def joined(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            root = [root[a] if x == root[b] else x for x in root]
        return [root.index(x) for x in root]

    close = [(a, b) for b in range(len(sets)) for a in range(b) if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])) and (not across or side[a] != side[b])]
    found = jaccard.linked(sets, side, 4, 5)
    assert set(found) <= set(close) and joined(found) == joined(close) != list(range(len(sets)))


def test_texts_move_once(spark, docs_of, odd_rows):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.representatives(docs_of(odd_rows))
        assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # of texts, of those chosen
        assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, None, 4, 6, 7, 9, 20])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_schemes_meet_every_linked_pair():
    """For any two sets with enough in common, some signature is shared, whatever the costs chose."""
    r = np.random.default_rng(2)
    for over, under in ((9, 10), (8, 10)):
        bands = jaccard.band_starts(400, over, under)
        for docs in (10, 10**6, 10**10):
            schemes = [jaccard.allocate(-(-int(a) * over // under), int(b) - 1, docs, over, under) for a, b in zip(bands, [*bands[1:], bands[-1] + 1])]
            for n in (10, 17, 40, 120, 399):
                for _ in range(20):
                    one = r.integers(0, 2**63, n).astype(np.uint64)
                    two = one.copy()
                    while True:  # change n-grams while the pair stays linked
                        more = two.copy()
                        more[r.integers(n)] = r.integers(0, 2**63)
                        both = len(np.intersect1d(one, more))
                        if under * both < over * (2 * n - both):
                            break
                        two = more
                    if (np.sort(one) == np.sort(two)).all():
                        continue
                    grams = np.concatenate([np.sort(one), np.sort(two)])
                    sig, text = jaccard.signatures(grams, np.array([0, n, 2 * n]), bands, schemes, over, under)
                    assert set(sig[text == 0].tolist()) & set(sig[text == 1].tolist()), (docs, n)


def test_costs_choose_double_segments_for_many_small_sets():
    assert jaccard.allocate(5, 9, 1000, 90, 100) is None  # linked sets this small are equal
    assert jaccard.allocate(18, 20, 1000, 90, 100).doubles == 0
    assert jaccard.allocate(10, 11, 10**10, 90, 100).doubles > 0


def test_representatives(docs_of, odd_rows):
    docs = docs_of([*odd_rows, (10, make_text(4, 80), "z")])
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    # 4 (twice), 5, 10 and 21 are one group; 7 and 8 are alike in lower case; texts without words stay.
    assert ids == Counter([1, 2, 3, None, 4, 6, 7, 9, 20])
    assert jaccard.representatives(docs_of([])).collect() == []
    assert jaccard.near_duplicates(docs_of([])).collect() == []


def test_connected_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + r.randint(0, 50), 100 + r.randint(0, 50)) for _ in range(60)] + [(500, i) for i in range(501, 620)] + [(7, 7)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
