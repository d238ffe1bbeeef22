from collections import Counter, defaultdict

import pytest

from seriesloom.llm import mixing
from tests.llm.conftest import make_text


def targets_by_hand(sizes, most=3):
    """Shares by weight, stopped and shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in rest)
        share = {s: weight[s] * left / w for s in rest}
        over = [s for s in rest if share[s] >= most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}
        if len(fixed) == len(order):
            return fixed


def check(rows, source_of):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        s = source_of[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    want = targets_by_hand(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
    return sizes, taken, target


def test_targets_and_words(docs_of):
    names = ["b", "a", None, "", "é", "z", "Z"]
    rows = [(i, make_text(i, 5 + i * 7 % 90), names[min(i % 11, 6)]) for i in range(1500)] + [(5000, None, "b"), (5001, "", "only empty")]
    docs = docs_of(rows)
    first = mixing.mix(docs).collect()
    sizes, taken, target = check(first, {r[0]: r[2] for r in rows})
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 1, s
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter(first) == Counter(again)  # reruns agree, whatever the partitions


def test_odd_rows_and_small_sources(docs_of, odd_rows):
    rows = odd_rows + [(50, "tiny text", "tiny"), (None, None, None)]
    out = mixing.mix(docs_of(rows)).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len((r[1] or "").replace(" ", "_").split())
    want = targets_by_hand(dict(sizes))
    assert sorted({round(r["target"], 6) for r in out}) == sorted({round(x, 6) for x in want.values()})
    assert mixing.mix(docs_of([])).collect() == []


def test_draws_are_fair(docs_of):
    """Over many documents of one size, copies come near their expectation and are whole."""
    rows = [(i, "w " * 10, "a" if i < 900 else "b") for i in range(1200)]
    out = mixing.mix(docs_of(rows)).collect()
    copies = [r["copies"] for r in out if r["doc_id"] < 900]
    assert set(copies) <= {0, 1} and abs(sum(copies) * 10 - 4000) <= 10


def test_repeated_documents(docs_of):
    docs = docs_of([(i, make_text(i, 20), "ab"[i % 2]) for i in range(40)] + [(0, make_text(0, 20), "a"), (None, "no id", None)])
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    copies = Counter(out.collect())
    assert set(copies) <= set(docs.collect()) and max(copies.values()) <= 6
