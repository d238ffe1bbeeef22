import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import collisions


def exact(ids, x, k):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(1)
        keep = np.flatnonzero(ids != ids[i])
        order = keep[np.lexsort((ids[keep], -s[keep]))][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row], 1.0, 0) for i, row in zip(ids, x)], "vec_id long, embedding array<float>, score double, block int")


def test_recall_and_scores(spark):
    r = np.random.default_rng(4)
    x = np.concatenate([r.standard_normal((900, 24)), np.tile(r.standard_normal(24), (60, 1))]).astype(np.float32).astype(float)  # all lengths differ, but for the copies
    ids = np.arange(960)
    got = {}
    for row in collisions.nearest(frame(spark, ids, x), F.col("id") % 20 == 0, 20, collisions.Settings(block=300, group=20)).orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
    want = exact(ids, x, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    found = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want])
    assert found >= 0.9
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda p: (-p[1], p[0]))
        assert all(abs(s - (x[v] * x[q]).sum()) < 1e-12 for v, s in rows)
    # Equal vectors are ties, nearest to their copies, by smaller ids.
    assert [v for v, _ in got[900]] == [v for v in range(901, 921)]


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [2.0, 1.0]), (7, [2.0, 1.0]), (8, [1.0, 1.0, 1.0]), (20, [-1.0, 0.5])]
    got = collisions.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 6, 2.0), (0, 2, 7, 2.0), (0, 3, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 6, -1.5), (20, 3, 7, -1.5)]
    assert collisions.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 20 == 0).collect() == []


def vectors(kind, n, dim=48):
    r = np.random.default_rng(9)
    x = r.standard_normal((n, dim))
    x /= np.sqrt((x * x).sum(1))[:, None]
    if kind == "uniform":
        x *= r.uniform(0, 1, n)[:, None]
    elif kind == "lognormal":
        x *= np.exp(r.standard_normal(n))[:, None]
    elif kind == "outlier":
        x[7] *= 50
    elif kind == "hot copies":
        x[100 : n // 2] = x[100]
    elif kind == "noisy copies":
        x[n // 4 :] = x[r.integers(0, n // 4, n - n // 4)] + 0.02 * r.standard_normal((n - n // 4, dim))
    return x


KINDS = ["unit", "uniform", "lognormal", "outlier", "hot copies", "noisy copies"]


@pytest.mark.parametrize("kind", KINDS)
def test_method_decides(kind):
    """Candidates are a small part of a block, a smaller one of a larger block, and hold the neighbours."""
    share = {}
    for n in (1500, 6000):
        x, ids = vectors(kind, n), np.arange(n)
        asked = ids % 20 == 0
        query, found, _, verified = collisions.search_block(ids, x, ids[asked], x[asked], 20, collisions.Settings())
        want = exact(ids, x, 20)
        recall = np.mean([len(set(found[query == q].tolist()) & {v for v, _ in want[q]}) / 20 for q in want])
        assert recall >= 0.95
        share[n] = verified.mean() / n
    assert share[6000] < 0.3 and share[6000] < share[1500] < 0.6


@pytest.mark.parametrize("kind", KINDS)
def test_recall_over_blocks_and_groups(spark, kind):
    x = vectors(kind, 2400)
    got = {}
    rows = collisions.nearest(frame(spark, range(2400), x), F.col("id") % 20 == 0, 20, collisions.Settings(block=800, group=60)).collect()
    for row in rows:
        got.setdefault(row["query_id"], set()).add(row["vec_id"])
    want = exact(np.arange(2400), x.astype(np.float32).astype(float), 20)
    assert np.mean([len(got[q] & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9
