"""Nearest neighbours by inner product with collision-counting hashing.

Every hash is one projection, kept as a sorted array. A query opens a window around its own
projection in each array and widens all of them (virtual rehashing: wider buckets from the same
arrays); a vector's collisions are the windows it lies in. They are counted from the inside or from
the outside of the windows, whichever holds fewer entries. Vectors that reach the collision threshold
are candidates, and only their inner products are computed: in double precision, on the original
vectors. Windows are widened to the k-th nearest distance found so far, divided by ``reach``; there
the search of a query ends.

``reach`` is calibrated for each band: at most ``Settings.sample`` of the queries are solved exactly
against the band, and the widest window is taken for which the lower bound (one-sided 95%, over
queries) of the share of true neighbours that collide often enough is at least ``Settings.recall``.
If the sample can't show that, a bound holds instead: a vector nearer than the distance misses the
threshold with a chance of ``Settings.miss`` at most (of 0 below 16 dimensions, where squared
projections are summed). No switch on a share of the band computes all products.

Inner products are turned into distances within bands of stored vectors of nearly one length: with M
the largest of the band, stored vectors get one more coordinate, sqrt(M^2 - |x|^2), and queries are
scaled to length M, which does not change their order. Bands are searched from the longest vectors on;
those too short to beat the k-th best product are not. Directions are drawn in orthogonal sets.

Vectors are spread over blocks of about ``Settings.block`` by a hash of their id, and queries over groups;
each block meets each group once, in a task that holds both, and the best of all blocks are merged.

Defined cases: vectors that are null or zero, hold null or non-finite components, or have no id take
no part. Rows of one id count once (the smallest vector). Vectors of different lengths never meet.
Ties go to the smaller id. A query with fewer candidates returns them all. Of equal vectors in a block
only the ``k + 1`` smallest ids are searched: the others can be among no query's best ``k``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from seriesloom.session import materialize


@dataclass(frozen=True)
class Settings:
    hashes: int = 64
    threshold: float = 0.9  # collisions of a candidate, in hashes
    recall: float = 0.95  # of true neighbours, at the lower confidence bound
    sample: int = 64  # queries solved exactly for it, in each band of a block and a group
    miss: float = 1e-3  # chance of a missed vector, where the sample shows too little
    band: float = 1.25  # largest by smallest length of a band, if it has ``band_least`` vectors
    band_least: int = 64
    widen: float = 1.15  # while fewer than k are found
    block: int = 8192
    group: int = 4096
    chunk: int = 256  # queries that are counted in one go
    seed: int = 11


def directions(dim: int, s: Settings) -> np.ndarray:
    """``s.hashes`` directions of length sqrt(dim), in sets of ``dim`` orthogonal ones."""
    rng = np.random.default_rng(s.seed)
    sets = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-s.hashes // dim))]
    return np.concatenate(sets, axis=1)[:, : s.hashes] * math.sqrt(dim)


def least_distance(dim: int, s: Settings) -> float:
    """By this times the half width of the windows, vectors that are not candidates are away at least, but for ``s.miss``."""
    m, needed = s.hashes, math.ceil(s.threshold * s.hashes)
    if dim < 16:  # squared projections on one orthogonal set add up to at most dim times the squared distance
        return math.sqrt((m - needed + 1) / (-(-m // dim) * dim))
    low, high = 0.0, 1.0  # chance of one collision
    for _ in range(60):
        p = (low + high) / 2
        missed = sum(math.comb(m, c) * p**c * (1 - p) ** (m - c) for c in range(needed))
        low, high = (p, high) if missed > s.miss else (low, p)
    return 1 / NormalDist().inv_cdf((1 + min(high, 1 - 1e-12)) / 2)


class Band:
    """Stored vectors of nearly one length, the longest ``longest``, as sorted projections."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, longest: float, axes: np.ndarray, s: Settings):
        self.rows, self.x, self.longest, self.axes = rows, x, longest, axes
        self.needed = math.ceil(s.threshold * s.hashes)
        more = np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0))
        self.projected = (x @ axes[:-1] + more[:, None] * axes[-1]).T
        self.order = np.argsort(self.projected, axis=1, kind="stable")
        self.arrays = np.take_along_axis(self.projected, self.order, 1)

    def own(self, units: np.ndarray) -> np.ndarray:
        """Projections of queries of length one, scaled to ``longest``: a row for each hash."""
        return self.longest * (units @ self.axes[:-1]).T

    def distance(self, cosine: np.ndarray) -> np.ndarray:
        """Of vectors that have the product ``cosine`` with a query of length one."""
        return np.sqrt(np.maximum(2 * self.longest * (self.longest - cosine), 0))

    def calibrate(self, units: np.ndarray, ids: np.ndarray, unit_ids: np.ndarray, k: int, s: Settings) -> None:
        """Set ``reach`` and the first half width from queries solved exactly."""
        known = units @ self.x.T
        known[unit_ids[:, None] == ids[self.rows][None, :]] = -np.inf
        top = np.argsort(-known, axis=1, kind="stable")[:, :k]
        away = self.distance(np.take_along_axis(known, top, 1))
        own = self.own(units).T
        ratios = []  # for each query: half widths at which its neighbours are candidates, by their distance
        for i in range(len(units)):
            real = np.isfinite(away[i]) & (away[i] > 1e-6 * self.longest)
            if real.any():
                apart = np.abs(self.projected[:, top[i][real]] - own[i][:, None])
                ratios.append(np.partition(apart, self.needed - 1, axis=0)[self.needed - 1] / away[i][real])
        self.reach = least_distance(len(self.axes), s)
        if len(ratios) >= 16:
            tried = np.sort(np.concatenate(ratios))
            low, high = 0, len(tried)  # the least ratio that suffices
            while low < high:
                middle = (low + high) // 2
                hit = np.array([np.count_nonzero(r <= tried[middle]) / len(r) for r in ratios])
                # The sample's own spread and that of a count of misses, whichever is larger.
                spread = max(hit.std(ddof=1), math.sqrt(max(hit.mean() * (1 - hit.mean()), 1 / len(hit)) / min(map(len, ratios))))
                if hit.mean() - 1.645 * spread / math.sqrt(len(hit)) >= s.recall:
                    high = middle
                else:
                    low = middle + 1
            if low < len(tried):
                self.reach = max(self.reach, 1 / tried[low])
        last = away[:, -1][np.isfinite(away[:, -1])]
        self.first = max(float(np.quantile(last, 0.1)) if len(last) else 0.0, 1e-6 * self.longest) / self.reach

    def count(self, own: np.ndarray, width: np.ndarray) -> Iterator[np.ndarray]:
        """Collisions of all vectors for each of some queries, with half widths of their own."""
        low = np.array([np.searchsorted(a, o - width, "left") for a, o in zip(self.arrays, own)])
        high = np.array([np.searchsorted(a, o + width, "right") for a, o in zip(self.arrays, own)])
        hashes, n = self.arrays.shape
        inside = 2 * (high - low).sum(0) <= hashes * n
        for i in range(own.shape[1]):
            a, b = low[:, i].tolist(), high[:, i].tolist()
            if inside[i]:
                yield np.bincount(np.concatenate([self.order[h, a[h] : b[h]] for h in range(hashes)]), minlength=n)
            else:
                out = [self.order[h, : a[h]] for h in range(hashes)] + [self.order[h, b[h] :] for h in range(hashes)]
                yield hashes - np.bincount(np.concatenate(out), minlength=n)


def bands(lengths: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Positions of the vectors of each band, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    ordered, out, a = -lengths[order], [], 0
    while a < len(order):
        b = max(int(np.searchsorted(ordered, ordered[a] / s.band, "right")), a + s.band_least)
        out.append(order[a:b])
        a = b
    return out


def distinct_enough(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k + 1`` smallest ids of each set of equal vectors."""
    _, kind = np.unique(x, axis=0, return_inverse=True)
    order = np.lexsort((ids, kind.ravel()))
    kind = kind.ravel()[order]
    nth = np.arange(len(kind)) - np.searchsorted(kind, kind, "left")
    return np.sort(order[nth <= k])


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, s: Settings):
    """(query, id, score) of the best ``k`` of a block for each query, ties to smaller ids; and the products each query took."""
    kept = distinct_enough(ids, x, k)
    ids, x = ids[kept], x[kept]
    axes = directions(x.shape[1] + 1, s)
    # Divided by the largest component first: squares of components neither overflow nor vanish.
    scale = np.abs(x).max() or 1.0
    near = x / scale
    lengths = np.sqrt((near * near).sum(1))
    units = q / np.abs(q).max(1)[:, None]
    units = units / np.sqrt((units * units).sum(1))[:, None]
    query_lengths = (q * units).sum(1) * scale
    probe = np.unique(np.linspace(0, len(q) - 1, min(s.sample, len(q))).astype(int))
    best = [np.zeros(0, np.int64)] * len(q)
    scores = [np.zeros(0)] * len(q)
    verified = np.zeros(len(q), np.int64)

    def take(i: int, found: np.ndarray, longest: float) -> None:
        verified[i] += len(found)
        found = found[ids[found] != query_ids[i]]
        if len(best[i]) + len(found) > k:  # rounded products first; those far from the best need no exact one
            rough = near[found] @ units[i] * query_lengths[i]
            floor = scores[i][-1] if len(best[i]) == k else np.partition(rough, -(k - len(best[i])))[-(k - len(best[i]))] if not len(best[i]) else -np.inf
            found = found[rough >= floor - 1e-9 * query_lengths[i] * longest]
        rows, products = np.concatenate([best[i], found]), np.concatenate([scores[i], (x[found] * q[i]).sum(1)])  # row by row, so equal vectors score equal
        top = np.lexsort((ids[rows], -products))[:k]
        best[i], scores[i] = rows[top], products[top]

    for rows in bands(lengths, s):
        longest = lengths[rows[0]] * (1 + 1e-9)
        # Nothing here or in shorter bands can be better for the queries left out.
        active = np.array([i for i in range(len(q)) if len(best[i]) < k or scores[i][-1] <= query_lengths[i] * longest], np.int64)
        if not len(active):
            break
        band = Band(rows, near[rows], longest, axes, s)
        band.calibrate(units[probe], ids, query_ids[probe], k, s)
        farthest = float(np.abs(band.arrays).max() + np.abs(band.own(units[active])).max())

        def target(i: int) -> float:
            """Half width up to which the k-th best product so far sends this query."""
            return float(band.distance(scores[i][-1] / query_lengths[i])) / band.reach if len(best[i]) == k else math.inf

        for a in range(0, len(active), s.chunk):
            todo = active[a : a + s.chunk]
            own = band.own(units[todo])
            width = np.array([min(band.first, target(i)) if len(best[i]) == k else band.first for i in todo])
            done = np.zeros((len(todo), len(rows)), bool)
            going = np.arange(len(todo))
            while len(going):
                for j, count in zip(going, band.count(own[:, going], width[going])):
                    new = (count >= band.needed) & ~done[j]
                    done[j] |= new
                    if new.any():
                        take(todo[j], rows[new], longest)
                wanted = np.array([min(target(todo[j]), farthest * s.widen) for j in going])
                on = wanted > width[going]
                # Without k vectors yet, step by step; then at once to the width that the k-th best asks for.
                enough = np.array([len(best[todo[j]]) == k for j in going])
                width[going] = np.where(on, np.where(enough, wanted, np.minimum(wanted, width[going] * s.widen)), width[going])
                going = going[on]
    return (np.repeat(query_ids, [len(r) for r in best]), ids[np.concatenate(best)] if len(q) else ids[:0], np.concatenate(scores) if len(q) else np.zeros(0), verified)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(id, x, dim) of the vectors that take part, one row for each id."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & F.col("x").isNotNull())
    rows = rows.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0))
    return rows.groupBy("id").agg(F.min("x").alias("x")).withColumn("dim", F.size("x"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, s: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for each query; ``is_query``: condition on ``id``."""
    rows = materialize(usable(vectors), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).head()
    blocks, groups = max(1, math.ceil(n / s.block)), max(1, math.ceil(n_queries / s.group))
    keyed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    stored = keyed.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = rows.filter(is_query).withColumn("group", F.pmod(F.xxhash64(F.lit("query"), "id"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        t = t.combine_chunks()
        x = t.column("x").combine_chunks()
        x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
        return t.column("id").to_numpy(), x.flatten().to_numpy().reshape(t.num_rows, -1)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            query, found, score, _ = search_block(*matrix(left), *matrix(right), k, s)
        else:
            query, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table({"query_id": query, "vec_id": found, "score": score})

    by = ["dim", "block", "group"]
    found = stored.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
