"""Simple and Holt exponential smoothing with an estimated start.

With fixed smoothing weights the one-step forecasts are linear in the unknown start, so its least
squares estimate is closed form, for every prefix of a series at once.  The state after a chunk is
an affine map of the state before it: chunks are folded in parallel from a zero start, and a scan
over one summary row per chunk joins them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from ..operators.layout import attach, chunk_rows, tag_chunk
from ..session import materialize
from .blocks import chunk_runs, origin_marks, padded, params_column, pieces, series_blocks

# Default weights.
ALPHA = 0.2
BETA = 0.1
# Chunks that one scan group holds.
FAN = 512

_STATS = "k string, chunk long, n long, mean double, pos long, is_end boolean, is_origin boolean, stats array<double>"
_CARRY = "k string, grp long, turn long, carry array<double>, after array<double>"
_STATES = ("k string, chunk long, n long, mean double, pos long, is_end boolean, is_origin boolean, cand int, start array<double>, "
           "state array<double>, sse double, resid_mean double, entry array<double>")


def _split(s: np.ndarray, dim: int):
    """Fields of a summary, last axis: Σr, Σr², Σrg, Σg, Σgg', offset and matrix of the state map.

    r is the one-step error from a zero start, g its (negative) derivative by the start.
    """
    d2 = dim * dim
    cuts = np.cumsum([1, 1, dim, dim, d2, dim, d2])[:-1]
    sr, srr, srg, sg, sgg, off, phi = np.split(s, cuts, axis=-1)
    square = (*s.shape[:-1], dim, dim)
    return sr[..., 0], srr[..., 0], srg, sg, sgg.reshape(square), off, phi.reshape(square)


def _times(m: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (m @ x[..., None])[..., 0]


def _compose(first: np.ndarray, then: np.ndarray, dim: int) -> np.ndarray:
    """Summary of two adjoining stretches of a series (an associative operation)."""
    sr, srr, srg, sg, sgg, off, phi = _split(first, dim)
    n_sr, n_srr, n_srg, n_sg, n_sgg, n_off, n_phi = _split(then, dim)
    back = np.swapaxes(phi, -1, -2)
    pulled = n_srg - _times(n_sgg, off)
    flat = (*first.shape[:-1], dim * dim)
    return np.concatenate([
        (sr + n_sr - (n_sg * off).sum(-1))[..., None],
        (srr + n_srr - ((n_srg + pulled) * off).sum(-1))[..., None],
        srg + _times(back, pulled), sg + _times(back, n_sg), (sgg + back @ n_sgg @ phi).reshape(flat),
        n_off + _times(n_phi, off), (n_phi @ phi).reshape(flat)], axis=-1)


def _identity(cands: int, dim: int) -> np.ndarray:
    return np.tile(np.concatenate([np.zeros(2 + 3 * dim + dim * dim), np.eye(dim).ravel()]), (cands, 1))


def _fold_chunks(dim: int, rows: int):
    """Per chunk and candidate: sums and maps of the recursion started from zero."""

    def run(batches):
        for pdf in batches:
            for part in pieces(pdf, 8 * len(pdf["params"].iloc[0]) if len(pdf) else 1):
                y, size = padded([np.asarray(a) - m for a, m in zip(part["y"], part["mean"])])
                par = np.array([np.vstack(p) for p in part["params"]])
                a = par[:, :, 0]
                ab = a * par[:, :, 1] if dim == 2 else None
                shape = a.shape
                z, u = np.zeros((dim, *shape)), np.zeros((dim, dim, *shape))
                for d in range(dim):
                    u[d, d] = 1.0
                sr, srr = np.zeros(shape), np.zeros(shape)
                srg, sg, sgg = np.zeros((dim, *shape)), np.zeros((dim, *shape)), np.zeros((dim, dim, *shape))
                wanted: dict[int, list[int]] = {}
                for r, (marks, n) in enumerate(zip(part["marks"], size)):
                    for p in sorted({*(int(x) for x in marks), int(n)}):
                        wanted.setdefault(p, []).append(r)
                out = []
                for t in range(y.shape[1]):
                    f, g = z.sum(0), u.sum(0)
                    r = y[:, t, None] - f
                    sr += r
                    srr += r * r
                    srg += r * g
                    sg += g
                    sgg += g[:, None] * g[None, :]
                    z[0], u[0] = f + a * r, g - a * g
                    if dim == 2:
                        z[1] += ab * r
                        u[1] -= ab * g
                    rows_here = wanted.get(t + 1)
                    if rows_here:
                        full = np.concatenate([sr[None], srr[None], srg, sg, sgg.reshape(-1, *shape), z, u.reshape(-1, *shape)])
                        got = np.moveaxis(full[:, rows_here], 0, -1)
                        out += [(q, t + 1, got[j].ravel()) for j, q in enumerate(rows_here)]
                idx = [o[0] for o in out]
                local = np.array([o[1] for o in out])
                marks = part["marks"].tolist()
                yield pd.DataFrame({
                    **{c: part[c].to_numpy()[idx] for c in ("k", "chunk", "n", "mean")},
                    "pos": part["chunk"].to_numpy()[idx] * rows + local, "is_end": size[idx] == local,
                    "is_origin": [int(p) in set(map(int, marks[q])) for q, p in zip(idx, local)],
                    "stats": [o[2] for o in out],
                })

    return run


def _scan(dim: int):
    """Summary of everything before each row of its group, and with it; all groups go side by side."""
    width = 2 + 3 * dim + 2 * dim * dim

    def run(batches):
        before: dict = {}
        for part in chunk_runs(batches, "turn"):
            keys = list(zip(part["k"], part["grp"]))
            stats = np.stack(part["stats"].tolist()).reshape(len(part), -1, width)
            carry = np.stack([before[k] if k in before else _identity(stats.shape[1], dim) for k in keys])
            after = _compose(carry, stats, dim)
            before.update(zip(keys, after))
            flat = (len(part), -1)
            yield part[["k", "grp", "turn"]].assign(carry=list(carry.reshape(flat)), after=list(after.reshape(flat)))

    return run


def _prefixes(ends: DataFrame, dim: int, fan: int) -> DataFrame:
    """``(k, chunk, carry, far)``: what lies before a chunk in its group of ``fan`` chunks, and before the group.

    Composition is associative, so a series with very many chunks is scanned group by group in
    parallel, and only one row per group goes through the scan by series.
    """
    grouped = ends.select("k", F.floor(F.col("chunk") / fan).alias("grp"), F.pmod(F.col("chunk"), F.lit(fan)).alias("turn"), "stats")
    near = grouped.repartition("k", "grp").sortWithinPartitions("turn", "k").mapInPandas(_scan(dim), _CARRY)
    chunk = (F.col("grp") * fan + F.col("turn")).alias("chunk")
    if (ends.agg(F.max("chunk")).first()[0] or 0) < fan:
        return near.select("k", chunk, "carry", F.lit(None).cast("array<double>").alias("far"))
    near = materialize(near, "scan")
    full = near.filter(F.col("turn") == fan - 1).select("k", F.lit(0).cast("long").alias("grp"), F.col("grp").alias("turn"), F.col("after").alias("stats"))
    # the state after group g is the one before group g + 1
    far = full.repartition("k").sortWithinPartitions("turn", "k").mapInPandas(_scan(dim), _CARRY).select(
        "k", (F.col("turn") + 1).alias("grp"), F.col("after").alias("far"))
    return near.join(far, ["k", "grp"], "left").select("k", chunk, "carry", "far")


def _solve_starts(dim: int, least: float | None = None):
    """Least squares start of each prefix, and what follows from it; directions below the share ``least`` of the largest are left at 0."""
    width = 2 + 3 * dim + 2 * dim * dim

    def run(batches):
        for part in batches:
            if not len(part):
                continue
            carry = np.stack(part["carry"].tolist()).reshape(len(part), -1, width)
            none = _identity(carry.shape[1], dim)
            far = np.stack([none if x is None else np.asarray(x).reshape(none.shape) for x in part["far"]])
            carry = _compose(far, carry, dim)
            whole = _compose(carry, np.stack(part["stats"].tolist()).reshape(carry.shape), dim)
            sr, srr, srg, sg, sgg, off, phi = _split(whole, dim)
            pos = part["pos"].to_numpy()
            start = _times(np.linalg.pinv(sgg, least, hermitian=True), srg)
            cands = carry.shape[1]
            rep = np.repeat(np.arange(len(part)), cands)
            flat = lambda x: list(x.reshape(len(rep), -1))
            out = part[["k", "chunk", "n", "mean", "pos", "is_end", "is_origin"]].iloc[rep].reset_index(drop=True)
            yield out.assign(
                cand=np.tile(np.arange(cands), len(part)), start=flat(start), state=flat(off + _times(phi, start)),
                sse=np.maximum(srr - (start * srg).sum(-1), 0.0).ravel(),
                resid_mean=((sr - (sg * start).sum(-1)) / pos[:, None]).ravel(),
                entry=flat(carry[..., -dim - dim * dim:]))

    return run


def affine_states(blocks: DataFrame, dim: int, rows: int, params: Column, marks: Column | None = None, fan: int = FAN) -> DataFrame:
    """Estimated start, state and error sums at the end of each chunk and at each mark.

    ``params`` gives per row an array of candidates (alpha, beta).  Values are centred by the series
    mean, which the recursion passes through unchanged.  Only one row per chunk goes through the
    scans; marks meet their chunk's carry in a join on ``(k, chunk)``.
    """
    none = F.array().cast("array<int>")
    work = blocks.select("k", "chunk", "n", "mean", "y", params.alias("params"), (none if marks is None else marks).alias("marks"))
    folded = materialize(work.mapInPandas(_fold_chunks(dim, rows), _STATS), "folded")
    ends = folded.filter("is_end").select("k", "chunk", "stats")
    return folded.join(_prefixes(ends, dim, fan), ["k", "chunk"]).mapInPandas(_solve_starts(dim), _STATES)


def _final(states: DataFrame) -> DataFrame:
    """State at the end of each series: the chunk end that sits at position ``n``."""
    return states.filter(F.col("is_end") & (F.col("pos") == F.col("n"))).select(
        "k", "cand", "n", "mean", "start", "state", "sse", "resid_mean")


def _dim(model: str) -> int:
    return {"ses": 1, "holt": 2}[model]


def _flat_fit(final: DataFrame, dim: int, *extra: str) -> DataFrame:
    slope = F.col("state")[1] if dim == 2 else F.lit(0.0)
    slope0 = F.col("start")[1] if dim == 2 else F.lit(0.0)
    return final.select(
        "k", "n", "alpha", "beta", (F.col("start")[0] + F.col("mean")).alias("level0"), slope0.alias("trend0"),
        (F.col("state")[0] + F.col("mean")).alias("level"), slope.alias("trend"), "sse", "resid_mean", *extra)


def smoothing_states(df: DataFrame, model: str, alpha: float = ALPHA, beta: float = BETA) -> DataFrame:
    """States for one pair of weights; shared by the fit and the fitted rows."""
    return affine_states(series_blocks(df), _dim(model), chunk_rows(df), params_column([(alpha, beta)]))


def fit_smoothing(df: DataFrame, model: str, alpha: float = ALPHA, beta: float = BETA, states: DataFrame | None = None) -> DataFrame:
    """Fit with given weights: start, final state and squared error, one row per series."""
    dim = _dim(model)
    final = _final(smoothing_states(df, model, alpha, beta) if states is None else states)
    final = final.withColumn("alpha", F.lit(float(alpha))).withColumn("beta", F.lit(float(beta) if dim == 2 else None).cast("double"))
    return _flat_fit(final, dim)


@pandas_udf(ArrayType(DoubleType()))
def _one_step(y: pd.Series, alpha: pd.Series, beta: pd.Series, level: pd.Series, trend: pd.Series) -> pd.Series:
    values, size = padded(y.tolist())
    a, ab = alpha.to_numpy(float), alpha.to_numpy(float) * np.nan_to_num(beta.to_numpy(float))
    lev, tr = level.to_numpy(float).copy(), trend.to_numpy(float).copy()
    out = np.empty_like(values)
    for t in range(values.shape[1]):
        f = lev + tr
        out[:, t] = f
        e = values[:, t] - f
        lev, tr = f + a * e, tr + ab * e
    return pd.Series([out[r, :n] for r, n in enumerate(size)])


def fitted_smoothing(df: DataFrame, model: str, alpha: float = ALPHA, beta: float = BETA, states: DataFrame | None = None,
                     weights: DataFrame | None = None) -> DataFrame:
    """Observed rows with their one-step forecast ``fitted``; ``weights`` gives each series its own ``alpha`` and ``beta``."""
    dim, rows = _dim(model), chunk_rows(df)
    blocks = series_blocks(df, with_time=True)
    own = F.lit(float(alpha)), F.lit(float(beta) if dim == 2 else 0.0)
    if weights is not None:
        blocks = attach(blocks, weights.select("k", F.col("alpha").alias("own_alpha"), F.coalesce("beta", F.lit(0.0)).alias("own_beta")))
        own = F.col("own_alpha"), F.col("own_beta")
        states = materialize(affine_states(blocks, dim, rows, F.array(F.array(*own))), "states")
    states = materialize(smoothing_states(df, model, alpha, beta), "states") if states is None else states
    start = _final(states).select("k", F.col("start").alias("x0"))
    e, x0 = F.col("entry"), F.col("x0")
    if dim == 1:
        level, trend = e[0] + e[1] * x0[0], F.lit(0.0)
    else:
        level, trend = e[0] + e[2] * x0[0] + e[3] * x0[1], e[1] + e[4] * x0[0] + e[5] * x0[1]
    entries = states.filter("is_end").join(start, "k").select("k", "chunk", level.alias("l_in"), trend.alias("b_in"))
    run = blocks.join(entries, ["k", "chunk"]).withColumn("fitted", _one_step(
        F.col("y"), *own, F.col("l_in") + F.col("mean"), F.col("b_in")))
    return _rows_of(run, rows)


def _rows_of(run: DataFrame, rows: int) -> DataFrame:
    z = F.posexplode(F.arrays_zip("t", "y", "fitted")).alias("p", "z")
    return run.select("k", "chunk", z).select(
        "k", F.col("z.t").alias("t"), F.col("z.y").alias("v"), F.col("z.fitted").alias("fitted"),
        (F.col("chunk") * rows + F.col("p")).alias("i"), tag_chunk(F.col("chunk"), rows))


def smoothing_origins(df: DataFrame, model: str, candidates: list[tuple], first: Column, step: Column) -> DataFrame:
    """State and residual spread of every candidate at every validation origin, in one pass."""
    dim, rows = _dim(model), chunk_rows(df)
    blocks = series_blocks(df)
    states = affine_states(blocks, dim, rows, params_column(candidates), origin_marks(rows, F.col("n"), first, step))
    var = F.col("sse") / F.col("pos") - F.col("resid_mean") * F.col("resid_mean")
    return states.filter("is_origin").select(
        "k", "cand", F.col("pos").alias("origin"), (F.col("state")[0] + F.col("mean")).alias("level"),
        (F.col("state")[1] if dim == 2 else F.lit(0.0)).alias("slope"), F.lit(None).cast("array<double>").alias("season"),
        F.sqrt(F.greatest(var, F.lit(0.0))).alias("resid_std"))


def optimise_ses(df: DataFrame, rounds: int = 6, points: int = 9) -> DataFrame:
    return optimise_smoothing(df, "ses", rounds, points)


def optimise_smoothing(df: DataFrame, model: str, rounds: int = 6, points: int | None = None) -> DataFrame:
    """Smoothing weights chosen by squared error: a coarse search, then finer ones around the best.

    Each round is one pass in which a series' candidates are an array column, and every candidate has its own least squares
    start. The centre is among the next candidates, so the error never rises. A series is ``converged`` and leaves
    the further rounds once a round changed its error by less than one part in a million.
    """
    dim, rows = _dim(model), chunk_rows(df)
    points = points or (9 if dim == 1 else 7)
    blocks = materialize(series_blocks(df), "blocks")
    seconds = points if dim == 2 else 1
    coarse = [j / (points + 1.0) for j in range(1, points + 1)]
    params, width = params_column([(a, b) for a in coarse for b in (coarse if dim == 2 else [0.0])]), 1.0 / (points + 1)
    work, best, done = blocks, None, None
    first, second = F.floor(F.col("cand") / seconds).cast("int"), F.pmod(F.col("cand"), F.lit(seconds))
    for r in range(rounds):
        final = _final(affine_states(work, dim, rows, params))
        fields = ("cand", "n", "mean", "start", "state", "sse", "resid_mean")
        found = final.groupBy("k").agg(F.min_by(F.struct(*fields), F.struct("sse", "cand")).alias("b")).select("k", "b.*")
        if best is None:
            found = found.withColumn("alpha", (first + 1) / F.lit(points + 1.0)).withColumn("beta", (second + 1) / F.lit(points + 1.0)).withColumn("converged", F.lit(False))
        else:
            old = best.select("k", F.col("alpha").alias("a0"), F.col("beta").alias("b0"), F.col("sse").alias("prev"))
            found = found.join(old, "k").withColumn("alpha", _grid_value(F.col("a0"), first, width, points)).withColumn("beta", _grid_value(F.col("b0"), second, width, points)) \
                .withColumn("converged", F.abs(F.col("prev") - F.col("sse")) <= 1e-6 * F.col("prev")).drop("a0", "b0", "prev")
        best = materialize(found, "smoothing-round")
        done = best.filter("converged") if done is None else done.unionByName(best.filter("converged"))
        best = best.filter("not converged")
        if best.isEmpty():
            break
        width = width if r == 0 else width / (points // 2 + 1)
        work = attach(blocks, best.select("k", F.col("alpha").alias("a0"), F.col("beta").alias("b0")))
        params = F.array(*[F.array(_grid_value(F.col("a0"), F.lit(i), width, points), _grid_value(F.col("b0"), F.lit(j), width, points) if dim == 2 else F.lit(0.0))
                           for i in range(points) for j in range(seconds)])
    chosen = done.unionByName(best)
    return _flat_fit(chosen if dim == 2 else chosen.withColumn("beta", F.lit(None).cast("double")), dim, "converged")


def _grid_value(centre: Column, j: Column, width: float, points: int) -> Column:
    half = points // 2
    return F.greatest(F.lit(1e-4), F.least(F.lit(0.9999), centre + (j - half) * F.lit(width / (half + 1))))
