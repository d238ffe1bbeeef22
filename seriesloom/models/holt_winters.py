"""Holt-Winters with additive trend and additive or multiplicative season.

Smoothing weights are searched on a grid, all candidates of a series side by side, then on finer
grids around the best one.  The start comes from the first two seasons; for the additive form it can also
be estimated by least squares.  Chunks run in parallel once the state before each is known: for
the additive form that state follows from affine maps (each chunk is folded from a zero start, a grouped
scan over one row per chunk joins them); the multiplicative form is solved by Newton's method on the
chunk borders (``chunk_maps``), so no task ever holds more than single chunks of a series.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.layout import attach, chunk_rows, tag_chunk
from ..session import materialize
from .blocks import origin_marks, padded, params_column, pieces, series_blocks
from .chunk_maps import FAN, scan_states, settle
from .smoothing import _STATS, _prefixes, _solve_starts

# Default search grid: (alpha, beta, gamma), then the step of the first refinement.
GRID = list(itertools.product((0.1, 0.3, 0.5, 0.7, 0.9), (0.01, 0.1, 0.3), (0.05, 0.2, 0.5)))
STEPS = (0.1, 0.05, 0.075)

_BEST = ("k string, chunk long, pos long, is_end boolean, is_origin boolean, cand int, alpha double, beta double, gamma double, "
         "sse double, esum double, level double, trend double, season array<double>")


def _recur(y, par, level, trend, season, mul, visit):
    """Run the recursion over the columns of ``y``; ``visit(t, forecast, error, state)`` after each.

    ``season[..., 0]`` belongs to the first column.  Shapes: y (rows, time), weights (rows, cand, 3).
    """
    a, b, c = par[..., 0], par[..., 1], par[..., 2]
    m = season.shape[-1]
    with np.errstate(all="ignore"):
        for t in range(y.shape[1]):
            x, s, base = y[:, t, None], season[..., t % m].copy(), level + trend
            f = base * s if mul else base + s
            fresh = a * (x / s if mul else x - s) + (1 - a) * base
            trend = b * (fresh - level) + (1 - b) * trend
            season[..., t % m] = c * (x / base if mul else x - base) + (1 - c) * s
            level = fresh
            visit(t, f, x - f, (level, trend, season))


def _weights(part):
    return np.array([np.vstack(p) for p in part["params"]])


def _open(part, cands: int, m: int):
    """State before each row's chunk: carried, or the start of the series for its first chunk."""
    own = [np.tile(np.asarray(s), (cands, 1)) if e is None else np.asarray(e).reshape(cands, m + 2)
           for s, e in zip(part["start"], part["state"])]
    x = np.stack(own)
    zero = np.zeros(cands)
    sums = [np.stack([zero if v is None else np.asarray(v) for v in part[c]]) for c in ("sse", "esum")]
    return x[..., 0].copy(), x[..., 1].copy(), x[..., 2:].copy(), *sums


def _pack(state, count: int, rows=slice(None)) -> np.ndarray:
    level, trend, season = state
    turned = np.roll(season[rows], -(count % season.shape[-1]), axis=-1)
    return np.concatenate([level[rows][..., None], trend[rows][..., None], turned], -1)


def _fold_zero(m: int):
    """Additive form: exit state of each full chunk from a zero start."""

    def run(batches):
        for pdf in batches:
            for part in pieces(pdf, (m + 8) * 45):
                y, _ = padded(part["y"].tolist())
                par = _weights(part)
                shape = par.shape[:2]
                last = []
                _recur(y, par, np.zeros(shape), np.zeros(shape), np.zeros((*shape, m)), False,
                       lambda t, f, e, st: last.append(st) if t == y.shape[1] - 1 else None)  # noqa: B023
                yield pd.DataFrame({"k": part["k"], "chunk": part["chunk"], "params": part["params"], "start": part["start"],
                                    "off": list(_pack(last[0], y.shape[1]).reshape(len(part), -1))})

    return run


def _affine_power(par: np.ndarray, m: int, n: int) -> np.ndarray:
    """Matrix of ``n`` steps of the additive recursion on (level, trend, upcoming seasons)."""
    a, b, c = par[..., 0], par[..., 1], par[..., 2]
    step = np.zeros((*a.shape, m + 2, m + 2))
    step[..., 0, 0] = step[..., 0, 1] = 1 - a
    step[..., 0, 2] = -a
    step[..., 1, 0], step[..., 1, 1], step[..., 1, 2] = -a * b, 1 - a * b, -a * b
    for j in range(m - 1):
        step[..., 2 + j, 3 + j] = 1
    step[..., m + 1, 0] = step[..., m + 1, 1] = -c
    step[..., m + 1, 2] = 1 - c
    return np.linalg.matrix_power(step, n)


def _sums(m: int, mul: bool):
    """Error sums of each chunk from the state before it."""

    def run(batches):
        for pdf in batches:
            for part in pieces(pdf, (m + 8) * 45):
                y, _ = padded(part["y"].tolist())
                par = _weights(part)
                level, trend, season, sse, esum = _open(part, par.shape[1], m)

                def visit(t, f, e, st):
                    np.add(sse, e * e, out=sse)  # noqa: B023
                    np.add(esum, e, out=esum)  # noqa: B023

                _recur(y, par, level, trend, season, mul, visit)
                yield pd.DataFrame({"k": part["k"], "chunk": part["chunk"] + 1, "sse": list(sse), "esum": list(esum)})

    return run


def _guess(y: np.ndarray, start: np.ndarray, m: int, gone: int) -> np.ndarray:
    """Entry state of a chunk after ``gone`` rows from its own first two seasons, or from the start of the series if it is shorter."""
    if len(y) >= 2 * m:
        level = y[:m].mean()
        return np.concatenate([[level, (y[m : 2 * m].mean() - level) / m], y[:m] / level])
    return np.concatenate([[y.mean(), 0.0], np.roll(start[2:], -(gone % m))])


def _linearised(m: int, rows: int):
    """Multiplicative form: each full chunk's exit and its derivative by the entry, as an affine map around the guess."""
    dim = m + 2

    def run(batches):
        for pdf in batches:
            cands = len(pdf["params"].iloc[0]) if len(pdf) else 1
            for part in pieces(pdf, (m + 8) * dim * cands):
                y, _ = padded(part["y"].tolist())
                par = _weights(part)
                entry = np.stack([
                    np.asarray(e).reshape(-1, dim) if e is not None else np.tile(np.asarray(s) if c == 0 else _guess(np.asarray(v), np.asarray(s), m, c * rows), (par.shape[1], 1))
                    for v, s, e, c in zip(part["y"], part["start"], part["state"], part["chunk"])])
                level, trend, season = entry[..., 0].copy(), entry[..., 1].copy(), entry[..., 2:].copy()
                a, b, c = (par[..., j, None] for j in range(3))
                # Derivatives by the level, the trend (both in units of the series' size) and the seasons.
                size = np.abs(y).mean(axis=1)[:, None, None]
                unit = np.concatenate([np.tile(size, (1, par.shape[1], 2)), np.ones((*par.shape[:2], m))], -1)
                d_level, d_trend, d_season = np.zeros((*par.shape[:2], dim)), np.zeros((*par.shape[:2], dim)), np.zeros((*par.shape[:2], m, dim))
                d_level[..., 0], d_trend[..., 1] = size[..., 0], size[..., 0]
                d_season[..., np.arange(m), np.arange(m) + 2] = 1.0
                forgotten = False
                with np.errstate(all="ignore"):
                    for t in range(y.shape[1]):
                        x, j = y[:, t, None], t % m
                        s, base = season[..., j].copy(), level + trend
                        if not forgotten:
                            ds, d_base = d_season[..., j, :].copy(), d_level + d_trend
                            d_fresh = (1 - a) * d_base - a * (x / (s * s))[..., None] * ds
                            d_trend = b * (d_fresh - d_level) + (1 - b) * d_trend
                            d_season[..., j, :] = (1 - c) * ds - c * (x / (base * base))[..., None] * d_base
                            d_level = d_fresh
                        fresh = a[..., 0] * (x / s) + (1 - a[..., 0]) * base
                        trend = b[..., 0] * (fresh - level) + (1 - b[..., 0]) * trend
                        season[..., j] = c[..., 0] * (x / base) + (1 - c[..., 0]) * s
                        level = fresh
                        if not forgotten and t % 64 == 63:
                            forgotten = max(np.abs(d_level / size).max(), np.abs(d_trend / size).max(), np.abs(d_season).max()) < 1e-14
                    out = _pack((level, trend, season), y.shape[1])
                    if forgotten:
                        jac = [None] * len(part)
                    else:
                        turned = np.roll(d_season, -(y.shape[1] % m), axis=2)
                        full = np.concatenate([d_level[..., None, :], d_trend[..., None, :], turned], 2) / unit[..., None, :]
                        full[~np.isfinite(full).all(axis=(2, 3)) | ~np.isfinite(out).all(axis=2)] = 0.0
                        out = out - (full @ entry[..., None])[..., 0]
                        jac = list(full.reshape(len(part), -1))
                yield pd.DataFrame({"k": part["k"], "chunk": part["chunk"], "start": part["start"], "jac": jac, "off": list(out.reshape(len(part), -1))})

    return run


def _affine_maps(m: int, rows: int):
    """Additive form: the matrix that all full chunks of a series share, beside the exit from a zero start."""

    def run(batches):
        for part in batches:
            if len(part):
                known: dict = {}
                jacs = []
                for weights in part["params"]:
                    par = np.vstack(weights)
                    key = par.tobytes()
                    if key not in known:
                        power = _affine_power(par, m, rows)
                        known = {**known, key: None if np.abs(power).max() < 1e-18 else power.ravel()} if len(known) < 64 else {key: power.ravel()}
                    jacs.append(known[key])
                yield pd.DataFrame({"k": part["k"], "chunk": part["chunk"], "start": part["start"], "jac": jacs, "off": part["off"]})

    return run


def _entries(work: DataFrame, m: int, mul: bool, rows: int, fan: int = FAN) -> DataFrame:
    """State and error sums before every chunk after the first; nothing to do for short series."""
    full = work.filter(~F.col("is_last")).select("k", "chunk", "y", "params", "start")
    if mul:
        states, _ = settle(full, m + 2, _linearised(m, rows), fan)
    else:
        schema = "k string, chunk long, params array<array<double>>, start array<double>, off array<double>"
        maps = full.mapInPandas(_fold_zero(m), schema).mapInPandas(_affine_maps(m, rows), "k string, chunk long, start array<double>, jac array<double>, off array<double>")
        states = materialize(scan_states(materialize(maps, "chunk-maps"), m + 2, fan), "hw_states")
    none = F.lit(None).cast("array<double>")
    opened = full.join(states, ["k", "chunk"], "left").withColumns({"sse": none, "esum": none})
    sums = opened.mapInPandas(_sums(m, mul), "k string, chunk long, sse array<double>, esum array<double>")
    cells = sums.select("k", "chunk", F.posexplode(F.arrays_zip("sse", "esum")).alias("p", "z"))
    upto = Window.partitionBy("k", "p").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    total = cells.select("k", "chunk", "p", F.sum("z.sse").over(upto).alias("s"), F.sum("z.esum").over(upto).alias("e"))
    packed = total.groupBy("k", "chunk").agg(F.array_sort(F.collect_list(F.struct("p", "s", "e"))).alias("z"))
    summed = packed.select("k", "chunk", F.transform("z", lambda z: z["s"]).alias("sse"), F.transform("z", lambda z: z["e"]).alias("esum"))
    return states.join(summed, ["k", "chunk"])


def _opened(full: DataFrame, m: int, mul: bool, rows: int) -> DataFrame:
    """Chunks with the state before them; NULL for the first chunk of a series."""
    if _is_split(full.select("chunk")):
        return full.join(_entries(full, m, mul, rows), ["k", "chunk"], "left")
    none = F.lit(None).cast("array<double>")
    return full.withColumns({"state": none, "sse": none, "esum": none})


def _best_at_marks(m: int, mul: bool, rows: int):
    """Candidate with the smallest squared error of the prefix, at each mark and at series ends."""

    def run(batches):
        for pdf in batches:
            for part in pieces(pdf, (m + 8) * 45):
                part = part.reset_index(drop=True)
                y, size = padded(part["y"].tolist())
                par = _weights(part)
                level, trend, season, sse, esum = _open(part, par.shape[1], m)
                wanted: dict[int, list[int]] = {}
                origins = [set(map(int, x)) for x in part["marks"]]
                for r, n in enumerate(size):
                    for p in sorted(origins[r] | ({int(n)} if part["is_last"].iat[r] else set())):
                        wanted.setdefault(p, []).append(r)
                out = []

                def visit(t, f, e, st):
                    np.add(sse, e * e, out=sse)  # noqa: B023
                    np.add(esum, e, out=esum)  # noqa: B023
                    for r in wanted.get(t + 1, ()):  # noqa: B023
                        score = np.where(np.isfinite(sse[r]), sse[r], np.inf)  # noqa: B023
                        c = int(score.argmin())
                        x = _pack(st, t + 1, r)[c]
                        out.append((r, t + 1, c, *par[r, c], sse[r, c], esum[r, c], x[0], x[1], x[2:]))  # noqa: B023

                _recur(y, par, level, trend, season, mul, visit)
                idx = [o[0] for o in out]
                got = pd.DataFrame(out, columns=["r", "local", "cand", "alpha", "beta", "gamma", "sse", "esum", "level", "trend", "season"])
                chunk = part["chunk"].to_numpy()[idx]
                yield got.assign(
                    k=part["k"].to_numpy()[idx], chunk=chunk, pos=chunk * rows + got["local"].to_numpy(int),
                    is_end=part["is_last"].to_numpy(bool)[idx] & (size[idx] == got["local"].to_numpy()),
                    is_origin=[int(p) in origins[q] for q, p in zip(idx, got["local"])],
                )[["k", "chunk", "pos", "is_end", "is_origin", "cand", "alpha", "beta", "gamma", "sse", "esum", "level", "trend", "season"]]

    return run


def seasonal_start(df: DataFrame, m: int, mul: bool) -> DataFrame:
    """Level, trend and season from the first two seasons; ``status`` tells why a series has none."""
    head = df.filter(F.col("i") < 2 * m).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("h"))
    low = df.groupBy("k").agg(F.min("v").alias("low"))
    y = F.transform("h", lambda r: r["v"])
    add = lambda s, x: s + x
    first = F.aggregate(F.slice(y, 1, m), F.lit(0.0), add) / m
    second = F.aggregate(F.slice(y, m + 1, m), F.lit(0.0), add) / m
    season = F.transform(F.slice(y, 1, m), (lambda x: x / F.col("l0")) if mul else (lambda x: x - F.col("l0")))
    status = F.when(F.size("h") < 2 * m, "error: shorter than two seasons")
    if mul:
        status = status.when(F.col("low") <= 0, "error: non-positive value")
    found = head.join(low, "k").withColumn("status", status.otherwise("ok"))
    ok = found.withColumn("l0", F.when(F.col("status") == "ok", first)).withColumn("b0", (second - first) / m)
    return ok.select("k", "status", F.when(F.col("status") == "ok", F.concat(F.array("l0", "b0"), season)).alias("start"))


def _work(df: DataFrame, start: DataFrame) -> DataFrame:
    blocks = series_blocks(df)
    start = start.filter(F.col("start").isNotNull()).select("k", "start")
    rows = chunk_rows(df)
    sized = blocks.withColumn("is_last", (F.col("chunk") + 1) * rows >= F.col("n"))
    return materialize(attach(sized, start), "hw_blocks")


def _is_split(work: DataFrame) -> bool:
    """Whether any series has more than one chunk; if none has, no state crosses a border."""
    return bool(work.agg(F.max("chunk")).first()[0])


def hw_states(work: DataFrame, m: int, mul: bool, rows: int, params: Column, marks: Column | None = None) -> DataFrame:
    none = F.array().cast("array<int>")
    full = work.select("k", "chunk", "y", "start", "is_last", params.alias("params"), (none if marks is None else marks).alias("marks"))
    opened = _opened(full, m, mul, rows)
    return opened.mapInPandas(_best_at_marks(m, mul, rows), _BEST)


def _around(steps, scale: float) -> Column:
    def near(c, d, step):
        return F.greatest(F.lit(1e-4), F.least(F.lit(0.9999), F.col(c) + d * step * scale))

    return F.array(*[F.array(near("a0", da, steps[0]), near("b0", db, steps[1]), near("c0", dc, steps[2]))
                     for da, db, dc in itertools.product((0, -1, 1), repeat=3)])


def fit_holt_winters(df: DataFrame, seasonal_periods: int = 24, kind: str = "add", grid: list[tuple] | None = None,
                     rounds: int = 3, tolerance: float = 1e-4, estimate_start: bool = False) -> DataFrame:
    """Weights, final state and squared error, one row per series, failed series included.

    With ``estimate_start`` (additive form) the start is then the one of least squares under the weights found, column ``start``.
    """
    m, mul, rows = int(seasonal_periods), kind == "mul", chunk_rows(df)
    start = materialize(seasonal_start(df, m, mul), "hw_start")
    work = _work(df, start)
    keep = ["k", F.col("pos").alias("n"), "alpha", "beta", "gamma", "sse", "esum", "level", "trend", "season"]
    best = hw_states(work, m, mul, rows, params_column(grid or GRID)).filter("is_end").select(*keep)
    best = materialize(best.withColumn("converged", F.lit(rounds == 0)), "hw_round")
    for r in range(rounds):
        seeds = best.select("k", F.col("alpha").alias("a0"), F.col("beta").alias("b0"), F.col("gamma").alias("c0"))
        finer = hw_states(attach(work, seeds), m, mul, rows, _around(STEPS, 0.5**r)).filter("is_end").select(*keep)
        prev = best.select("k", F.col("sse").alias("prev"))
        best = materialize(finer.join(prev, "k").withColumn(
            "converged", F.col("prev") - F.col("sse") <= tolerance * F.col("prev")).drop("prev"), "hw_round")
    if estimate_start and not mul:
        found = least_squares_start(df, best, m).withColumn("esum", F.col("resid_mean") * F.col("n")).drop("resid_mean")
        best = found.join(best.select("k", "alpha", "beta", "gamma", "converged"), "k")
    return start.select("k", "status").join(best, "k", "left").withColumn("resid_mean", F.col("esum") / F.col("n")).drop("esum")


def _fold_for_start(m: int, rows: int):
    """Additive form: sums of errors from a zero start and of their derivatives by it, and the state's map, of each chunk."""
    dim = m + 2

    def run(batches):
        for pdf in batches:
            for part in pieces(pdf, 50 * dim):
                y, size = padded([np.asarray(v) - c for v, c in zip(part["y"], part["mean"])])
                stats = []
                for r, n in enumerate(size):  # one series' chunk at a time: its derivatives fill a matrix
                    a, b, c = np.asarray(part["params"].iloc[r][0])
                    level = np.zeros(dim + 1)  # the state, then its derivatives by the start
                    trend, season = np.zeros(dim + 1), np.zeros((m, dim + 1))
                    level[1], trend[2] = 1.0, 1.0
                    season[np.arange(m), np.arange(m) + 3] = 1.0
                    forecast = np.empty((n, dim + 1))
                    for t in range(n):
                        s, base = season[t % m].copy(), level + trend
                        forecast[t] = base + s
                        fresh, rest = (1 - a) * base - a * s, (1 - c) * s - c * base
                        fresh[0] += a * y[r, t]
                        rest[0] += c * y[r, t]
                        trend = b * (fresh - level) + (1 - b) * trend
                        level, season[t % m] = fresh, rest
                    e, g = y[r, :n] - forecast[:, 0], forecast[:, 1:]
                    state = np.vstack([level, trend, np.roll(season, -(n % m), axis=0)])
                    stats.append(np.concatenate([[e.sum(), e @ e], e @ g, g.sum(0), (g.T @ g).ravel(), state[:, 0], state[:, 1:].ravel()]))
                yield pd.DataFrame({**{c: part[c].to_numpy() for c in ("k", "chunk", "n", "mean")}, "pos": part["chunk"].to_numpy() * rows + size,
                                    "is_end": True, "is_origin": False, "stats": stats})

    return run


def least_squares_start(df: DataFrame, weights: DataFrame, m: int, fan: int = FAN) -> DataFrame:
    """``(k, n, start, sse, resid_mean, level, trend, season)`` of the additive form under given weights.

    With fixed weights the forecasts are linear in level, trend and seasons of the start. Each chunk gives the sums of
    squares and products for them; these compose over adjoining chunks, and the whole gives the normal equations.
    A shift between level and seasons changes no forecast; of all such starts the smallest one is taken.
    """
    rows, dim = chunk_rows(df), m + 2
    given = weights.filter(F.col("alpha").isNotNull()).select("k", F.array(F.array("alpha", "beta", "gamma")).alias("params"))
    folded = materialize(attach(series_blocks(df), given).mapInPandas(_fold_for_start(m, rows), _STATS), "folded")
    schema = ("k string, chunk long, n long, mean double, pos long, is_end boolean, is_origin boolean, cand int, start array<double>, "
              "state array<double>, sse double, resid_mean double, entry array<double>")
    states = folded.join(_prefixes(folded.select("k", "chunk", "stats"), dim, fan), ["k", "chunk"]).mapInPandas(_solve_starts(dim, 1e-12), schema)
    moved = lambda c: F.transform(c, lambda x, i: F.when(i == 0, x + F.col("mean")).otherwise(x))
    return materialize(states.filter(F.col("pos") == F.col("n")).select(
        "k", "n", moved("start").alias("start"), "sse", "resid_mean", (F.col("state")[0] + F.col("mean")).alias("level"),
        F.col("state")[1].alias("trend"), F.slice("state", 3, m).alias("season")), "hw_start")


def _fit_chunks(m: int, mul: bool):
    def run(batches):
        for pdf in batches:
            for part in pieces(pdf, m + 8):
                y, size = padded(part["y"].tolist())
                par = _weights(part)
                level, trend, season, _, _ = _open(part, 1, m)
                out = np.empty_like(y)

                def visit(t, f, e, st):
                    out[:, t] = f[:, 0]  # noqa: B023

                _recur(y, par, level, trend, season, mul, visit)
                yield pd.DataFrame({"k": part["k"], "chunk": part["chunk"], "fitted": [out[r, :n] for r, n in enumerate(size)]})

    return run


def fitted_holt_winters(df: DataFrame, fit: DataFrame, seasonal_periods: int = 24, kind: str = "add") -> DataFrame:
    """Observed rows with their one-step forecast under the weights of ``fit``."""
    m, mul, rows = int(seasonal_periods), kind == "mul", chunk_rows(df)
    chosen = fit.filter(F.col("alpha").isNotNull()).select("k", F.array(F.array("alpha", "beta", "gamma")).alias("params"))
    start = fit.select("k", "start") if "start" in fit.columns else seasonal_start(df, m, mul)
    full = attach(_work(df, start), chosen).select("k", "chunk", "y", "start", "is_last", "params")
    opened = _opened(full, m, mul, rows)
    arrays = opened.mapInPandas(_fit_chunks(m, mul), "k string, chunk long, fitted array<double>")
    run = series_blocks(df, with_time=True).join(arrays, ["k", "chunk"])
    z = F.posexplode(F.arrays_zip("t", "y", "fitted")).alias("p", "z")
    return run.select("k", "chunk", z).select(
        "k", F.col("z.t").alias("t"), F.col("z.y").alias("v"), F.col("z.fitted").alias("fitted"),
        (F.col("chunk") * rows + F.col("p")).alias("i"), tag_chunk(F.col("chunk"), rows))


def holt_winters_origins(df: DataFrame, seasonal_periods: int, kind: str, first: Column, step: Column,
                         grid: list[tuple] | None = None) -> DataFrame:
    """At every validation origin: the best weights for that prefix and the state they give."""
    m, mul, rows = int(seasonal_periods), kind == "mul", chunk_rows(df)
    work = _work(df, seasonal_start(df, m, mul))
    states = hw_states(work, m, mul, rows, params_column(grid or GRID), origin_marks(rows, F.col("n"), first, step))
    mean = F.col("esum") / F.col("pos")
    return states.filter(F.col("is_origin") & (F.col("pos") >= 2 * m)).select(
        "k", F.lit(0).alias("cand"), F.col("pos").alias("origin"), "level", F.col("trend").alias("slope"), "season",
        F.sqrt(F.greatest(F.col("sse") / F.col("pos") - mean * mean, F.lit(0.0))).alias("resid_std"))
