"""Augmented Dickey-Fuller and KPSS tests around a constant."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.special import normal_cdf
from ..session import materialize
from .lags import lag_products
from .layout import chunk_rows, in_chunk, with_chunk, with_halo, with_totals

# Response surfaces of MacKinnon (1994, 2010) for a constant and one series.
ADF_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
ADF_TAU_MAX, ADF_TAU_MIN, ADF_TAU_STAR = 2.74, -18.83, -1.61
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
# Critical values of Kwiatkowski et al. (1992).
KPSS_CRITICAL = {"10%": 0.347, "5%": 0.463, "2.5%": 0.574, "1%": 0.739}
KPSS_P = (0.10, 0.05, 0.025, 0.01)
SIGNIFICANCE = 0.05


def adf_max_lag(n: int) -> int:
    return int(min(n // 2 - 2, np.ceil(12.0 * (n / 100.0) ** 0.25)))


def _design(x: np.ndarray, first: int, last: int, lags: int) -> np.ndarray:
    """Rows t in [first, last) of (1, lagged differences 1..lags, level, difference)."""
    d = np.diff(x)
    t = np.arange(first, last)
    return np.column_stack([np.ones(len(t)), *[d[t - j] for j in range(1, lags + 1)], x[t], d[t]])


def _sum_runs(items):
    """Add up the matrices of consecutive rows of a series: ``(k, n, mean, head, gram)``."""
    key = None
    for k, n, mean, head, gram in items:
        if k != key:
            if key is not None:
                yield out
            key, out = k, [k, n, mean, head, gram]
        else:
            out[4] = out[4] + gram
            out[3] = head if head is not None else out[3]
    if key is not None:
        yield out


def _in_frames(items, columns, size=256):
    batch = []
    for item in items:
        batch.append(item)
        if len(batch) == size:
            yield pd.DataFrame(batch, columns=columns)
            batch = []
    if batch:
        yield pd.DataFrame(batch, columns=columns)


def _gram_of_chunks(batches):
    """Cross products of the regressors, added up over the chunks of a series in this partition."""

    def grams():
        for pdf in batches:
            for k, y, mean, lead, n, head in zip(*(pdf[c] for c in ("k", "y", "mean", "lead", "n", "head"))):
                x, lags = np.asarray(y) - mean, adf_max_lag(int(n))
                # a difference ends at its row: rows from the first own one on, once all lags exist
                first = max(int(lead) - 1, lags)
                z = _design(x, first, len(x) - 1, lags) if lags >= 0 and len(x) - 1 > first else np.zeros((0, max(lags, 0) + 3))
                yield k, n, mean, head, (z.T @ z).ravel()

    yield from _in_frames(_sum_runs(grams()), ["k", "n", "mean", "head", "gram"])


def _eliminate(a: np.ndarray, upto: int) -> np.ndarray:
    a = a.copy()
    for p in range(upto):
        if a[p, p] > 1e-12:
            a[p + 1:] -= np.outer(a[p + 1:, p] / a[p, p], a[p])
    return a


def _adf_of(gram: np.ndarray, head: np.ndarray, n: int):
    """Lag by AIC on the common sample, then the statistic on the full sample of that lag."""
    lags = adf_max_lag(n)
    if lags < 0 or n < 6:
        return None
    size = n - 1 - lags
    # level first, then the lags one by one: the corner is the squared error of each nested model
    order = [0, lags + 1, *range(1, lags + 1), lags + 2]
    a, aic = gram[np.ix_(order, order)].copy(), []
    for p in range(lags + 2):
        if a[p, p] <= 1e-10 * max(gram[order[p], order[p]], 1e-300):
            return None
        a[p + 1:] -= np.outer(a[p + 1:, p] / a[p, p], a[p])
        if p >= 1:
            if a[-1, -1] <= 0:
                return None
            aic.append(size * np.log(a[-1, -1] / size) + 2 * (p + 1))
    best = int(np.argmin(aic))
    keep = [0, *range(1, best + 1), lags + 1, lags + 2]
    g = gram[np.ix_(keep, keep)].copy()
    if best < lags:
        z = _design(head, best, min(lags, len(head) - 1), best)
        g += z.T @ z
    g = _eliminate(g, best + 1)
    nobs = n - 1 - best
    level, cross, rest = g[-2, -2], g[-2, -1], g[-1, -1]
    sse = rest - cross * cross / level
    if nobs - best - 2 <= 0 or sse <= 0:
        return None
    return cross / level / np.sqrt(sse / (nobs - best - 2) / level), best, nobs


def _sum_and_test(batches):
    """Add up the partial matrices of each series (rows come sorted by series) and test it."""
    parts = ((k, n, mean, head, np.asarray(gram)) for pdf in batches
             for k, n, mean, head, gram in zip(*(pdf[c] for c in ("k", "n", "mean", "head", "gram"))))

    def tests():
        for k, n, mean, head, gram in _sum_runs(parts):
            size = int(round(len(gram) ** 0.5))
            yield k, int(n), *(_adf_of(gram.reshape(size, size), np.asarray(head) - mean, int(n)) or (None, None, None))

    yield from _in_frames(tests(), ["k", "n", "statistic", "used_lag", "nobs"])


def _poly(coefs, x: Column) -> Column:
    total = F.lit(float(coefs[-1]))
    for c in reversed(coefs[:-1]):
        total = total * x + float(c)
    return total


def adf_test(df: DataFrame) -> DataFrame:
    """ADF test with a constant, lag chosen by AIC; ``df`` holds observed rows.

    All candidate lags share one sample, so one matrix of cross products per series serves them
    all.  It is a sum over rows: each chunk gives a part, and only these parts are brought together.
    """
    totals = with_totals(df.select("k", "i", "chunk", "v").withColumn("one", F.lit(1)), n=("sum", "one"), total=("sum", "v"))
    longest = df.agg(F.max("i")).first()[0]
    halo = max(adf_max_lag((longest or 0) + 1), 0) + 1
    if chunk_rows(df) < 2 * halo + 4:  # the first chunk must hold the first rows that lags need
        totals = with_chunk(totals, 2 * halo + 4)
    chunks = with_halo(totals, before=halo).groupBy("k", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("i", "v"))).alias("r"), F.count_if(~F.col("home")).alias("lead"),
        F.first("n").alias("n"), (F.first("total") / F.first("n")).alias("mean"))
    y = F.transform("r", lambda r: r["v"])
    head = F.when(F.col("chunk") == 0, F.slice(y, 1, 2 * halo + 4))
    own = chunks.filter(F.size("r") > F.col("lead")).select("k", "n", "mean", "lead", y.alias("y"), head.alias("head"))
    # sorting inside the partitions lets each task hand on one matrix per series, also for a hot one
    grams = own.sortWithinPartitions("k").mapInPandas(_gram_of_chunks, "k string, n long, mean double, head array<double>, gram array<double>")
    tested = grams.repartition("k").sortWithinPartitions("k").mapInPandas(
        _sum_and_test, "k string, n long, statistic double, used_lag long, nobs long")
    tau, t = F.col("statistic"), F.col("nobs").cast("double")
    p = F.when(tau > ADF_TAU_MAX, F.lit(1.0)).when(tau < ADF_TAU_MIN, F.lit(0.0)).when(
        tau <= ADF_TAU_STAR, normal_cdf(_poly(ADF_SMALL_P, tau))).otherwise(normal_cdf(_poly(ADF_LARGE_P, tau)))
    crit = {name: c[0] + c[1] / t + c[2] / (t * t) + c[3] / (t * t * t) for name, c in ADF_CRITICAL.items()}
    return tested.select(
        "k", "n", "statistic", F.when(tau.isNotNull(), p).alias("p_value"), "used_lag", "nobs",
        crit["1%"].alias("crit_1"), crit["5%"].alias("crit_5"), crit["10%"].alias("crit_10"),
        F.when(tau.isNotNull(), F.lit("ok")).otherwise(F.lit("degenerate")).alias("status"))


def _interpolate_p(stat: Column) -> Column:
    points = list(zip(KPSS_CRITICAL.values(), KPSS_P))
    p = F.when(stat <= points[0][0], F.lit(points[0][1]))
    for (x0, p0), (x1, p1) in zip(points, points[1:]):
        p = p.when(stat <= x1, F.lit(p0) + (stat - x0) * ((p1 - p0) / (x1 - x0)))
    return p.when(stat > points[-1][0], F.lit(points[-1][1]))


def _pieces(g: Column, lags: Column, weight) -> Column:
    return F.aggregate(F.when(lags >= 1, F.sequence(F.lit(1), lags.cast("int"))).otherwise(F.array().cast("array<int>")),
                       F.lit(0.0), lambda s, j: s + weight(j) * F.element_at(g, j + 1))


def _running_square_sum(df: DataFrame) -> DataFrame:
    """Σ S² of the running sums S of the centred values, from four sums per chunk."""
    base = with_totals(df.select("k", "i", "chunk", "v").withColumn("one", F.lit(1)), n=("sum", "one"), total=("sum", "v"))
    e = F.col("v") - F.col("total") / F.col("n")
    local = base.withColumn("e", e).withColumn("s", F.sum("e").over(in_chunk("i").rowsBetween(Window.unboundedPreceding, 0)))
    parts = local.groupBy("k", "chunk").agg(F.count("e").alias("m"), F.sum("e").alias("se"), F.sum("s").alias("ss"), F.sum(F.col("s") * F.col("s")).alias("sq"))
    before = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    o = F.col("o")
    lifted = parts.withColumn("o", F.coalesce(F.sum("se").over(before), F.lit(0.0)))
    return lifted.groupBy("k").agg(F.sum(F.col("sq") + 2 * o * F.col("ss") + F.col("m") * o * o).alias("square_sum"))


def kpss_test(df: DataFrame) -> DataFrame:
    """KPSS test around a constant with the automatic lag of Hobijn et al. (1998)."""
    longest = (df.agg(F.max("i")).first()[0] or 0) + 1
    depth = max(1, int(12 * (longest / 100.0) ** 0.25), int(longest ** (2.0 / 9.0)))
    n = F.col("n")

    def with_lags(products: DataFrame) -> DataFrame:
        span = F.floor(F.pow(n.cast("double"), F.lit(2.0 / 9.0)))
        s0 = F.col("g")[0] / n + _pieces(F.col("g"), span, lambda j: F.lit(2.0)) / n
        s1 = _pieces(F.col("g"), span, lambda j: j * 2.0) / n
        rate = 1.1447 * F.pow(F.pow(s1 / F.nullif(s0, F.lit(0.0)), F.lit(2.0)), F.lit(1.0 / 3.0))
        return products.withColumn("lags", F.least(F.floor(rate * F.pow(n.cast("double"), F.lit(1.0 / 3.0))), n - 1))

    # the chosen lags seldom exceed the first depth; where they do, sum again as deep as needed
    products = materialize(with_lags(lag_products(df, depth)), "autocov")
    deepest = products.agg(F.max("lags")).first()[0] or 0
    if deepest > depth:
        products = products.drop("g").join(lag_products(df, int(deepest)).drop("n"), "k")
    table = products.join(_running_square_sum(df), "k")
    long_run = (F.col("g")[0] + 2 * _pieces(F.col("g"), F.col("lags"), lambda j: 1 - j / (F.col("lags") + 1.0))) / n
    stat = F.col("square_sum") / (n * n) / F.nullif(long_run, F.lit(0.0))
    out = table.select("k", "n", stat.alias("statistic"), F.col("lags").cast("long").alias("used_lag"))
    return out.select("k", "n", "statistic", _interpolate_p(F.col("statistic")).alias("p_value"), "used_lag",
                      *[F.lit(v).alias(f"crit_{c[:-1].replace('.', '_')}") for c, v in KPSS_CRITICAL.items()],
                      F.when(F.col("statistic").isNotNull(), F.lit("ok")).otherwise(F.lit("degenerate")).alias("status"))


def stationarity(df: DataFrame) -> DataFrame:
    """Both tests as rows with their verdict."""
    adf = adf_test(df).select("k", F.lit("ADF").alias("test"), "statistic", "p_value", "used_lag", "nobs", "status",
                              F.when(F.col("p_value").isNotNull(), F.col("p_value") < SIGNIFICANCE).alias("stationary"))
    kpss = kpss_test(df).select("k", F.lit("KPSS").alias("test"), "statistic", "p_value", "used_lag", F.col("n").alias("nobs"), "status",
                                F.when(F.col("p_value").isNotNull(), F.col("p_value") >= SIGNIFICANCE).alias("stationary"))
    return adf.unionByName(kpss)
