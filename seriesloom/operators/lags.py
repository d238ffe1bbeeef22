"""Autocovariances, autocorrelation and partial autocorrelation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from .layout import with_halo, with_totals


# Up to this many lags one dot product for each is cheaper than three transforms.
DIRECT_LAGS = 64


def direct_products(x: np.ndarray, lead: int, lags: int) -> np.ndarray:
    """Sum of x(i)·x(i-j) over the rows from ``lead`` on, for j = 0..lags, one dot product for each lag."""
    return np.array([float(x[max(lead, j):] @ x[max(lead, j) - j: len(x) - j]) if j < len(x) else 0.0 for j in range(lags + 1)])


def transformed_products(x: np.ndarray, lead: int, lags: int) -> np.ndarray:
    """The same by fast Fourier transform, at a cost that hardly depends on the number of lags.

    The rows before ``lead`` are zeroed in one of the two factors; padding by ``lags`` keeps the
    circular correlation from wrapping round.
    """
    size = 1 << (len(x) + lags - 1).bit_length()
    own = np.where(np.arange(len(x)) < lead, 0.0, x)
    return np.fft.irfft(np.fft.rfft(own, size) * np.conj(np.fft.rfft(x, size)), size)[: lags + 1]


@pandas_udf(ArrayType(DoubleType()))
def _chunk_products(c: pd.Series, lead: pd.Series, max_lag: pd.Series) -> pd.Series:
    """Products summed over the own rows of a chunk; ``lead`` rows before them serve as lags."""

    def sums(x, h, lags):
        return (direct_products if min(lags, len(x)) <= DIRECT_LAGS else transformed_products)(x, h, lags)

    return pd.Series([sums(np.asarray(x, float), int(h), int(m)) for x, h, m in zip(c, lead, max_lag)])


def lag_products(df: DataFrame, max_lag: int, col: str = "v", keys: tuple = ("k",)) -> DataFrame:
    """Per series: ``n`` and ``g``, where ``g[j]`` is the sum of c(i)·c(i-j) of the centred values.

    ``df`` holds observed rows without holes in ``i``.  Each chunk sees the ``max_lag`` rows before
    it as part of one bounded array; only the sums per chunk and lag are shuffled.
    """
    keys = tuple(keys)
    plain = df.select(*keys, "i", "chunk", F.col(col).alias("x"))
    sized = with_totals(plain.withColumn("one", F.lit(1)), keys, n=("sum", "one"), total=("sum", "x"))
    centred = sized.select(*keys, "i", "chunk", "n", (F.col("x") - F.col("total") / F.col("n")).alias("c"))
    arrays = with_halo(centred, before=max_lag).groupBy(*keys, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("i", "c"))).alias("r"), F.count_if(~F.col("home")).alias("lead"), F.first("n").alias("n"))
    own = arrays.filter(F.size("r") > F.col("lead"))
    parts = own.select(*keys, "n", _chunk_products(F.transform("r", lambda r: r["c"]), F.col("lead"), F.lit(max_lag)).alias("g"))
    sums = parts.select(*keys, "n", F.posexplode("g").alias("lag", "x")).groupBy(*keys, "lag").agg(F.first("n").alias("n"), F.sum("x").alias("x"))
    return sums.groupBy(*keys).agg(
        F.first("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("lag", "x"))), lambda p: p["x"]).alias("g"))


def autocorrelation(df: DataFrame, max_lag: int, col: str = "v") -> DataFrame:
    """``(k, n, lag, acf)`` for lags 0..min(max_lag, n-1)."""
    g = lag_products(df, max_lag, col)
    return g.select("k", "n", F.col("g")[0].alias("g0"), F.posexplode("g").alias("lag", "gj")).filter(
        F.col("lag") < F.col("n")
    ).select("k", "n", "lag", (F.col("gj") / F.nullif(F.col("g0"), F.lit(0.0))).alias("acf"))


def levinson(r: Column) -> Column:
    """Partial autocorrelations from an array of autocorrelations (lag 0 first)."""
    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array().cast("array<double>").alias("out"))

    def step(a, k):
        phi = a["phi"]
        back = F.transform(phi, lambda p, j: p * F.element_at(r, (k - j).cast("int")))
        fore = F.transform(phi, lambda p, j: p * F.element_at(r, (j + 2).cast("int")))
        add = lambda s, x: s + x
        num = F.element_at(r, k + 1) - F.aggregate(back, F.lit(0.0), add)
        den = 1.0 - F.aggregate(fore, F.lit(0.0), add)
        p = num / F.nullif(den, F.lit(0.0))
        flipped = F.reverse(phi)
        fresh = F.concat(F.transform(phi, lambda x, j: x - p * F.get(flipped, j)), F.array(p))
        return F.struct(fresh.alias("phi"), F.concat(a["out"], F.array(p)).alias("out"))

    lags = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(lags, start, step)["out"]


def partial_autocorrelation(df: DataFrame, max_lag: int, col: str = "v") -> DataFrame:
    """``(k, lag, pacf)`` by the Levinson-Durbin recursion on one small array per series; NULL for a constant one."""
    g = lag_products(df, max_lag, col)
    r = g.select("k", F.transform(F.slice("g", F.lit(1), F.least(F.col("n"), F.lit(max_lag + 1)).cast("int")), lambda x: x / F.nullif(F.col("g")[0], F.lit(0.0))).alias("r"))
    return r.select("k", F.posexplode(levinson(F.col("r"))).alias("p", "pacf")).select(
        "k", (F.col("p") + 1).alias("lag"), "pacf")
