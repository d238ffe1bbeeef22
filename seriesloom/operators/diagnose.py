"""Residual diagnostics shared by all models: one row per (series, model)."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..functions.special import chi2_tail
from .lags import lag_products
from .layout import attach, chunk_rows, number_rows, with_chunk
from .quantiles import series_quantiles

KEYS = ("k", "model")
# Ljung-Box lag and histogram bins.
LJUNG_BOX_LAG = 10
BINS = 30


def residuals(rows: DataFrame) -> DataFrame:
    """``(k, model, v, e, i, chunk)`` of rows with a residual, renumbered without holes."""
    size = chunk_rows(rows)
    kept = rows.withColumn("e", F.col("v") - F.col("fitted")).filter(F.col("e").isNotNull()).select(
        *KEYS, "v", "e", F.col("i").alias("_i"), F.col("chunk").alias("_bucket"))
    return with_chunk(number_rows(kept, "_bucket", ["_i"], KEYS).drop("_i", "_bucket"), size)


def error_measures(res: DataFrame) -> DataFrame:
    """MSE, MAE, MAPE (zero actuals skipped), spread and the Jarque-Bera test, in one aggregation."""
    e = F.col("e")
    table = res.groupBy(*KEYS).agg(
        F.count("e").alias("fitted_values_count"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(ratio(e, F.col("v")))) * 100).alias("mape"), F.sum(e * e).alias("sse"), F.stddev_samp("e").alias("resid_std"),
        F.skewness("e").alias("_s"), F.kurtosis("e").alias("_k"),
    )
    jb = F.col("fitted_values_count") / 6.0 * (F.col("_s") * F.col("_s") + F.col("_k") * F.col("_k") / 4)
    return table.withColumn("jb_stat", jb).withColumn("jb_pvalue", chi2_tail(F.col("jb_stat"), 2)).drop("_s", "_k")


def ljung_box(res: DataFrame, lag: int = LJUNG_BOX_LAG) -> DataFrame:
    g = lag_products(res, lag, "e", KEYS)
    n = F.col("n")
    r2 = [F.pow(F.col("g")[j] / F.nullif(F.col("g")[0], F.lit(0.0)), F.lit(2.0)) / F.nullif(n - j, F.lit(0)) for j in range(1, lag + 1)]
    q = F.when(n > lag, n * (n + 2) * sum(r2[1:], r2[0]))
    return g.select(*KEYS, q.alias("lb_stat")).withColumn("lb_pvalue", chi2_tail(F.col("lb_stat"), lag))


def diagnose(rows: DataFrame) -> DataFrame:
    """All measures and tests for fitted rows ``(k, model, i, chunk, v, fitted)``."""
    res = residuals(rows)
    return error_measures(res).join(ljung_box(res), list(KEYS), "left")


def information_criteria(n: Column, sse: Column, k: Column) -> dict[str, Column]:
    """AIC, BIC and the small-sample AIC for ``k`` estimated values."""
    fit = n * F.ln(F.nullif(sse, F.lit(0.0)) / n)
    aic = fit + 2 * k
    return {"aic": aic, "bic": fit + k * F.ln(n), "aicc": aic + 2 * k * (k + 1) / F.when(n - k - 1 > 0, n - k - 1)}


def residual_histogram(res: DataFrame, bins: int = BINS) -> DataFrame:
    """Counts in ``bins`` equal bins between the extremes, empty bins included."""
    ends = res.groupBy(*KEYS).agg(F.min("e").alias("lo"), F.max("e").alias("hi"))
    placed = attach(res.select(*KEYS, "chunk", "e"), ends, KEYS)
    at = F.least(F.lit(bins), F.coalesce(F.width_bucket("e", "lo", "hi", F.lit(bins)), F.lit(1))).cast("int")
    counts = placed.groupBy(*KEYS, at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return grid.join(counts, [*KEYS, "bin"], "left").select(
        *KEYS, "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
        (F.col("lo") + F.col("bin") * width).alias("upper"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def qq_points(res: DataFrame, points: int = 99, longest: int | None = None) -> DataFrame:
    """Residual quantiles next to normal quantiles, and the line through mean and spread."""
    probs = [j / (points + 1) for j in range(1, points + 1)]
    normal = [NormalDist().inv_cdf(p) for p in probs]
    q = series_quantiles(res, probs, "e", KEYS, longest)
    mid = res.groupBy(*KEYS).agg(F.avg("e").alias("mean"), F.stddev_samp("e").alias("std"))
    z = F.array(*[F.lit(x) for x in normal])
    p = F.array(*[F.lit(x) for x in probs])
    flat = q.join(mid, list(KEYS)).select(*KEYS, "mean", "std", F.explode(F.arrays_zip(
        p.alias("p"), z.alias("z"), F.col("q").alias("q"))).alias("c"))
    return flat.select(*KEYS, F.col("c.p").alias("p"), F.col("c.z").alias("normal_quantile"),
                       F.col("c.q").alias("residual_quantile"), (F.col("mean") + F.col("std") * F.col("c.z")).alias("line"))
