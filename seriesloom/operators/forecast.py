"""Forecast tables, 95% bands and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Normal quantile of the band, default horizon.
Z = 1.96
HORIZON = 24


def future_grid(last: DataFrame, horizon: int = HORIZON, step: str = "1 hour") -> DataFrame:
    """``(k, step, t)``: the ``horizon`` time points after ``last_t`` of each series."""
    return last.select("k", "last_t", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")).select(
        "k", "step", (F.col("last_t") + F.col("step") * F.expr(f"interval {step}")).alias("t"))


def project(states: DataFrame, horizon: int = HORIZON, keys: tuple = ("k",)) -> DataFrame:
    """Forecasts from ``level``, ``slope`` and the upcoming ``season`` (NULL where there is none)."""
    steps = states.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.select(*keys, "step", point(F.col("step")).alias("forecast"))


def point(step):
    """Forecast ``step`` rows ahead, as a column over ``level, slope, season, kind``."""
    base = F.col("level") + step * F.col("slope")
    seasonal = F.get("season", F.pmod(step - 1, F.size("season")).cast("int"))
    return F.when(F.col("season").isNull(), base).when(F.col("kind") == "mul", base * seasonal).otherwise(base + seasonal)


def with_fallback(points: DataFrame, series: DataFrame, kind: str = "mean") -> DataFrame:
    """Replace a missing forecast of a fitted model by the mean or the last value; mark it."""
    value = F.avg("v") if kind == "mean" else F.max_by("v", "i")
    spare = series.filter(F.col("v").isNotNull()).groupBy("k").agg(value.alias("spare"))
    usable = F.col("forecast").isNotNull() & ~F.isnan("forecast") & (F.abs("forecast") < float("inf"))
    return points.join(spare, "k", "left").withColumn("status", F.when(usable, "ok").otherwise("fallback")) \
        .withColumn("forecast", F.when(usable, F.col("forecast")).otherwise(F.col("spare"))).drop("spare")


def with_bands(points: DataFrame, spread: DataFrame, keys: tuple = ("k",)) -> DataFrame:
    """95% band from the residual spread; the spread of the data where there are no residuals.

    ``spread`` has ``resid_std`` (n-1) and ``data_std`` (population) per key.
    """
    half = Z * F.coalesce(F.col("resid_std"), F.col("data_std"), F.lit(0.0))
    banded = points.join(spread.select(*keys, "resid_std", "data_std"), list(keys), "left")
    return banded.withColumn("lower_95", F.col("forecast") - half).withColumn("upper_95", F.col("forecast") + half) \
        .drop("resid_std", "data_std")


def forecast_table(points: DataFrame, last: DataFrame, spread: DataFrame, horizon: int = HORIZON, step: str = "1 hour",
                   keys: tuple = ("k",)) -> DataFrame:
    """``keys, step, t, forecast, lower_95, upper_95``."""
    grid = future_grid(last, horizon, step)
    return with_bands(points.join(grid, ["k", "step"]), spread, keys)


def validate_intervals(forecasts: DataFrame, truth: DataFrame, keys: tuple = ("k",)) -> DataFrame:
    """Coverage and mean width of the bands against ``truth (k, step, actual)``.

    Missing bounds are replaced by the forecast ± 1.96 standard deviations of the forecasts.
    """
    have = set(forecasts.columns)
    keys = list(keys)
    if not {"lower_95", "upper_95"} <= have:
        std = forecasts.groupBy(*keys).agg(F.stddev_samp("forecast").alias("_std"))
        forecasts = forecasts.join(std, keys)
        if "lower_95" not in have:
            forecasts = forecasts.withColumn("lower_95", F.col("forecast") - Z * F.col("_std"))
        if "upper_95" not in have:
            forecasts = forecasts.withColumn("upper_95", F.col("forecast") + Z * F.col("_std"))
    met = forecasts.join(truth.select("k", "step", "actual"), ["k", "step"], "left")
    seen = F.col("actual").isNotNull()
    inside = F.when(seen, F.col("actual").between(F.col("lower_95"), F.col("upper_95")).cast("double"))
    return met.groupBy(*keys).agg(
        F.avg(inside).alias("coverage"), F.avg(F.when(seen, F.col("upper_95") - F.col("lower_95"))).alias("mean_width"),
        F.count_if(seen).alias("horizon"))
