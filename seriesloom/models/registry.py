"""Model codes, and one call that fits, forecasts and measures a model on all series."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.diagnose import diagnose, information_criteria
from ..operators.forecast import HORIZON, forecast_table, project, with_fallback
from ..session import materialize
from . import holt_winters, simple, smoothing

# Model codes and display names.
NAMES = {
    "sma": "Simple Moving Average",
    "lr": "Linear Regression Trend",
    "ses": "Simple Exponential Smoothing",
    "holt": "Holt Linear Trend",
    "holt_hw_add": "Holt-Winters Additive",
    "holt_hw_mul": "Holt-Winters Multiplicative",
}
# Estimated values per model beyond the season: weights, start level, trend weight and start trend.
_ESTIMATED = {"ses": 2, "holt": 4, "holt_hw_add": 5, "holt_hw_mul": 5}


@dataclass
class ModelRun:
    """``rows`` fitted rows, ``state`` per series (level, slope, season, kind, params), ``status``."""

    code: str
    rows: DataFrame
    state: DataFrame


def run_model(df: DataFrame, code: str, params: dict | None = None) -> ModelRun:
    """Fit one model on observed rows.  The moving average uses full windows unless ``partial``.

    With ``estimate_weights`` simple and Holt smoothing choose their weights for each series by squared error.
    """
    p = dict(params or {})
    none = F.lit(None)
    season, kind = none.cast("array<double>"), none.cast("string")
    if code == "sma":
        w = int(p.get("window", simple.SMA_WINDOW))
        rows = simple.sma_rows(df, w, bool(p.get("partial", False)))
        state = simple.sma_state(df, w).withColumn("params", F.to_json(F.struct(F.lit(w).alias("window"))))
    elif code == "lr":
        rows = simple.linear_rows(df)
        state = simple.linear_state(df).withColumn("params", F.to_json(F.struct("slope", "intercept")))
    elif code in ("ses", "holt"):
        a, b = float(p.get("alpha", smoothing.ALPHA)), float(p.get("beta", smoothing.BETA))
        if p.get("estimate_weights"):
            fit = materialize(smoothing.optimise_smoothing(df, code), "smoothing-fit")
            rows = smoothing.fitted_smoothing(df, code, weights=fit)
        else:
            states = materialize(smoothing.smoothing_states(df, code, a, b), "states")
            rows = smoothing.fitted_smoothing(df, code, a, b, states)
            fit = smoothing.fit_smoothing(df, code, a, b, states)
        shown = F.struct("alpha") if code == "ses" else F.struct("alpha", "beta")
        state = fit.withColumn("slope", F.col("trend")).withColumn("params", F.to_json(shown))
    elif code in ("holt_hw_add", "holt_hw_mul"):
        kind_name = code[-3:]
        m = int(p.get("seasonal_periods", 24))
        fit = materialize(holt_winters.fit_holt_winters(df, m, kind_name, p.get("grid"), int(p.get("rounds", 3)),
                                                        estimate_start=bool(p.get("estimate_start", True))), "hw_fit")
        rows = holt_winters.fitted_holt_winters(df, fit, m, kind_name)
        season, kind = F.col("season"), F.lit(kind_name)
        state = fit.withColumn("slope", F.col("trend")).withColumn("params", F.to_json(F.struct(
            "alpha", "beta", "gamma", F.lit(m).alias("seasonal_periods"))))
    else:
        raise ValueError(f"unknown model code {code!r}; known: {sorted(NAMES)}")
    status = F.col("status") if "status" in state.columns else F.lit("ok")
    converged = F.col("converged") if "converged" in state.columns else F.lit(True)
    state = state.select("k", "level", "slope", season.alias("season"), kind.alias("kind"), "params",
                         status.alias("status"), converged.alias("converged"))
    rows = rows.select("k", F.lit(code).alias("model"), "t", "v", "fitted", "i", "chunk")
    return ModelRun(code, rows, state)


def forecast_points(run: ModelRun, df: DataFrame, horizon: int = HORIZON, fallback: str = "mean") -> DataFrame:
    """``(k, step, forecast, status)`` of the series the model could be fitted to."""
    return with_fallback(project(run.state.filter(F.col("status") == "ok"), horizon), df, fallback)


def evaluate(train: DataFrame, code: str, horizon: int = HORIZON, params: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Fit on training rows: ``(forecasts, fitted rows with residual e)`` as validation uses them.

    The moving average has partial windows of 24 rows by default here, and a missing forecast is
    replaced by the last value. Without parameters, weights are estimated.
    """
    p = {"estimate_weights": True} if params is None else dict(params)
    if code == "sma":
        p = {"window": simple.SMA_WINDOW_VALIDATION, **p, "partial": True}
    run = run_model(train, code, p)
    return forecast_points(run, train, horizon, "last"), run.rows.withColumn("e", F.col("v") - F.col("fitted"))


def n_estimated(code: str, params: dict) -> int | None:
    if code not in _ESTIMATED:
        return None
    m = int(params.get("seasonal_periods", 24)) if code.startswith("holt_hw") else 0
    return _ESTIMATED[code] + m


def model_record(run: ModelRun, rows: DataFrame, params: dict, seconds: float | None = None) -> DataFrame:
    """One row per series: metrics, tests, criteria, parameters, status and wall time.

    ``rows`` are the stored fitted rows of the run.
    """
    k = n_estimated(run.code, params)
    measures = diagnose(rows)
    n, sse = F.col("fitted_values_count"), F.col("sse")
    crit = information_criteria(n, sse, F.lit(k)) if k else {c: F.lit(None).cast("double") for c in ("aic", "bic", "aicc")}
    scored = measures.select("*", *[c.alias(name) for name, c in crit.items()]).drop("model")
    r2 = F.lit(None).cast("double")
    if run.code == "lr":
        fit = rows.groupBy("k").agg(F.regr_r2("v", F.col("i").cast("double")).alias("r_squared"))
        scored, r2 = scored.join(fit, "k", "left"), F.col("r_squared")
    return run.state.select("k", "params", "status", "converged").join(scored, "k", "left").select(
        "k", F.lit(run.code).alias("model"), F.lit(NAMES[run.code]).alias("name"), "status", "converged", "params",
        "mse", "mae", "mape", r2.alias("r_squared"), "aic", "bic", "aicc", "jb_stat", "jb_pvalue", "lb_stat", "lb_pvalue",
        "fitted_values_count", "resid_std", F.lit(seconds).cast("double").alias("seconds"))


def model_run(df: DataFrame, code: str, params: dict | None = None, horizon: int = HORIZON, step: str = "1 hour"):
    """Fit, measure and forecast: ``(record, forecasts)``."""
    p = dict(params or {})
    t0 = time.perf_counter()
    run = run_model(df, code, p)
    rows = materialize(run.rows, f"rows_{code}")
    record = materialize(model_record(run, rows, p, time.perf_counter() - t0), f"record_{code}")
    whole = df.groupBy("k").agg(F.stddev_pop("v").alias("data_std"), F.max("t").alias("last_t"))
    spread = whole.join(record.select("k", "resid_std"), "k", "left")
    table = forecast_table(forecast_points(run, df, horizon), whole.select("k", "last_t"), spread, horizon, step)
    return record, table.select("k", F.lit(code).alias("model"), "step", "t", "forecast", "lower_95", "upper_95", "status")
