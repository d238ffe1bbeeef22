"""Registered queries: each applies one operator of the package to the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.models import holt_winters, registry, simple, smoothing
from seriesloom.operators import clean as C
from seriesloom.operators import describe, diagnose, forecast, lags, profile, season, stationarity, trend, windows
from seriesloom.operators.layout import ROWS_PER_CHUNK, observed
from seriesloom.plans import select, validate
from seriesloom.session import materialize, shared_dir
from seriesloom.sources import files, sinks
from seriesloom.sources.panel import irregular_panel, panel_report, regular_panel, to_long

QUERIES = {}
_stored: dict[tuple, DataFrame] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def stored(name: str):
    """Write a shared input once per session and folder; later queries read the written table."""

    def wrap(build):
        def get(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.conf.get("spark.app.id"), sf_dir, name)
            if key not in _stored:
                _stored[key] = materialize(build(spark, sf_dir), name)
            return _stored[key]

        return get

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hour(c: str) -> Column:
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def event_hours(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("k"), hour("ts").alias("t"), F.col("value").alias("v"))


# Short chunks on purpose, so that the comparison with plain SQL crosses chunk borders.
@stored("hourly")
def hourly(spark, sf_dir):
    return regular_panel(event_hours(spark, sf_dir), "1 hour", 256)


@stored("hourly_steps")
def hourly_steps(spark, sf_dir):
    return C.clean_steps(hourly(spark, sf_dir))


@stored("hourly_series")
def hourly_series(spark, sf_dir):
    return observed(hourly_steps(spark, sf_dir).select("k", "t", F.col("v_clean").alias("v"), "i", "chunk"))


def order_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("k"), F.col("o_orderdate").alias("t"), F.col("o_totalprice").alias("v"))


def supplier_days(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("k"), F.col("l_shipdate").alias("t"), F.col("l_quantity").alias("v"))


@stored("daily")
def daily(spark, sf_dir):
    return irregular_panel(order_days(spark, sf_dir), 512, ties="sum")


@stored("supplier")
def supplier(spark, sf_dir):
    return irregular_panel(supplier_days(spark, sf_dir), ROWS_PER_CHUNK, ties="sum")


def sig(c, digits: int = 8) -> Column:
    """Round to significant digits, so that summation order does not show in comparisons.

    The rounding border is moved off one half, where means of decimal data often lie exactly.
    """
    c = F.col(c) if isinstance(c, str) else c
    p = F.lit(digits - 1) - F.floor(F.log10(F.abs(c))).cast("int")
    up, down = F.pow(F.lit(10.0), p), F.pow(F.lit(10.0), -p)
    return F.when(F.abs(c) < 1e-9, F.lit(0.0)).when(
        p >= 0, F.floor(c * up + 0.5031).cast("double") / up).otherwise(F.floor(c / down + 0.5031).cast("double") * down)


def rounded(df: DataFrame, *keep: str, digits: int = 8, **special: int) -> DataFrame:
    """``keep`` columns as they are, the other doubles rounded."""
    return df.select(*[
        sig(c, special.get(c, digits)).alias(c) if kind == "double" and c not in keep else F.col(c) for c, kind in df.dtypes
    ])


# --- sources, profile, cleaning -------------------------------------------------------------


@query
def import_profile(spark, sf_dir):
    return rounded(profile.import_profile(table(spark, sf_dir, "orders"), "o_orderdate"))


@query
def date_report(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("k"), F.when(
        F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("day "), F.col("o_orderdate").cast("string"))
    ).otherwise(F.col("o_orderdate").cast("string")).alias("date"), F.col("o_totalprice").alias("v"))
    return profile.date_report(files.parse_dates(raw, "date"))


@query
def preview_rows(spark, sf_dir):
    return rounded(profile.preview(hourly(spark, sf_dir)).select("k", "t", "v"))


@query
def hourly_panel(spark, sf_dir):
    return rounded(hourly(spark, sf_dir).select("k", "t", "i", "v"))


@query
def supplier_panel(spark, sf_dir):
    return rounded(supplier(spark, sf_dir).select("k", "t", "i", "v"))


@query
def duplicate_times(spark, sf_dir):
    """Single orders by day: rows of one day are kept, ordered by value."""
    return irregular_panel(order_days(spark, sf_dir), 512).select("k", "t", "i", "v")


@query
def ties_by_mean(spark, sf_dir):
    return rounded(irregular_panel(order_days(spark, sf_dir), 512, ties="mean").select("k", "t", "i", "v"))


def gappy_hours(spark, sf_dir):
    """Hourly values, of which one series has none at all."""
    return regular_panel(event_hours(spark, sf_dir).withColumn("v", F.when(F.col("k") != "view", F.col("v"))), "1 hour", 256)


@query
def all_null_clean(spark, sf_dir):
    return rounded(C.clean_steps(gappy_hours(spark, sf_dir)).select("k", "t", "v_filled", "kept", "v_clean"))


@query
def all_null_describe(spark, sf_dir):
    """All-null series keep a row with a count of 0; quartiles by both ways of counting are the same."""
    panel = materialize(gappy_hours(spark, sf_dir), "gappy-hours")
    short = describe.describe_series(panel).select("k", "n", "min", "max", "q25", "q50", "q75")
    long = describe.describe_series(panel, longest=10**9).select("k", F.col("q25").alias("b25"), F.col("q50").alias("b50"), F.col("q75").alias("b75"))
    return rounded(short.join(long, "k"))


def order_lines(spark, sf_dir):
    """One series of at most seven rows for each order; times may repeat."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("k"), F.col("l_shipdate").alias("t"), F.col("l_extendedprice").alias("v"))


@query
def short_series_validation(spark, sf_dir):
    """Series too short for a fold stay, with no fold and no error."""
    tested = validate.grid_search(irregular_panel(order_lines(spark, sf_dir)), "sma", {"window": [24]})
    return rounded(tested.select("k", "cand", "mean_mse", "n_folds", "n_failed"), digits=6)


@query
def wide_to_long(spark, sf_dir):
    """Two numeric columns as two series, summed by day."""
    wide = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("date"), "l_quantity", "l_extendedprice")
    return rounded(irregular_panel(to_long(wide, ["l_quantity", "l_extendedprice"]), ties="sum").select("k", "t", "i", "v"))


@query
def interpolate_time(spark, sf_dir):
    return rounded(C.interpolate_time(hourly(spark, sf_dir)).select("k", "t", "v"))


@query
def iqr_fences(spark, sf_dir):
    return rounded(C.iqr_fences(C.interpolate_time(hourly(spark, sf_dir))))


@query
def iqr_clean(spark, sf_dir):
    return rounded(hourly_steps(spark, sf_dir).select("k", "t", "v_filled", "kept", "v_clean"))


@query
def missing_report(spark, sf_dir):
    return rounded(profile.missing_report(hourly_steps(spark, sf_dir)))


@query
def outlier_report(spark, sf_dir):
    return rounded(profile.outlier_report(hourly_steps(spark, sf_dir)))


@query
def clean_summary(spark, sf_dir):
    return profile.clean_summary(hourly_steps(spark, sf_dir))


# --- statistics -----------------------------------------------------------------------------


@query
def describe_series(spark, sf_dir):
    return rounded(describe.describe_series(hourly_series(spark, sf_dir)))


@query
def describe_suppliers(spark, sf_dir):
    return rounded(describe.describe_series(supplier(spark, sf_dir)))


@query
def quantiles_radix(spark, sf_dir):
    """The way taken for very long series, on every series here."""
    from seriesloom.operators.quantiles import radix_quantiles

    q = radix_quantiles(supplier(spark, sf_dir), [0.05, 0.5, 0.95])
    return rounded(q.select("k", F.col("q")[0].alias("q05"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q95")))


@query
def quantiles_bracketed(spark, sf_dir):
    """The way in two passes, which relies on a sketch."""
    from seriesloom.operators.quantiles import bracketed_quantiles

    q = bracketed_quantiles(supplier(spark, sf_dir), [0.05, 0.5, 0.95], accuracy=200)
    return rounded(q.select("k", F.col("q")[0].alias("q05"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q95")))


@query
def autocorrelation(spark, sf_dir):
    return rounded(lags.autocorrelation(hourly_series(spark, sf_dir), 40), digits=7)


@query
def partial_autocorrelation(spark, sf_dir):
    return rounded(lags.partial_autocorrelation(hourly_series(spark, sf_dir), 24), digits=6)


@query
def decompose_24(spark, sf_dir):
    parts = season.decompose(hourly_series(spark, sf_dir))
    return rounded(parts.select("k", "t", "v", "trend", "seasonal", "remainder"), digits=7)


@query
def seasonality(spark, sf_dir):
    return rounded(season.detect_seasonality(hourly_series(spark, sf_dir)))


@query
def trend_ols(spark, sf_dir):
    return rounded(trend.trend_line(hourly_series(spark, sf_dir)), digits=7)


@query
def trend_test(spark, sf_dir):
    t = trend.analyze_trend(daily(spark, sf_dir))
    return rounded(t.select("k", "slope", "p_value", "significant", "trend_type", "direction"), digits=6)


# --- windows and splits ---------------------------------------------------------------------


@query
def moving_average_full(spark, sf_dir):
    return rounded(windows.moving_average(hourly(spark, sf_dir), 7).select("k", "t", "ma"))


@query
def moving_average_partial(spark, sf_dir):
    return rounded(windows.moving_average(hourly_series(spark, sf_dir), 24, partial=True).select("k", "t", "ma"))


@query
def weighted_moving_average(spark, sf_dir):
    return rounded(windows.weighted_moving_average(hourly_series(spark, sf_dir), [3, 2, 1]).select("k", "t", "wma"))


@query
def train_test_split(spark, sf_dir):
    return rounded(windows.train_test_split(hourly_series(spark, sf_dir), 0.8).select("k", "t", "v", "part"))


@query
def split_boundary(spark, sf_dir):
    return windows.split_boundary(hourly_series(spark, sf_dir), 0.7)


@query
def last_values(spark, sf_dir):
    return rounded(windows.last_values(hourly_series(spark, sf_dir), 7))


# --- stationarity ---------------------------------------------------------------------------


@query
def adf_test(spark, sf_dir):
    return rounded(stationarity.adf_test(daily(spark, sf_dir)), digits=6)


@query
def kpss_test(spark, sf_dir):
    return rounded(stationarity.kpss_test(daily(spark, sf_dir)), digits=6)


@query
def stationarity_verdict(spark, sf_dir):
    return rounded(stationarity.stationarity(hourly_series(spark, sf_dir)), digits=6)


# --- models ---------------------------------------------------------------------------------


@query
def sma_fit(spark, sf_dir):
    return rounded(simple.sma_rows(hourly_series(spark, sf_dir), 7).select("k", "t", "v", "fitted"))


@query
def linear_fit(spark, sf_dir):
    return rounded(simple.linear_rows(hourly_series(spark, sf_dir)).select("k", "t", "v", "fitted"))


@query
def ses_fit(spark, sf_dir):
    fit = smoothing.fit_smoothing(hourly_series(spark, sf_dir), "ses", 0.2)
    return rounded(fit.select("k", "n", "level0", "level", "sse"), digits=7)


@query
def holt_fit(spark, sf_dir):
    fit = smoothing.fit_smoothing(hourly_series(spark, sf_dir), "holt", 0.2, 0.1)
    return rounded(fit.select("k", "n", "level0", "trend0", "level", "trend", "sse"), digits=7)


@query
def ses_fitted(spark, sf_dir):
    return rounded(smoothing.fitted_smoothing(daily(spark, sf_dir), "ses", 0.2).select("k", "t", "v", "fitted"), digits=7)


@query
def holt_fitted(spark, sf_dir):
    return rounded(smoothing.fitted_smoothing(daily(spark, sf_dir), "holt", 0.2, 0.1).select("k", "t", "v", "fitted"), digits=7)


@query
def ses_optimised(spark, sf_dir):
    return smoothing.optimise_ses(hourly_series(spark, sf_dir))


@query
def holt_optimised(spark, sf_dir):
    return smoothing.optimise_smoothing(hourly_series(spark, sf_dir), "holt")


# The whole default grid. Where SQL follows step by step, the start is the fixed one and the grid is not refined.
HW_GRID = holt_winters.GRID
PLAIN = {"rounds": 0, "estimate_start": False}


def _hw_grid(spark, sf_dir, kind):
    fit = holt_winters.fit_holt_winters(hourly_series(spark, sf_dir), 24, kind, HW_GRID, rounds=0)
    return rounded(fit.select("k", "status", "n", "alpha", "beta", "gamma", "sse", "level", "trend"), "alpha", "beta", "gamma", digits=7)


@query
def holt_winters_additive_grid(spark, sf_dir):
    return _hw_grid(spark, sf_dir, "add")


@query
def holt_winters_multiplicative_grid(spark, sf_dir):
    return _hw_grid(spark, sf_dir, "mul")


@query
def holt_winters_additive_fit(spark, sf_dir):
    """All defaults: the grid, its refinements, and the start estimated by least squares."""
    return holt_winters.fit_holt_winters(hourly_series(spark, sf_dir), 12, "add", estimate_start=True)


@query
def holt_winters_multiplicative_fit(spark, sf_dir):
    return holt_winters.fit_holt_winters(hourly_series(spark, sf_dir), 12, "mul")


def _hw_fitted(spark, sf_dir, kind):
    s = hourly_series(spark, sf_dir)
    fit = holt_winters.fit_holt_winters(s, 24, kind, HW_GRID, rounds=0)
    return rounded(holt_winters.fitted_holt_winters(s, fit, 24, kind).select("k", "t", "v", "fitted"), digits=7)


@query
def holt_winters_additive_fitted(spark, sf_dir):
    return _hw_fitted(spark, sf_dir, "add")


@query
def holt_winters_multiplicative_fitted(spark, sf_dir):
    return _hw_fitted(spark, sf_dir, "mul")


# --- diagnostics and forecasts --------------------------------------------------------------


def plain_runs(spark, sf_dir):
    """The plain runs of all six models, fitted once per session and folder."""
    key = (spark.conf.get("spark.app.id"), sf_dir, "plain_runs")
    if key not in _stored:
        s = hourly_series(spark, sf_dir)
        _stored[key] = {code: registry.run_model(s, code, PLAIN) for code in registry.NAMES}
    return _stored[key]


@stored("fitted_rows")
def fitted_rows(spark, sf_dir):
    """Fitted rows of all six models."""
    out = None
    for run in plain_runs(spark, sf_dir).values():
        rows = run.rows
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def residual_tests(spark, sf_dir):
    return rounded(diagnose.diagnose(fitted_rows(spark, sf_dir)), digits=6)


@query
def residual_histogram(spark, sf_dir):
    return rounded(diagnose.residual_histogram(diagnose.residuals(fitted_rows(spark, sf_dir))), digits=7)


@query
def residual_qq(spark, sf_dir):
    return rounded(diagnose.qq_points(diagnose.residuals(fitted_rows(spark, sf_dir)), 19), digits=7)


@query
def information_criteria(spark, sf_dir):
    out = None
    for code, run in plain_runs(spark, sf_dir).items():
        rows = fitted_rows(spark, sf_dir).filter(F.col("model") == code)
        record = registry.model_record(run, rows, {})
        out = record if out is None else out.unionByName(record)
    return rounded(out.select("k", "model", "name", "mse", "aic", "bic", "aicc", "r_squared", "fitted_values_count"), digits=7)


@query
def future_grid(spark, sf_dir):
    last = windows.last_values(hourly_series(spark, sf_dir), 1)
    return forecast.future_grid(last, 24, "1 hour").withColumn("step", F.col("step").cast("long"))


@query
def forecast_table(spark, sf_dir):
    s = hourly_series(spark, sf_dir)
    out = None
    for code in registry.NAMES:
        table = registry.model_run(s, code, PLAIN)[1]
        out = table if out is None else out.unionByName(table)
    return rounded(out, digits=7)


@query
def interval_validation(spark, sf_dir):
    """Moving-average forecasts from the first part of each series against the rows that follow."""
    marked = windows.train_test_split(hourly_series(spark, sf_dir), 0.8)
    train, test = marked.filter("part = 'train'").drop("part"), marked.filter("part = 'test'")
    ends = train.groupBy("k").agg((F.max("i") + 1).alias("n"), F.max("t").alias("last_t"), F.stddev_pop("v").alias("data_std"))
    rows = simple.sma_rows(train, 7)
    spread = rows.groupBy("k").agg(F.stddev_samp(F.col("v") - F.col("fitted")).alias("resid_std")).join(ends, "k")
    state = simple.sma_state(train, 7).withColumn("season", F.lit(None).cast("array<double>")).withColumn("kind", F.lit(None).cast("string"))
    table = forecast.forecast_table(forecast.project(state, 24), ends, spread)
    truth = test.join(ends.select("k", "n"), "k").select("k", (F.col("i") - F.col("n") + 1).cast("int").alias("step"), F.col("v").alias("actual"))
    return rounded(forecast.validate_intervals(table, truth.filter("step <= 24")))


@query
def evaluate_models(spark, sf_dir):
    """The validation form of each model, fitted on the first 80% of each series."""
    train = windows.train_test_split(hourly_series(spark, sf_dir), 0.8).filter("part = 'train'").drop("part")
    out = None
    for code in registry.NAMES:
        points = registry.evaluate(train, code, 24, PLAIN)[0].withColumn("model", F.lit(code))
        out = points if out is None else out.unionByName(points)
    return rounded(out, digits=7)


@query
def evaluate_estimated(spark, sf_dir):
    """Both smoothing models without parameters: their weights are estimated on the first 80% of each series."""
    train = windows.train_test_split(hourly_series(spark, sf_dir), 0.8).filter("part = 'train'").drop("part")
    return registry.evaluate(train, "ses", 24)[0].withColumn("model", F.lit("ses")).unionByName(registry.evaluate(train, "holt", 24)[0].withColumn("model", F.lit("holt")))


@query
def csv_source(spark, sf_dir):
    """Daily sums written as a wide CSV, read back through the column contract."""
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    wide = table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("string").alias("Date")).agg(
        F.sum("l_quantity").alias("Quantity"), F.sum("l_tax").alias("Tax"))
    wide.write.option("header", True).csv(path)
    back = files.series_from_wide(files.read_csv(spark, path, "Date string, Quantity double, Tax double"))
    return rounded(irregular_panel(back, ties="sum").select("k", "t", "i", "v"))


def dirty_csv(spark, sf_dir):
    """All order lines as CSV with damage: words for numbers, days that are none, empty cells, a field too many or too few."""
    path = f"{shared_dir(spark)}/dirty-{uuid.uuid4().hex}"
    line = F.col("l_linenumber")
    quantity = F.when(line == 2, F.lit("n/a")).when(line == 3, F.lit("")).otherwise(F.col("l_quantity").cast("string"))
    date = F.when((line == 4) & (F.col("l_orderkey") % 3 == 0), F.lit("someday")).otherwise(F.col("l_shipdate").cast("string"))
    tax = F.col("l_tax").cast("string")
    text = F.when(line == 5, F.concat_ws(",", date, quantity, tax, F.lit("more"))).when(line == 6, F.concat_ws(",", date, quantity)).otherwise(F.concat_ws(",", date, quantity, tax))
    # A text column named like the header line gives each file that line when it is written as CSV without quotes.
    table(spark, sf_dir, "lineitem").select(text.alias("Date,Quantity,Tax")).write.options(header=True, sep="\x01", quote="", escape="").csv(path)
    return path


def rescued(spark, sf_dir):
    return files.read_csv_rescued(spark, dirty_csv(spark, sf_dir), "Date timestamp_ntz, Quantity double, Tax double")


@query
def csv_malformed(spark, sf_dir):
    """Damaged lines and cells by column."""
    return files.malformed_report(rescued(spark, sf_dir))


@query
def csv_malformed_panel(spark, sf_dir):
    """What a panel from the damaged file rests on: rows, undated and repeated ones, bad lines and cells."""
    rows = rescued(spark, sf_dir)
    good, _ = files.set_aside(rows)
    return panel_report(to_long(good, ["quantity", "tax"]), rows)


@query
def csv_set_aside(spark, sf_dir):
    """The rows kept aside, by what is wrong with them."""
    _, aside = files.set_aside(rescued(spark, sf_dir))
    return aside.groupBy(F.coalesce(F.array_join(F.map_keys(files.BAD_CELLS), "+"), F.lit("")).alias("bad_columns"), F.col(files.BAD_LINE).isNotNull().alias("bad_line")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.array_join(F.map_values(files.BAD_CELLS), "+")).alias("n_texts"))


@query
def forecast_sink(spark, sf_dir):
    """Moving-average forecasts written as CSV by run and model, and read back."""
    path = f"{shared_dir(spark)}/forecasts-{uuid.uuid4().hex}"
    sinks.write_forecasts(registry.model_run(hourly_series(spark, sf_dir), "sma")[1], path, "run-1")
    schema = "series_id string, step int, date timestamp_ntz, forecast double, lower_95 double, upper_95 double, run_id string, model string"
    return rounded(spark.read.schema(schema).option("header", True).csv(path), digits=7)


@query
def event_sink(spark, sf_dir):
    """All four kinds of events of a run that is tried twice, read back: each is there once.

    Seasons of 5,000 rows are too long for every series, which gives the errors.
    """
    path = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    s = hourly_series(spark, sf_dir)
    done = registry.model_run(s, "sma")[0]
    failed = registry.model_run(s, "holt_hw_add", {"seasonal_periods": 5000, **PLAIN})[0]
    for _ in range(2):
        sinks.append_events(sinks.header_event(spark, "run-1", {"models": "sma"}), path)
        sinks.append_events(sinks.completion_events(done, "run-1"), path)
        sinks.append_events(sinks.completion_events(failed, "run-1"), path)
        sinks.append_events(sinks.exported_event(spark, "run-1", "forecasts", "sma"), path)
    body = F.from_json("payload", "k string, model string, fitted_values_count bigint")
    return sinks.read_events(spark, path).select("run_id", "event", body.alias("p")).select(
        "run_id", "event", F.coalesce("p.k", F.lit("")).alias("k"), F.coalesce("p.model", F.lit("")).alias("model"),
        F.coalesce("p.fitted_values_count", F.lit(0)).cast("long").alias("n"))


@query
def fallback_forecast(spark, sf_dir):
    """Lines through series of one to seven rows: one row has no line, and its mean is forecast instead."""
    s = irregular_panel(order_lines(spark, sf_dir))
    return rounded(registry.forecast_points(registry.run_model(s, "lr"), s, 2), digits=7)


# --- validation and selection ---------------------------------------------------------------


def _rolling(spark, sf_dir, code, candidates, **folds):
    v = validate.validate(hourly_series(spark, sf_dir), code, candidates, validate.Folds.rolling(**folds), HW_GRID)
    return rounded(v, digits=6)


@query
def rolling_origin_sma(spark, sf_dir):
    return _rolling(spark, sf_dir, "sma", validate.expand_grid(validate.GRIDS["sma"]))


@query
def rolling_origin_linear(spark, sf_dir):
    return _rolling(spark, sf_dir, "lr", [{}])


@query
def rolling_origin_ses(spark, sf_dir):
    """Folds overlap here: 36 rows are tested every 24 rows."""
    return _rolling(spark, sf_dir, "ses", validate.expand_grid(validate.GRIDS["ses"]), horizon=36)


@query
def rolling_origin_holt(spark, sf_dir):
    return _rolling(spark, sf_dir, "holt", validate.expand_grid(validate.GRIDS["holt"]))


@query
def rolling_origin_hw_add(spark, sf_dir):
    return _rolling(spark, sf_dir, "holt_hw_add", [{"seasonal_periods": 24}])


@query
def rolling_origin_hw_mul(spark, sf_dir):
    return _rolling(spark, sf_dir, "holt_hw_mul", [{"seasonal_periods": 24}])


def _holdout(spark, sf_dir, code, candidates):
    """One fold: the last 30% of each series, whose errors are summed chunk by chunk."""
    return rounded(validate.validate(hourly_series(spark, sf_dir), code, candidates, validate.Folds.holdout(0.7), HW_GRID), digits=6)


@query
def holdout_sma(spark, sf_dir):
    return _holdout(spark, sf_dir, "sma", validate.expand_grid(validate.GRIDS["sma"]))


@query
def holdout_linear(spark, sf_dir):
    return _holdout(spark, sf_dir, "lr", [{}])


@query
def holdout_ses(spark, sf_dir):
    return _holdout(spark, sf_dir, "ses", validate.expand_grid(validate.GRIDS["ses"]))


@query
def holdout_holt(spark, sf_dir):
    return _holdout(spark, sf_dir, "holt", validate.expand_grid(validate.GRIDS["holt"]))


@query
def holdout_hw_add(spark, sf_dir):
    return _holdout(spark, sf_dir, "holt_hw_add", [{"seasonal_periods": 24}])


@query
def holdout_hw_mul(spark, sf_dir):
    return _holdout(spark, sf_dir, "holt_hw_mul", [{"seasonal_periods": 24}])


@query
def grid_tested(spark, sf_dir):
    tested = validate.grid_search(hourly_series(spark, sf_dir), "sma")
    return rounded(tested.withColumn("window", F.col("params")["window"]).drop("params"), "window", digits=6)


@query
def grid_select(spark, sf_dir):
    s = hourly_series(spark, sf_dir)
    out = None
    for code in registry.NAMES:
        best = validate.best_candidate(validate.grid_search(s, code))
        out = best if out is None else out.unionByName(best)
    return rounded(out.select("k", "model", "cand", "mean_mse", "std_mse"), digits=6)


@query
def box_search(spark, sf_dir):
    best = validate.box_search(hourly_series(spark, sf_dir), "ses", {"alpha": (0.01, 0.5, "real")}, calls=20)
    return rounded(best.select("k", "model", "cand", F.col("params")["alpha"].alias("alpha"), "mean_mse"), "alpha", digits=6)


@stored("validation_scores")
def validation_scores(spark, sf_dir):
    return validate.validation_run(hourly_series(spark, sf_dir), hw_grid=HW_GRID).select("k", "model", "cand", "mse", "std_mse")


def _ordered(df):
    """Position of the model in the fixed list, for ties."""
    names = F.array(*[F.lit(c) for c in registry.NAMES])
    return df.withColumn("model_order", F.array_position(names, F.col("model")))


@query
def validation_run(spark, sf_dir):
    return rounded(validation_scores(spark, sf_dir), digits=6)


@query
def select_model(spark, sf_dir):
    return rounded(select.select_best(_ordered(validation_scores(spark, sf_dir)), "AIC"), digits=6)


def _selected(spark, sf_dir, prefer):
    """The fitted models that have information criteria, by one of them."""
    records = information_criteria(spark, sf_dir).select("k", "model", "mse", "aic", "bic").filter(F.col("aic").isNotNull())
    return rounded(select.select_best(_ordered(records), prefer), digits=7)


@query
def select_by_aic(spark, sf_dir):
    return _selected(spark, sf_dir, "AIC")


@query
def select_by_bic(spark, sf_dir):
    return _selected(spark, sf_dir, "BIC")


@query
def compare_models(spark, sf_dir):
    records = information_criteria(spark, sf_dir).select("k", "model", "mse", "aic", "bic")
    return select.compare_models(records).withColumn("rank", F.col("rank").cast("long"))


@query
def model_runs(spark, sf_dir):
    """Run records of all six models."""
    s = hourly_series(spark, sf_dir)
    out = None
    for code in registry.NAMES:
        p = {"seasonal_periods": 12} if code.startswith("holt_hw") else {}
        record = registry.model_run(s, code, p)[0]
        out = record if out is None else out.unionByName(record)
    return out
