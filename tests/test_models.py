import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.models import holt_winters, registry, simple, smoothing
from seriesloom.operators import diagnose, forecast, windows


def test_full_and_partial_moving_averages(series, column):
    s = series({"a": [1, 2, 3, 4], "b": [1, None, 3, 4]}, 2)
    assert column(windows.moving_average(s, 3), "ma") == [None, None, 2, 3]
    assert column(windows.moving_average(s, 2), "ma", "b") == [None, None, None, 3.5]
    assert column(windows.moving_average(s, 3, partial=True), "ma") == [1, 1.5, 2, 3]
    assert column(windows.weighted_moving_average(s, [3, 2, 1]), "wma") == [None, None, pytest.approx(14 / 6), pytest.approx(20 / 6)]


@pytest.mark.parametrize("rows", [1, 3, 50])
def test_windows_longer_than_a_chunk(series, column, rows):
    x = np.random.default_rng(0).normal(size=40)
    got = column(windows.moving_average(series({"a": x}, rows), 9), "ma")
    assert got[8:] == pytest.approx([x[i - 8 : i + 1].mean() for i in range(8, 40)])


@pytest.mark.parametrize("n,ratio,want", [(10, 0.8, (8, 2)), (3, 0.7, (2, 1)), (1, 0.8, (1, 0))])
def test_split(series, n, ratio, want):
    marked = windows.train_test_split(series({"a": range(n)}, 4), ratio)
    assert (marked.filter("part = 'train'").count(), marked.filter("part = 'test'").count()) == want
    b = windows.split_boundary(series({"a": range(n)}, 4), ratio).first()
    assert (b.n_train, b.n_test) == want and b.split_t.hour == want[0] - 1


def test_split_of_an_empty_frame(series):
    assert windows.train_test_split(series({"a": [1]}).filter("false")).count() == 0


def test_ses_by_hand(series, column):
    s = series({"a": [1, 3], "c": [5, 5, 5, 5]})
    fit = {r.k: r for r in smoothing.fit_smoothing(s, "ses", 0.5).collect()}
    assert (fit["a"].level0, fit["a"].sse, fit["a"].level) == pytest.approx((1.8, 3.2, 2.2))
    assert column(smoothing.fitted_smoothing(s, "ses", 0.5), "fitted") == pytest.approx([1.8, 1.4])
    assert (fit["c"].level0, fit["c"].sse, fit["c"].level) == pytest.approx((5, 0, 5), abs=1e-12)


def test_holt_on_a_line(series):
    s = series({"a": range(10)}, 4)
    r = smoothing.fit_smoothing(s, "holt", 0.3, 0.2).first()
    assert (r.level0, r.trend0, r.sse, r.level, r.trend) == pytest.approx((-1, 1, 0, 9, 1), abs=1e-9)


def _sse(x, a, b, level, trend):
    total = 0.0
    for v in x:
        f = level + trend
        total += (v - f) ** 2
        level, trend = f + a * (v - f), trend + a * b * (v - f)
    return total, level, trend


@pytest.mark.parametrize("rows", [7, 1000])
def test_smoothing_start_is_the_least_squares_one(series, column, rows):
    rng = np.random.default_rng(9)
    data = {"a": np.cumsum(rng.normal(size=150)) + 100, "b": rng.normal(size=33)}
    s = series(data, rows)
    for r in smoothing.fit_smoothing(s, "holt", 0.2, 0.1).collect():
        total, level, trend = _sse(data[r.k], 0.2, 0.1, r.level0, r.trend0)
        assert (r.sse, r.level, r.trend) == pytest.approx((total, level, trend), rel=1e-9)
        for dl, db in [(0.01, 0), (-0.01, 0), (0, 0.001), (0, -0.001)]:
            assert _sse(data[r.k], 0.2, 0.1, r.level0 + dl, r.trend0 + db)[0] >= total
    fitted = smoothing.fitted_smoothing(s, "holt", 0.2, 0.1)
    e = np.array(column(fitted, "v")) - np.array(column(fitted, "fitted"))
    r = smoothing.fit_smoothing(s, "holt", 0.2, 0.1).filter("k = 'a'").first()
    assert e @ e == pytest.approx(r.sse) and e.mean() == pytest.approx(r.resid_mean)


@pytest.mark.parametrize("fan", [2, 3, 512])
def test_grouped_scan_gives_the_same_states(series, fan):
    from seriesloom.models.blocks import params_column, series_blocks

    x = np.cumsum(np.random.default_rng(18).normal(size=61)) + 10
    blocks = series_blocks(series({"a": x, "b": x[:20]}, 5))
    states = smoothing.affine_states(blocks, 2, 5, params_column([(0.2, 0.1), (0.5, 0.3)]), fan=fan)
    for r in states.filter("k = 'a'").collect():
        a, b = [(0.2, 0.1), (0.5, 0.3)][r.cand]
        total, level, trend = _sse(x[: r.pos], a, b, r.start[0] + r.mean, r.start[1])
        assert r.sse == pytest.approx(total, rel=1e-7, abs=1e-9)
        assert (r.state[0] + r.mean, r.state[1]) == pytest.approx((level, trend), rel=1e-8, abs=1e-9)


def test_optimised_weight_beats_its_neighbours(series):
    rng = np.random.default_rng(10)
    x = np.cumsum(rng.normal(size=200)) + rng.normal(size=200)
    s = series({"a": x}, 64)
    best = smoothing.optimise_ses(s).first()
    for a in (best.alpha - 0.02, best.alpha + 0.02):
        assert smoothing.fit_smoothing(s, "ses", a).first().sse >= best.sse
    assert best.converged


@pytest.mark.parametrize("rows", [40, 1000])
def test_estimated_weights_of_each_series(series, column, rows):
    rng = np.random.default_rng(25)
    data = {"walk": np.cumsum(rng.normal(size=150)) + 50, "noise": 5 + rng.normal(size=150), "bend": np.cumsum(np.cumsum(rng.normal(size=150))), "flat": np.full(20, 3.0)}
    s = series(data, rows)
    fit = smoothing.optimise_smoothing(s, "holt").cache()
    got = {r.k: r for r in fit.collect()}
    assert set(got) == set(data) and got["flat"].sse == pytest.approx(0, abs=1e-12) and got["flat"].converged
    for k in ("walk", "noise", "bend"):
        r = got[k]
        total, level, trend = _sse(data[k], r.alpha, r.beta, r.level0, r.trend0)
        assert (r.sse, r.level, r.trend) == pytest.approx((total, level, trend), rel=1e-7)
        assert (r.alpha > got["noise"].alpha) or k == "noise"
    for a, b in ((0.2, 0.1), (0.5, 0.05), (0.9, 0.9), (0.05, 0.5)):  # no weights on a wide grid do better
        assert all(x.sse >= got[x.k].sse * (1 - 1e-9) - 1e-9 for x in smoothing.fit_smoothing(s, "holt", a, b).collect())
    near = {k: [(r.alpha + d, r.beta + e) for d, e in ((0.02, 0), (-0.02, 0), (0, 0.02), (0, -0.02))] for k, r in got.items()}
    for j in range(4):
        a, b = near["walk"][j]
        if 0 < a < 1 and 0 < b < 1:
            assert smoothing.fit_smoothing(s, "holt", a, b).filter("k = 'walk'").first().sse >= got["walk"].sse
    fitted = smoothing.fitted_smoothing(s, "holt", weights=fit)
    for k in ("walk", "bend"):
        e = np.array(column(fitted, "v", k)) - np.array(column(fitted, "fitted", k))
        assert e @ e == pytest.approx(got[k].sse, rel=1e-6)
    points, _ = registry.evaluate(s, "holt", 3)
    ends = {r.k: r.forecast for r in points.filter("step = 2").collect()}
    assert ends["walk"] == pytest.approx(got["walk"].level + 2 * got["walk"].trend)
    record = {r.k: r for r in registry.model_run(s, "ses", {"estimate_weights": True}, 2)[0].collect()}
    assert record["walk"].mse * 150 == pytest.approx(smoothing.optimise_ses(s).filter("k = 'walk'").first().sse, rel=1e-6)


def _hw(x, m, par, mul):
    a, b, c = par
    level = np.mean(x[:m])
    trend = (np.mean(x[m : 2 * m]) - level) / m
    season, total, fitted = [v / level if mul else v - level for v in x[:m]], 0.0, []
    for i, v in enumerate(x):
        s, base = season[i % m], level + trend
        f = base * s if mul else base + s
        fitted.append(f)
        total += (v - f) ** 2
        new = a * (v / s if mul else v - s) + (1 - a) * base
        trend = b * (new - level) + (1 - b) * trend
        season[i % m] = c * (v / base if mul else v - base) + (1 - c) * s
        level = new
    return total, level, trend, fitted, [season[(len(x) + j) % m] for j in range(m)]


GRID = [(0.1, 0.01, 0.1), (0.4, 0.1, 0.3), (0.7, 0.05, 0.05)]


@pytest.mark.parametrize("kind", ["add", "mul"])
@pytest.mark.parametrize("rows", [10, 1000])
def test_holt_winters_matches_a_loop(series, column, kind, rows):
    rng = np.random.default_rng(11)
    base = 50 + 0.2 * np.arange(90) + 10 * np.sin(np.arange(90) * 2 * np.pi / 7)
    data = {"a": base + rng.normal(size=90), "b": base[:40] + rng.normal(size=40), "short": base[:13], "neg": base[:30] - 55}
    s = series(data, rows)
    fit = holt_winters.fit_holt_winters(s, 7, kind, GRID, rounds=0)
    got = {r.k: r for r in fit.collect()}
    assert got["short"].status.startswith("error") and got["short"].alpha is None
    assert got["neg"].status == ("ok" if kind == "add" else "error: non-positive value")
    for k in ("a", "b"):
        runs = [_hw(data[k], 7, p, kind == "mul") for p in GRID]
        want = min(range(3), key=lambda j: runs[j][0])
        r = got[k]
        assert (r.alpha, r.beta, r.gamma) == GRID[want]
        assert (r.sse, r.level, r.trend) == pytest.approx(runs[want][:3], rel=1e-9)
        assert r.season == pytest.approx(runs[want][4], rel=1e-9)
        fitted = holt_winters.fitted_holt_winters(s, fit, 7, kind)
        assert column(fitted, "fitted", k) == pytest.approx(runs[want][3], rel=1e-9)
    finer = {r.k: r for r in holt_winters.fit_holt_winters(s, 7, kind, GRID, rounds=2).collect()}
    assert finer["a"].sse <= got["a"].sse


@pytest.mark.parametrize("rows,fan,most", [(8, 3, 30), (64, 2, 6), (64, 512, 6), (1024, 512, 3)])
def test_multiplicative_chunks_settle_on_the_loop(series, rows, fan, most):
    """One series in many chunks, none run by series: the states before all chunks are those of the plain loop."""
    m, n = 12, 2100
    rng = np.random.default_rng(21)
    t = np.arange(n)
    x = (100 + 0.05 * t + 20 * np.sin(t / 90)) * (1 + 0.3 * np.sin(t * 2 * np.pi / m)) * np.exp(0.05 * rng.normal(size=n))
    work = holt_winters._work(series({"hot": x}, rows), holt_winters.seasonal_start(series({"hot": x}, rows), m, True))
    from seriesloom.models.blocks import params_column
    from seriesloom.models.chunk_maps import settle

    full = work.filter("not is_last").select("k", "chunk", "y", params_column(GRID).alias("params"), "start")
    states, rounds = settle(full, m + 2, holt_winters._linearised(m, rows), fan)
    assert rounds <= most
    got = {r.chunk: np.array(r.state).reshape(len(GRID), m + 2) for r in states.collect()}
    assert sorted(got) == list(range(1, (n - 1) // rows + 1))
    for chunk, state in got.items():
        for j, par in enumerate(GRID):
            start_level = x[:m].mean()
            level, trend, season = start_level, (x[m : 2 * m].mean() - start_level) / m, list(x[:m] / start_level)
            for i in range(chunk * rows):
                s, base = season[i % m], level + trend
                new = par[0] * x[i] / s + (1 - par[0]) * base
                trend, level, season[i % m] = par[1] * (new - level) + (1 - par[1]) * trend, new, par[2] * x[i] / base + (1 - par[2]) * s
            assert state[j] == pytest.approx([level, trend, *[season[(chunk * rows + q) % m] for q in range(m)]], rel=1e-9, abs=1e-9)
        if rows == 8 and chunk > 40:
            break


@pytest.mark.parametrize("fan", [2, 512])
def test_affine_scan_in_groups(spark, fan):
    rng = np.random.default_rng(22)
    jac, off, start = rng.normal(size=(9, 2, 3, 3)) * 0.5, rng.normal(size=(9, 2, 3)), rng.normal(size=3)
    rows = [("a", c, start.tolist(), None if c == 5 else jac[c].ravel().tolist(), off[c].ravel().tolist()) for c in range(9)]
    from seriesloom.models.chunk_maps import scan_states

    maps = spark.createDataFrame(rows + [("b", *rows[0][1:])], "k string, chunk long, start array<double>, jac array<double>, off array<double>")
    got = {(r.k, r.chunk): r.state for r in scan_states(maps, 3, fan).collect()}
    state = np.tile(start, (2, 1))
    for c in range(9):
        state = off[c] + (0 if c == 5 else (jac[c] @ state[..., None])[..., 0])
        assert got["a", c + 1] == pytest.approx(state.ravel())
    assert len(got) == 10 and got["b", 1] == pytest.approx(got["a", 1])


@pytest.mark.parametrize("rows", [10, 33, 1000])
def test_additive_start_is_the_least_squares_one(series, column, rows):
    rng = np.random.default_rng(23)
    t = np.arange(100)
    data = {"a": 1000 + 0.5 * t + 12 * np.sin(t * 2 * np.pi / 6) + rng.normal(size=100), "b": 30 * rng.normal(size=40), "short": np.ones(11)}
    s = series(data, rows)
    plain = {r.k: r for r in holt_winters.fit_holt_winters(s, 6, "add", GRID, rounds=0).collect()}
    fit = holt_winters.fit_holt_winters(s, 6, "add", GRID, rounds=0, estimate_start=True)
    got = {r.k: r for r in fit.collect()}
    assert got["short"].status.startswith("error") and got["short"].start is None

    def run(x, par, start):
        level, trend, season, total, es = start[0], start[1], list(start[2:]), 0.0, []
        for i, v in enumerate(x):
            q, base = season[i % 6], level + trend
            es.append(v - base - q)
            new = par[0] * (v - q) + (1 - par[0]) * base
            trend, level, season[i % 6] = par[1] * (new - level) + (1 - par[1]) * trend, new, par[2] * (v - base) + (1 - par[2]) * q
        return np.array(es), level, trend, [season[(len(x) + j) % 6] for j in range(6)]

    for k in ("a", "b"):
        x, r = data[k], got[k]
        par = (r.alpha, r.beta, r.gamma)
        assert par == (plain[k].alpha, plain[k].beta, plain[k].gamma) and r.sse <= plain[k].sse
        e, level, trend, season = run(x, par, r.start)
        assert (r.sse, r.level, r.trend, r.resid_mean) == pytest.approx((e @ e, level, trend, e.mean()), rel=1e-7, abs=1e-8)
        assert r.season == pytest.approx(season, rel=1e-7, abs=1e-7)
        # The best of all starts: unit changes of the start are the columns of a least squares problem.
        base, _, _, _ = run(x, par, np.zeros(8))
        columns = np.array([run(np.zeros(len(x)), par, unit)[0] for unit in np.eye(8)]).T
        best = base + columns @ np.linalg.lstsq(columns, -base, rcond=1e-10)[0]
        assert r.sse == pytest.approx(best @ best, rel=1e-6)
        assert column(holt_winters.fitted_holt_winters(s, fit, 6, "add"), "fitted", k) == pytest.approx(x - e, rel=1e-7, abs=1e-7)


def test_future_grid_and_bands(series, spark):
    last = spark.sql("select 'a' k, timestamp_ntz'2018-08-03 00:00:00' last_t")
    grid = forecast.future_grid(last, 24).orderBy("step").collect()
    assert (str(grid[0].t), str(grid[-1].t), len(grid)) == ("2018-08-03 01:00:00", "2018-08-04 00:00:00", 24)
    points = spark.sql("select 'a' k, 1 step, 10d forecast union all select 'b', 1, 10d")
    spread = spark.sql("select 'a' k, 2d resid_std, 9d data_std union all select 'b', null, 3d")
    got = {r.k: (r.lower_95, r.upper_95) for r in forecast.with_bands(points, spread).collect()}
    assert got["a"] == pytest.approx((10 - 3.92, 10 + 3.92)) and got["b"] == pytest.approx((10 - 5.88, 10 + 5.88))


def test_interval_validation(spark):
    f = spark.sql("select 'a' k, * from values (1, 1d, 0d, 2d), (2, 2d, 0d, 4d), (3, 5d, 0d, 10d) x(step, forecast, lower_95, upper_95)")
    truth = spark.sql("select 'a' k, * from values (1, 1d), (2, 5d), (3, 9d) x(step, actual)")
    r = forecast.validate_intervals(f, truth).first()
    assert (r.coverage, r.mean_width, r.horizon) == pytest.approx((2 / 3, 16 / 3, 3))
    bare = forecast.validate_intervals(f.drop("lower_95", "upper_95"), truth).first()
    assert bare.mean_width == pytest.approx(2 * 1.96 * np.std([1, 2, 5], ddof=1))
    none = forecast.validate_intervals(f, truth.filter("false")).first()
    assert (none.coverage, none.mean_width, none.horizon) == (None, None, 0)


def test_error_measures_skip_zero_actuals(series):
    rows = series({"a": [0, 10, 20]}).withColumn("model", F.lit("m")).withColumn(
        "fitted", F.when(F.col("i") == 0, 1.0).when(F.col("i") == 1, 9.0).otherwise(22.0))
    r = diagnose.error_measures(diagnose.residuals(rows)).first()
    assert (r.mse, r.mae, r.mape) == pytest.approx((2, 4 / 3, 10))


def test_residuals_close_gaps_and_histogram_keeps_all_rows(series):
    x = np.random.default_rng(12).normal(size=100)
    rows = series({"a": x, "c": [3.0] * 12}, 9).withColumn("model", F.lit("m")).withColumn(
        "fitted", F.when(F.col("i") % 4 != 1, F.lit(0.0)))
    res = diagnose.residuals(rows).cache()
    assert [r.i for r in res.filter("k = 'a'").orderBy("i").collect()] == list(range(75))
    bins = diagnose.residual_histogram(res)
    kept = [v for i, v in enumerate(x) if i % 4 != 1]
    assert [r.n for r in bins.filter("k = 'a'").orderBy("bin").collect()] == list(np.histogram(kept, 30)[0])
    assert [r.n for r in bins.filter("k = 'c'").orderBy("bin").collect()] == [9] + [0] * 29
    q = diagnose.qq_points(res, 3).filter("k = 'a'").orderBy("p").collect()
    assert [r.residual_quantile for r in q] == pytest.approx(list(np.quantile(kept, [0.25, 0.5, 0.75])))
    lb = {r.k: r for r in diagnose.ljung_box(res).collect()}
    e = np.array(kept) - np.mean(kept)
    rho = [e[j:] @ e[:-j] / (e @ e) for j in range(1, 11)]
    assert lb["a"].lb_stat == pytest.approx(75 * 77 * sum(p * p / (75 - j) for j, p in enumerate(rho, 1)))
    assert lb["c"].lb_stat is None


def test_fallback_marks_missing_forecasts(series, spark):
    points = spark.sql("select 'a' k, 1 step, cast(null as double) forecast union all select 'a', 2, 7d")
    s = series({"a": [1, 2, 6]})
    got = [(r.forecast, r.status) for r in forecast.with_fallback(points, s, "mean").orderBy("step").collect()]
    assert got == [(3.0, "fallback"), (7.0, "ok")]
    assert forecast.with_fallback(points, s, "last").orderBy("step").first().forecast == 6.0


def test_model_run_records_failures(series):
    x = 50 + 5 * np.sin(np.arange(60) * 2 * np.pi / 12) + np.random.default_rng(13).normal(size=60)
    s = series({"a": x, "short": x[:15]}, 25)
    record, table = registry.model_run(s, "holt_hw_add", {"seasonal_periods": 12, "grid": GRID, "rounds": 0}, horizon=5)
    got = {r.k: r for r in record.collect()}
    assert got["a"].status == "ok" and got["a"].mse > 0 and got["a"].aic is not None and got["a"].aicc > got["a"].aic
    assert got["short"].status.startswith("error") and got["short"].mse is None
    assert [(r.k, r.step) for r in table.orderBy("k", "step").collect()] == [("a", j) for j in range(1, 6)]
    with pytest.raises(ValueError):
        registry.run_model(s, "nothing")


def test_evaluator_average_differs_from_the_model(series):
    s = series({"a": [1, 2, 3, 4, 5, 6, 7, 8]}, 3)
    points, rows = registry.evaluate(s, "sma", 2, {"window": 3})
    assert [r.forecast for r in points.orderBy("step").collect()] == [7.0, 7.0]
    assert [r.e for r in rows.orderBy("i").collect()] == pytest.approx([0, 0.5, 1, 1, 1, 1, 1, 1])
    assert simple.sma_rows(s, 3).filter("fitted is null").count() == 2


def test_information_criteria_fit_each_model_once(spark, series, monkeypatch):
    """The criteria and the fitted rows that they need come from the same runs."""
    import catalog

    own = series({k: [10.0 + (i % 24) + 0.01 * i * (k == "b") for i in range(96)] for k in "ab"})
    fits, fit = [], registry.run_model
    monkeypatch.setattr(catalog, "_stored", {})
    monkeypatch.setattr(catalog, "hourly_series", lambda spark, sf_dir: own)
    monkeypatch.setattr(registry, "run_model", lambda df, code, params=None: fits.append(code) or fit(df, code, params))
    got = {r["k"]: r["selected"] for r in catalog.select_by_aic(spark, "own rows").collect()}
    assert sorted(got) == ["a", "b"] and sorted(fits) == sorted(registry.NAMES)
