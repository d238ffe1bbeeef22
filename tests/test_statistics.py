import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.functions.special import chi2_tail, normal_cdf, t_two_sided
from seriesloom.operators import describe, lags, season, stationarity, trend
from seriesloom.operators import lags as lags_of  # where ``lags`` is a parameter
from seriesloom.operators.quantiles import bracketed_quantiles, radix_quantiles, series_quantiles


def test_tails(spark):
    df = spark.sql("select * from values (-2.86d, 1d, 1d), (0d, 2d, 0.5d), (1.5d, 2.5d, 2d), (-7d, 0.1d, 2d), (12d, 30d, 1d) v(x, t, df)")
    got = df.select("x", "t", "df", normal_cdf(F.col("x")).alias("n"), chi2_tail(F.col("t"), 2).alias("c")).collect()
    for r in got:
        assert r.n == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), abs=1e-14)
        assert r.c == pytest.approx(math.exp(-r.t / 2))
    t = spark.sql("select * from values (0.5d, 1d), (3d, 1d), (0.5d, 2d), (4d, 2d), (1.96d, 1e6d), (0d, 5d) v(t, df)").select(
        "t", "df", t_two_sided("t", "df").alias("p")).collect()
    for r in t:
        exact = {1: lambda x: 1 - 2 / math.pi * math.atan(x), 2: lambda x: 1 - x / math.sqrt(2 + x * x)}.get(
            int(r.df), lambda x: math.erfc(x / math.sqrt(2)))(r.t)
        assert r.p == pytest.approx(exact, abs=1e-6 if r.df > 2 and r.df < 1e6 else 1e-6)


def test_describe_matches_numpy(series):
    x = np.random.default_rng(2).gamma(2, 3, 101)
    r = describe.describe_series(series({"a": [None, *x]}, 10)).first()
    z = (x - x.mean()) / x.std()
    want = [101, x.mean(), np.median(x), x.std(ddof=1), x.var(ddof=1), x.min(), x.max(), *np.quantile(x, [0.25, 0.5, 0.75]),
            (z**3).mean(), (z**4).mean() - 3]
    assert list(r)[1:] == pytest.approx(want, rel=1e-12)


def test_constant_series_is_degenerate(series):
    df = series({"a": [5, 5, 5], "b": [5] * 60}, 10)
    r = describe.describe_series(df).filter("k = 'a'").first()
    assert (r.std, r.skewness, r.kurtosis) == (0.0, None, None)
    for test in (stationarity.adf_test, stationarity.kpss_test):
        assert {x.status for x in test(df).collect()} == {"degenerate"}
        assert {x.statistic for x in test(df).collect()} == {None}


@pytest.mark.parametrize("accuracy", [5, 50, 1000])
def test_bracketed_quantiles_are_exact(series, accuracy):
    rng = np.random.default_rng(3)
    data = {"cont": rng.normal(size=997), "ties": rng.integers(0, 4, 500).astype(float), "tail": rng.standard_cauchy(800),
            "one": np.array([3.0]), "two": np.array([1.0, 2.0]), "same": np.full(50, 7.0)}
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = series({k: [None, *v] for k, v in data.items()}, 64)
    got = {r.k: r.q for r in bracketed_quantiles(df, probs, accuracy=accuracy).collect()}
    short = {r.k: r.q for r in series_quantiles(df, probs).collect()}
    for k, v in data.items():
        assert got[k] == pytest.approx(list(np.quantile(v, probs)), rel=1e-12, abs=1e-12)
        assert short[k] == pytest.approx(got[k], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("rows", [16, 1000])
def test_radix_quantiles_need_no_bracket(series, rows):
    """Ties, outliers, both signs, neighbouring doubles, subnormal and huge values: all exact."""
    rng = np.random.default_rng(5)
    near = 1.0 + np.arange(200) * np.finfo(float).eps
    data = {"cont": rng.normal(size=301), "same": np.full(90, -7.5), "near": rng.permutation(np.concatenate([near, -near])),
            "wide": np.concatenate([rng.standard_cauchy(100), [1e300, -1e300, 5e-324, -5e-324, 0.0, -0.0]]),
            "ties": rng.integers(-2, 2, 250).astype(float), "one": np.array([3.0]), "two": np.array([-1.0, 2.0])}
    probs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = series({k: [None, *v] for k, v in data.items()} | {"empty": [None, None]}, rows)
    got = {r.k: r.q for r in radix_quantiles(df, probs).collect()}
    assert got.keys() == data.keys() | {"empty"} and got["empty"] == [None] * len(probs)
    for k, v in data.items():
        assert got[k] == pytest.approx(list(np.quantile(v, probs)), rel=1e-15, abs=0)
    assert {r.k: r.q for r in series_quantiles(df, probs, longest=10**9).collect()} == got
    assert radix_quantiles(df.limit(0), probs).collect() == []


@pytest.mark.parametrize("lead,lags", [(0, 300), (17, 90), (40, 400), (250, 100)])
def test_transformed_products_equal_dot_products(lead, lags):
    x = np.random.default_rng(6).normal(size=250).cumsum()
    direct = lags_of.direct_products(x, lead, lags)
    assert lags_of.transformed_products(x, lead, lags) == pytest.approx(direct, abs=1e-12 * (x @ x))


def test_many_lags_across_chunks(series):
    x = np.random.default_rng(7).normal(size=700).cumsum()
    c = x - x.mean()
    want = [c[j:] @ c[: len(c) - j] / (c @ c) for j in range(181)]
    for rows in (50, 1000):
        got = [r.acf for r in lags.autocorrelation(series({"a": x}, rows), 180).orderBy("lag").collect()]
        assert got == pytest.approx(want, abs=1e-11)


@pytest.mark.parametrize("rows", [30, 1000])
def test_autocorrelations(series, rows):
    x = np.cumsum(np.random.default_rng(4).normal(size=200))
    df = series({"a": x, "b": x[:9]}, rows)
    c = x - x.mean()
    acf = np.array([c[j:] @ c[: len(c) - j] / (c @ c) for j in range(21)])
    got = [r.acf for r in lags.autocorrelation(df, 20).filter("k = 'a'").orderBy("lag").collect()]
    assert got == pytest.approx(list(acf), abs=1e-12)
    assert lags.autocorrelation(df, 20).filter("k = 'b'").count() == 9
    pacf = []
    for m in range(1, 11):
        r = acf[np.abs(np.subtract.outer(range(m), range(m)))]
        pacf.append(np.linalg.solve(r, acf[1 : m + 1])[-1])
    got = [r.pacf for r in lags.partial_autocorrelation(df, 10).filter("k = 'a'").orderBy("lag").collect()]
    assert got == pytest.approx(pacf, abs=1e-9)


def _adf(x):
    """Textbook form: one regression per lag on a common sample, then the chosen lag on all rows."""
    n, d = len(x), np.diff(x)
    lags_ = int(min(n // 2 - 2, np.ceil(12 * (n / 100) ** 0.25)))

    def fit(p, first):
        t = np.arange(first, n - 1)
        z = np.column_stack([np.ones(len(t)), x[t], *[d[t - j] for j in range(1, p + 1)]])
        b, *_ = np.linalg.lstsq(z, d[t], rcond=None)
        e = d[t] - z @ b
        return b, e @ e, z, len(t)

    aic = []
    for p in range(lags_ + 1):
        _, sse, z, m = fit(p, lags_)
        aic.append(m * np.log(sse / m) + 2 * z.shape[1])
    p = int(np.argmin(aic))
    b, sse, z, m = fit(p, p)
    return b[1] / np.sqrt(sse / (m - z.shape[1]) * np.linalg.inv(z.T @ z)[1, 1]), p, m


@pytest.mark.parametrize("rows", [25, 1000])
def test_adf_matches_regressions(series, rows):
    rng = np.random.default_rng(5)
    data = {"walk": np.cumsum(rng.normal(size=180)) + 500, "noise": rng.normal(size=150), "ar": np.zeros(220), "short": rng.normal(size=12)}
    for i in range(1, 220):
        data["ar"][i] = 0.6 * data["ar"][i - 1] + rng.normal()
    got = {r.k: r for r in stationarity.adf_test(series(data, rows)).collect()}
    for k, x in data.items():
        stat, lag, nobs = _adf(x)
        assert (got[k].used_lag, got[k].nobs) == (lag, nobs)
        assert got[k].statistic == pytest.approx(stat, rel=1e-8)
    assert got["walk"].p_value > 0.05 > got["noise"].p_value


def test_adf_p_value_at_known_points(spark):
    x = spark.sql("select explode(array(-2.86d, -3.43d)) x")
    p = [r[0] for r in x.select(normal_cdf(stationarity._poly(stationarity.ADF_SMALL_P, F.col("x")))).collect()]
    assert p == pytest.approx([0.050, 0.010], abs=5e-4)


def test_kpss_matches_the_definition(series):
    x = np.cumsum(np.random.default_rng(6).normal(size=300)) * 0.1 + np.random.default_rng(7).normal(size=300)
    n, e = len(x), x - x.mean()
    g = np.array([e[j:] @ e[: n - j] for j in range(n)])
    cov = int(n ** (2 / 9))
    s0 = g[0] / n + sum(2 * g[j] / n for j in range(1, cov + 1))
    s1 = sum(2 * j * g[j] / n for j in range(1, cov + 1))
    lag = int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3))
    lrv = (g[0] + 2 * sum((1 - j / (lag + 1)) * g[j] for j in range(1, lag + 1))) / n
    want = (np.cumsum(e) ** 2).sum() / n**2 / lrv
    r = stationarity.kpss_test(series({"a": x}, 64)).first()
    assert r.used_lag == lag and r.statistic == pytest.approx(want, rel=1e-10)


def test_decomposition_adds_up(series, column):
    rng = np.random.default_rng(8)
    x = 0.1 * np.arange(120) + np.sin(np.arange(120) / 24 * 2 * np.pi) * 3 + rng.normal(0, 0.1, 120)
    parts = season.decompose(series({"a": x}, 30))
    trend_, sea, rest = (column(parts, c) for c in ("trend", "seasonal", "remainder"))
    w = np.r_[0.5, np.ones(23), 0.5] / 24
    assert trend_[12:-12] == pytest.approx(list(np.convolve(x, w, "valid")), abs=1e-10)
    assert trend_[:12] == [None] * 12 and trend_[-12:] == [None] * 12
    assert [t + s + r for t, s, r in zip(trend_[12:-12], sea[12:-12], rest[12:-12])] == pytest.approx(list(x[12:-12]))


def test_season_detection(series):
    r = {x.k: x for x in season.detect_seasonality(series({"a": [i % 24 for i in range(96)], "b": [i % 24 for i in range(47)]}, 50)).collect()}
    assert r["a"].has_seasonality and r["a"].strength == pytest.approx(1, abs=1e-6) and r["a"].period == 24 and r["a"].acf_max_lag == 95
    assert (r["b"].has_seasonality, r["b"].strength, r["b"].period, r["b"].acf_max_lag) == (False, 0.0, None, None)


def test_trend_classes(series):
    data = {"up": [3 + 2 * i for i in range(20)], "edge": [0.001 * i for i in range(2)], "down": [5 - i for i in range(9)],
            "flat": [0.0005 * i for i in range(9)], "noise": [1, -1, 1, -1, 1]}
    r = {x.k: x for x in trend.analyze_trend(series(data, 6)).collect()}
    assert (r["up"].slope, r["up"].intercept, r["up"].r_squared) == pytest.approx((2, 3, 1))
    assert (r["up"].trend_type, r["up"].direction, r["up"].significant, r["up"].total_change) == ("rising", "up", True, 38)
    assert r["edge"].slope == 0.001 and r["edge"].trend_type == "rising"
    assert (r["down"].trend_type, r["down"].direction) == ("falling", "down")
    assert r["flat"].trend_type == "stationary" and not r["noise"].significant
