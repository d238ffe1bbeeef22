import numpy as np
import pytest

from seriesloom.plans import select, validate


def _brute(x, n0, step, horizon, fit):
    """Refit on every prefix; returns origin -> (mse, coverage)."""
    out, start = {}, n0
    while start < len(x):
        test = x[start : start + horizon]
        fc, resid = fit(x[:start], len(test))
        half = 1.96 * np.std(resid)
        out[start] = (np.mean((test - fc) ** 2), np.mean((test >= fc - half) & (test <= fc + half)))
        start += step
    return out


def _sma(w):
    def fit(y, h):
        fitted = np.array([y[max(0, i - w + 1) : i + 1].mean() for i in range(len(y))])
        return np.repeat(fitted[-1], h), y - fitted

    return fit


def _line(y, h):
    i = np.arange(len(y))
    b, a = np.polyfit(i, y, 1)
    return a + b * np.arange(len(y), len(y) + h), y - a - b * i


def _smooth(alpha, beta):
    def fit(y, h):
        dim = 2 if beta is not None else 1
        starts = [np.zeros(2), np.array([1.0, 0.0]), np.array([0.0, 1.0])][: dim + 1]

        def run(state, values):
            out = []
            for v in values:
                f = state.sum()
                e = v - f
                out.append(f)
                state = np.array([f + alpha * e, state[1] + alpha * (beta or 0.0) * e])
            return np.array(out), state

        base, _ = run(starts[0], y)
        cols = np.column_stack([run(s, y)[0] - base for s in starts[1:]])
        x0, *_ = np.linalg.lstsq(cols, y - base, rcond=None)
        fitted, state = run(np.r_[x0, np.zeros(2 - dim)], y)
        return state[0] + state[1] * np.arange(1, h + 1), y - fitted

    return fit


CASES = [
    ("sma", [{"window": 3}, {"window": 10}], [_sma(3), _sma(10)]),
    ("lr", [{}], [_line]),
    ("ses", [{"alpha": 0.2}, {"alpha": 0.6}], [_smooth(0.2, None), _smooth(0.6, None)]),
    ("holt", [{"alpha": 0.3, "beta": 0.1}], [_smooth(0.3, 0.1)]),
]


@pytest.mark.parametrize("code,candidates,fits", CASES, ids=[c[0] for c in CASES])
@pytest.mark.parametrize("rows,horizon,step", [(16, 8, 8), (1000, 9, 4), (16, 3, 7)])
def test_folds_match_refitting_every_prefix(series, code, candidates, fits, rows, horizon, step):
    rng = np.random.default_rng(14)
    data = {"a": np.cumsum(rng.normal(size=70)) + 20, "b": rng.normal(size=45) + 5}
    got = validate.validate(series(data, rows), code, candidates, validate.Folds.rolling(horizon=horizon, step=step)).collect()
    seen = {(r.k, r.cand, r.origin): r for r in got}
    count = 0
    for k, x in data.items():
        for j, fit in enumerate(fits):
            for origin, (mse, cover) in _brute(x, max(2, len(x) // 2), step, horizon, fit).items():
                r = seen[(k, j, origin)]
                assert r.mse == pytest.approx(mse, rel=1e-7) and r.coverage == pytest.approx(cover)
                assert (r.train_end.day - 2) * 24 + r.train_end.hour == origin - 1
                count += 1
    assert count == len(got)


def test_default_folds(series):
    got = validate.validate(series({"a": range(100)}, 30), "lr", [{}], validate.Folds.rolling())
    assert sorted(r.origin for r in got.collect()) == [50, 74, 98]
    tests = validate.test_rows(series({"a": range(100)}, 30), validate.Folds.rolling()).filter("s > 0")
    assert sorted((r.origin, r["count"]) for r in tests.groupBy("origin").count().collect()) == [(50, 24), (74, 24), (98, 2)]


def test_holdout_is_one_fold(series):
    x = np.random.default_rng(15).normal(size=50)
    r = validate.validate(series({"a": x}, 20), "sma", [{"window": 5}], validate.Folds.holdout(0.7)).collect()
    assert len(r) == 1 and r[0].origin == 35
    summary = validate.with_every_series(validate.cv_summary(validate.validate(series({"a": x, "one": [1]}, 20), "sma", [{"window": 5}], validate.Folds.rolling())), series({"a": x, "one": [1]}, 20), "sma", 1)
    assert {x.k: x.mean_coverage is None for x in summary.collect()} == {"a": False, "one": True}
    assert r[0].mse == pytest.approx(np.mean((x[35:] - x[30:35].mean()) ** 2))


@pytest.mark.parametrize("code,params", [("sma", {"window": 5}), ("lr", {}), ("ses", {"alpha": 0.3}), ("holt", {"alpha": 0.3, "beta": 0.1}),
                                         ("holt_hw_add", {"seasonal_periods": 4}), ("holt_hw_mul", {"seasonal_periods": 4})])
def test_long_test_parts_go_by_chunk(series, code, params):
    """Errors of a test part are summed chunk by chunk: the same scores whatever the length of chunks, and no join or sum on the fold alone."""
    rng = np.random.default_rng(24)
    data = {"hot": 20 + np.cumsum(0.1 * rng.normal(size=120)) + np.tile([1, 2, 3, 2], 30), "b": 9 + rng.normal(size=30) ** 2}
    grid = [(0.3, 0.1, 0.2), (0.1, 0.05, 0.1)]
    got = [{r.k: r for r in validate.validate(series(data, rows), code, [params], validate.Folds.holdout(0.5), grid).collect()} for rows in (7, 1000)]
    for k in data:
        assert got[0][k].mse == pytest.approx(got[1][k].mse, rel=1e-8) and got[0][k].coverage == pytest.approx(got[1][k].coverage)
        assert got[0][k].train_end == got[1][k].train_end and got[0][k].origin == len(data[k]) // 2


def test_failed_folds_are_counted(series):
    x = 50 + 5 * np.sin(np.arange(60) * 2 * np.pi / 12) + np.random.default_rng(16).normal(size=60)
    folds = validate.Folds.rolling(initial_size=20, horizon=6, step=6)
    got = validate.validate(series({"a": x}, 16), "holt_hw_add", [{"seasonal_periods": 12}], folds, [(0.2, 0.05, 0.1), (0.5, 0.1, 0.3)])
    rows = {r.origin: r for r in got.collect()}
    assert rows[20].mse is None and rows[20].coverage == 0 and rows[26].mse > 0
    s = validate.cv_summary(got).first()
    assert (s.n_folds, s.n_failed) == (7, 1) and s.mean_mse == pytest.approx(np.mean([r.mse for r in rows.values() if r.mse is not None]))


def test_grid_and_box():
    assert validate.expand_grid({"a": [1, 2], "b": [3, 4]}) == [{"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]
    assert validate.expand_grid({}) == [{}]
    box = validate.box_candidates({"alpha": (0.01, 0.5, "real"), "window": (3, 48, "int")}, 25)
    assert len(box) == 25 and box == validate.box_candidates({"alpha": (0.01, 0.5, "real"), "window": (3, 48, "int")}, 25)
    assert all(0.01 <= c["alpha"] <= 0.5 and 3 <= c["window"] <= 48 and isinstance(c["window"], int) for c in box)


def test_best_candidate_order(spark):
    t = spark.sql("""select k, 'm' model, cand, map('p', double(cand)) params, mse mean_mse, 0d std_mse from values
        ('tie', 0, 2d), ('tie', 1, 2d), ('failed', 0, null), ('failed', 1, 1d), ('none', 0, null), ('none', 1, null) x(k, cand, mse)""")
    got = {r.k: r.cand for r in validate.best_candidate(t).collect()}
    assert got == {"tie": 0, "failed": 1, "none": 0}


def test_selection_falls_back_to_mse(spark):
    m = spark.sql("""select 'x' k, * from values ('A', 0, 10d, 5d), ('B', 1, null, 3d), ('C', 2, null, null) v(model, model_order, aic, mse)""")
    scores = {r.model: (r.score, r.score_metric) for r in select.score_models(m, "AIC").collect()}
    assert scores == {"A": (10.0, "aic"), "B": (3.0, "mse"), "C": (None, None)}
    assert select.select_best(m, "AIC").first().selected == "B"
    assert [r.model for r in select.compare_models(m).orderBy("rank").collect()] == ["A", "B", "C"]
    with pytest.raises(ValueError):
        select.score_models(m, "R2")


def test_box_search_equals_scoring_its_points(series):
    x = np.cumsum(np.random.default_rng(17).normal(size=80))
    s = series({"a": x}, 30)
    space = {"alpha": (0.05, 0.95, "real")}
    best = validate.box_search(s, "ses", space, calls=6).first()
    scored = validate.score_candidates(s, "ses", validate.box_candidates(space, 6)).collect()
    assert best.mean_mse == pytest.approx(min(r.mean_mse for r in scored), rel=1e-12)  # two runs may add the folds up in another order
