import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import clean, profile, quantiles
from seriesloom.operators.layout import index_series, observed
from seriesloom.operators.quantiles import series_quantiles
from seriesloom.sources.files import parse_dates, series_from_wide
from seriesloom.sources.panel import NO_KEY, irregular_panel, panel_report, regular_panel

GAPS = [None, 10, None, 40, None, None]
HOURS = [0, 1, 2, 5, 6, 7]


@pytest.mark.parametrize("rows", [1, 2, 100])
def test_time_interpolation_weights_by_elapsed_time(series, column, rows):
    df = clean.interpolate_time(series({"a": GAPS}, rows, {"a": HOURS}))
    assert column(df, "v") == pytest.approx([None, 10, 17.5, 40, 40, 40])


def test_repeated_times_are_ordered_by_value(spark):
    rows = [("a", d, v) for d, v in [(1, 1.0), (2, None), (2, 3.0), (2, None), (3, 5.0)]]
    raw = spark.createDataFrame(rows, "k string, d int, v double").select(
        "k", F.expr("make_timestamp_ntz(2020, 1, d, 0, 0, 0)").alias("t"), "v")
    df = clean.interpolate_time(index_series(raw, 2))
    assert [r.v for r in df.orderBy("i").collect()] == [1.0, 3.0, 3.0, 3.0, 5.0]


def test_undated_rows_are_counted_and_dropped(spark):
    raw = spark.createDataFrame([("2020-01-01 00:00:00", 1.0), ("no date", 2.0), ("2020-01-01 01:00:00", 3.0)], "Date string, PJME_MW double")
    report = profile.date_report(parse_dates(raw.toDF("date", "v"))).first()
    assert (report.n_rows, report.n_dated, report.n_bad_dates) == (3, 2, 1)
    assert series_from_wide(raw).count() == 2


@pytest.mark.parametrize("rows", [3, 100])
def test_fences_replace_the_outlier(series, column, rows):
    steps = clean.clean_steps(series({"a": [*range(10, 19), 100]}, rows))
    r = profile.outlier_report(steps).first()
    assert (r.q1, r.q3, r.lower_bound, r.upper_bound) == (12.25, 16.75, 5.5, 23.5)
    assert (r.n_outliers, r.n_null, r.removal_pct) == (1, 0, 10.0)
    assert column(steps, "v_clean")[-1] == 18.0


def test_leading_null_is_not_an_outlier(series):
    steps = clean.clean_steps(series({"a": GAPS}, 100, {"a": HOURS}))
    r = profile.outlier_report(steps).first()
    assert (r.n_outliers, r.n_null) == (0, 1)
    m = profile.missing_report(steps).first()
    assert (m.n_rows, m.n_before, m.n_after, m.n_interpolated) == (6, 4, 1, 3)
    assert profile.clean_summary(steps).first().n_missing == 1


def test_cleaned_series_has_no_inner_null_and_any_chunk_length_agrees(series):
    rng = np.random.default_rng(1)
    hot = [None if rng.random() < 0.2 else x for x in rng.normal(50, 10, 300)]
    many = {f"s{j}": [None if rng.random() < 0.5 else x for x in rng.standard_t(2, 20)] for j in range(30)}
    got = {}
    for rows in (7, 1000):
        df = clean.clean(series({"hot": hot, **many}, rows))
        got[rows] = {(r.k, r.i): r.v for r in df.collect()}
    assert got[7].keys() == got[1000].keys()
    for key, v in got[7].items():
        assert v == pytest.approx(got[1000][key], rel=1e-12) if v is not None else got[1000][key] is None
    inside = [got[7][("hot", i)] for i in range(300)]
    first = next(i for i, v in enumerate(inside) if v is not None)
    assert all(v is not None for v in inside[first:])


def test_a_hot_series_stays_in_small_chunks(series):
    df = observed(series({"hot": [float(i % 5) if i % 3 else None for i in range(500)], **{f"s{j}": [1.0] * 10 for j in range(50)}}, 16))
    assert df.groupBy("k", "chunk").count().agg(F.max("count")).first()[0] <= 16
    hot = [r.i for r in df.filter("k = 'hot'").orderBy("t").collect()]
    assert hot == list(range(333))


def test_regular_panel_fills_the_grid(spark):
    raw = spark.sql("""select k, timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, h) t, v from values
        ('a', 0, 1.0d), ('a', 0, 2.0d), ('a', 5, 7.0d), ('b', 3, 4.0d) x(k, h, v)""")
    df = regular_panel(raw, "1 hour", 4)
    got = [(r.k, r.i, r.chunk, r.v) for r in df.orderBy("k", "i").collect()]
    assert got == [("a", 0, 0, 3.0), *[("a", i, i // 4, None) for i in range(1, 5)], ("a", 5, 1, 7.0), ("b", 0, 0, 4.0)]


def test_irregular_panel_numbers_rows_across_time_buckets(spark):
    raw = spark.range(400).select(F.lit("a").alias("k"), F.expr("timestamp_ntz'2000-01-01' + make_interval(0, 0, 0, id * id)").alias("t"),
                                  F.col("id").cast("double").alias("v"))
    got = irregular_panel(raw, 50).orderBy("t").collect()
    assert [r.i for r in got] == list(range(400)) and [r.chunk for r in got] == [i // 50 for i in range(400)]


def raw_rows(spark, rows):
    data = [(k, None if h is None else dt.datetime(2020, 1, 1) + dt.timedelta(minutes=m), v) for k, h, m, v in ((k, t, (t or 0), v) for k, t, v in rows)]
    return spark.createDataFrame(data, "k string, t timestamp_ntz, v double")


def test_no_row_gets_lost(spark):
    raw = raw_rows(spark, [("a", 0, 11.0), ("a", 0, 12.0), ("a", 60, 1.0), (None, 0, 5.0), ("a", None, 9.0)])
    kept = [(r.k, r.i, r.v) for r in irregular_panel(raw, 50).orderBy("k", "i").collect()]
    assert kept == [(NO_KEY, 0, 5.0), ("a", 0, 11.0), ("a", 1, 12.0), ("a", 2, 1.0)]
    assert [(r.k, r.v) for r in irregular_panel(raw, 50, ties="mean").orderBy("k", "i").collect()] == [(NO_KEY, 5.0), ("a", 11.5), ("a", 1.0)]
    assert panel_report(raw).first().asDict() == {"n_rows": 5, "n_without_time": 1, "n_without_key": 1, "n_repeated": 1}


def test_rows_off_the_grid_stop_the_run(spark):
    raw = raw_rows(spark, [("a", 0, 1.0), ("a", 90, 7.0), ("a", 120, 2.0)])
    with pytest.raises(Exception, match="off the grid: series a at 2020-01-01 01:30"):
        regular_panel(raw, "1 hour", 4).collect()


def test_both_quantile_ways_keep_every_series(series):
    data = {"null": [None] * 5, "one": [3.0], "flat": [2.0] * 9, "long": [float(i * i % 101) for i in range(300)]}
    df = series(data, 16)
    short = {r.k: r.q for r in series_quantiles(df, [0.1, 0.5, 0.9]).collect()}
    long = {r.k: r.q for r in series_quantiles(df, [0.1, 0.5, 0.9], longest=10**9).collect()}
    clear = lambda d: {k: None if q is None or q[0] is None else [round(x, 9) for x in q] for k, q in d.items()}
    assert clear(short) == clear(long) and set(short) == set(data)


def test_the_length_of_one_series_does_not_touch_another(series, monkeypatch):
    data = {"null": [None] * 5, "short": [1.0, 4.0, None, 9.0], "long": [float(i * i % 101) for i in range(300)]}
    df = series(data, 16)
    want = {r.k: r.q for r in series_quantiles(df, [0.25, 0.75]).collect()}
    monkeypatch.setattr(quantiles, "BUFFER_ROWS", 100)
    got = {r.k: r.q for r in series_quantiles(df, [0.25, 0.75]).collect()}
    assert {k: q and [round(x, 9) for x in q] for k, q in got.items()} == {k: q and [round(x, 9) for x in q] for k, q in want.items()}
