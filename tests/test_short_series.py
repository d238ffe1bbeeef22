"""Series of one chunk: totals, halos and prefix sums stay within the chunk, with the results of long series."""

import datetime

from pyspark.sql import functions as F

from seriesloom.operators import layout
from seriesloom.plans import validate
from seriesloom.sources.panel import irregular_panel

DAY = datetime.datetime(2020, 1, 1)


def lines(spark, sizes):
    """Some series, with repeated rows, repeated times, and missing keys, times and values."""
    rows = [(f"s{s}", DAY + datetime.timedelta(days=40 * (i // 2)), float((i * 7 + s * 3) % 11) if i % 5 else None) for s, n in enumerate(sizes) for i in range(n)]
    rows += rows[:3] + [(None, DAY, 1.0), (None, DAY, 2.0), ("s0", None, 5.0)]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_short_series_need_no_join_for_totals_halos_and_prefix_sums(spark):
    panel = irregular_panel(lines(spark, [1, 2, 5, 9]))
    assert layout.one_chunk(panel)
    assert "Join" not in plan(panel)
    assert "Join" not in plan(layout.with_halo(validate.sized(panel), before=3))
    assert "Join" not in plan(validate.sma_origins(panel, [3], validate.Folds.rolling(horizon=2, step=2)))


def test_chunk_length_changes_nothing(spark):
    raw = lines(spark, [1, 2, 5, 9, 40])
    folds = validate.Folds.rolling(horizon=3, step=2)
    found = []
    for rows in (16384, 40, 43, 4):
        panel = irregular_panel(raw.filter("v is not null or t is null"), rows)
        assert layout.one_chunk(panel) == (rows != 4)
        for code, grid in (("sma", {"window": [2, 24]}), ("lr", {}), ("ses", {"alpha": [0.3]})):
            out = validate.grid_search(panel, code, grid, folds)
            found.append((code, sorted((r.k, r.cand, round(r.mean_mse, 9) if r.mean_mse is not None else None, r.n_folds, r.n_failed) for r in out.collect())))
    for code in ("sma", "lr", "ses"):
        own = [rows for c, rows in found if c == code]
        assert own[0] and all(rows == own[0] for rows in own)


def test_numbers_are_those_of_time_buckets(spark):
    raw = lines(spark, [1, 2, 5, 9, 40])
    bucketed = raw.filter("k is not null and t is not null").withColumn("b", F.year("t"))
    want = layout.number_rows(bucketed, "b", [F.col("t"), F.col("v").asc_nulls_last()])
    got = layout.index_series(raw)
    rows = lambda df: sorted(map(str, df.select("k", "t", "v", "i").collect()))
    assert rows(got) == rows(want)
    assert layout.index_series(raw.limit(0)).count() == 0
