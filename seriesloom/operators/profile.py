"""Profiles of raw and cleaned frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if dict(df.dtypes)[name] in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))


def import_profile(df: DataFrame, time_col: str = "date") -> DataFrame:
    """One row per column: type, missing count and share, plus the figures of the whole table.

    A single aggregation reads the table once; the one result row is then unpivoted.
    """
    names = df.columns
    has_time = time_col in names
    first = F.min(time_col).cast("string") if has_time else F.lit(None).cast("string")
    last = F.max(time_col).cast("string") if has_time else F.lit(None).cast("string")
    row = df.agg(
        F.count(F.lit(1)).alias("n_rows"), first.alias("first_time"), last.alias("last_time"),
        *[F.count_if(_missing(df, c)).alias(f"m{j}") for j, c in enumerate(names)],
    )
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("data_type"), F.col(f"m{j}").alias("n_missing"))
        for j, (c, kind) in enumerate(df.dtypes)
    ])).alias("c")
    total = sum((F.col(f"m{j}") for j in range(1, len(names))), F.col("m0"))
    n_cells = F.col("n_rows") * len(names)
    return row.select(
        "n_rows", F.lit(len(names)).cast("long").alias("n_columns"), "first_time", "last_time",
        total.alias("missing_total"), _percent(n_cells - total, n_cells).alias("completeness_pct"), cells,
    ).select("c.column", "c.data_type", "c.n_missing", _percent(F.col("c.n_missing"), F.col("n_rows")).alias("missing_pct"),
             "n_rows", "n_columns", "first_time", "last_time", "missing_total", "completeness_pct")


def date_report(df: DataFrame, time_col: str = "t") -> DataFrame:
    """Rows with and without a usable time; the latter are dropped by the reader."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(time_col).alias("n_dated"),
                  F.count_if(F.col(time_col).isNull()).alias("n_bad_dates"))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows in series and time order."""
    return df.orderBy("k", "t", "v").limit(rows)


def missing_report(steps: DataFrame) -> DataFrame:
    """Missing values per series before and after the first interpolation."""
    n, before, after = F.count(F.lit(1)), F.count_if(F.col("v").isNull()), F.count_if(F.col("v_filled").isNull())
    return steps.groupBy("k").agg(
        n.alias("n_rows"), before.alias("n_before"), _percent(before, n).alias("before_pct"),
        after.alias("n_after"), _percent(after, n).alias("after_pct"), (before - after).alias("n_interpolated"),
    )


def outlier_report(steps: DataFrame) -> DataFrame:
    """Fences, replaced values and still missing values per series, the two counted apart."""
    n = F.count(F.lit(1))
    out = F.count_if(F.col("v_filled").isNotNull() & ~F.col("kept"))
    return steps.groupBy("k").agg(
        *[F.first(c).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
        out.alias("n_outliers"), F.count_if(F.col("v_filled").isNull()).alias("n_null"),
        _percent(out, n).alias("removal_pct"),
    )


def clean_summary(steps: DataFrame) -> DataFrame:
    """Rows, residual missing values and time range after cleaning."""
    return steps.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("v_clean").isNull()).alias("n_missing"),
        F.min("t").alias("first_t"), F.max("t").alias("last_t"),
    )
