"""Moving-average and linear-trend models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.layout import attach
from ..operators.trend import trend_line
from ..operators.windows import last_values, moving_average

# Window of the stand-alone model and of the validation model.
SMA_WINDOW = 7
SMA_WINDOW_VALIDATION = 24


def sma_rows(df: DataFrame, window: int = SMA_WINDOW, partial: bool = False) -> DataFrame:
    return moving_average(df, window, partial, out="fitted")


def sma_state(df: DataFrame, window: int = SMA_WINDOW) -> DataFrame:
    """Flat forecast: mean of the last ``window`` values (all of them if there are fewer)."""
    return last_values(df, window).select("k", F.col("last_mean").alias("level"), F.lit(0.0).alias("slope"))


def linear_rows(df: DataFrame) -> DataFrame:
    line = trend_line(df).select("k", "slope", "intercept")
    return attach(df, line).withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("i")).drop("slope", "intercept")


def linear_state(df: DataFrame) -> DataFrame:
    """Value of the line at the last row, and its slope."""
    ends = df.groupBy("k").agg(F.max("i").alias("z"))
    return trend_line(df).join(ends, "k").select(
        "k", (F.col("intercept") + F.col("slope") * F.col("z")).alias("level"), "slope", "intercept", "r_squared")
