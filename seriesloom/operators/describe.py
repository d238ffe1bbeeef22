"""Descriptive statistics per series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import BUFFER_ROWS, longest_series, series_quantiles

PROBS = (0.25, 0.5, 0.75)


def describe_series(df: DataFrame, col: str = "v", keys: tuple = ("k",), longest: int | None = None) -> DataFrame:
    """Count, mean, median, spread (n-1), extremes, exact quartiles, population shape measures."""
    keys = tuple(keys)
    if longest is None:
        longest = longest_series(df, keys, col)
    plain = [
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.var_samp(col).alias("variance"), F.min(col).alias("min"), F.max(col).alias("max"),
        F.skewness(col).alias("skewness"), F.kurtosis(col).alias("kurtosis"),
    ]
    # both ways give the same rows; the first spares a join
    if longest <= BUFFER_ROWS:
        # the quartiles ride along in the same pass
        table = df.groupBy(*keys).agg(*plain, F.percentile(col, F.array(*[F.lit(p) for p in PROBS])).alias("q"))
    else:
        table = df.groupBy(*keys).agg(*plain).join(series_quantiles(df, PROBS, col, keys), list(keys), "left")
    q = F.col("q")
    return table.select(*keys, "n", "mean", q[1].alias("median"), "std", "variance", "min", "max",
                        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "skewness", "kurtosis")
