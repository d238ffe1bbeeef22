"""Moving averages, chronological splits and end-of-series values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layout import in_chunk, only_home, with_halo, with_totals


def moving_average(df: DataFrame, window: int, partial: bool = False, col: str = "v", out: str = "ma") -> DataFrame:
    """Trailing mean over ``window`` rows.

    Without ``partial`` the result is NULL until the window is full, and where it holds a NULL.
    """
    frame = in_chunk("i").rowsBetween(-(window - 1), 0)
    mean = F.avg(col).over(frame)
    if not partial:
        mean = F.when(F.count(col).over(frame) == window, mean)
    return only_home(with_halo(df, before=window - 1).withColumn(out, mean))


def weighted_moving_average(df: DataFrame, weights: list[float], col: str = "v", out: str = "wma") -> DataFrame:
    """Trailing weighted mean; ``weights[0]`` belongs to the newest row."""
    w = in_chunk("i")
    terms = [F.lag(col, j).over(w) * float(x) if j else F.col(col) * float(x) for j, x in enumerate(weights)]
    total = sum(terms[1:], terms[0]) / float(sum(weights))
    return only_home(with_halo(df, before=len(weights) - 1).withColumn(out, total))


def train_rows(n, ratio: float):
    return F.greatest(F.lit(1).cast("long"), F.floor(n * float(ratio)))


def train_test_split(df: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Mark each row as ``train`` or ``test`` by its position; no row is lost."""
    sized = with_totals(df.withColumn("_one", F.lit(1)), n=("sum", "_one")).drop("_one")
    return sized.withColumn("part", F.when(F.col("i") < train_rows(F.col("n"), ratio), "train").otherwise("test")).drop("n")


def split_boundary(df: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Last training timestamp and the two row counts."""
    marked = train_test_split(df, ratio)
    return marked.groupBy("k").agg(
        F.max(F.when(F.col("part") == "train", F.col("t"))).alias("split_t"),
        F.count_if(F.col("part") == "train").alias("n_train"), F.count_if(F.col("part") == "test").alias("n_test"),
    )


def last_values(df: DataFrame, window: int) -> DataFrame:
    """Last value, mean of the last ``window`` values, and size of each series of observed rows.

    The last rows are found by position against the series length, not by sorting.
    """
    sized = with_totals(df, last_i=("max", "i"))
    recent = F.col("i") > F.col("last_i") - window
    return sized.filter(recent).groupBy("k").agg(
        F.max_by("v", "i").alias("last_v"), F.max("t").alias("last_t"), F.avg("v").alias("last_mean"),
        (F.max("i") + 1).alias("n"),
    )
