"""Gap filling by time and replacement of outliers by interquartile fences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import in_range, micros_between
from ..session import materialize
from .layout import attach, in_chunk
from .quantiles import series_quantiles

# Quartiles and fence width.
QUARTILES = (0.25, 0.75)
FENCE_FACTOR = 1.5


def _edge_values(df: DataFrame, col: str) -> DataFrame:
    """Per chunk: the nearest value before it and after it in the series."""
    place = F.when(F.col(col).isNotNull(), F.col("i"))
    # min_by and max_by over plain columns keep this a hash aggregation; a struct would sort first
    edges = df.groupBy("k", "chunk").agg(
        F.min_by("t", place).alias("ht"), F.min_by(col, place).alias("hx"),
        F.max_by("t", place).alias("tt"), F.max_by(col, place).alias("tx"),
    ).select("k", "chunk", F.when(F.col("ht").isNotNull(), F.struct(F.col("ht").alias("t"), F.col("hx").alias("x"))).alias("head"),
             F.when(F.col("tt").isNotNull(), F.struct(F.col("tt").alias("t"), F.col("tx").alias("x"))).alias("tail"))
    back = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("k").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    return edges.select("k", "chunk", F.last("tail", True).over(back).alias("_before"),
                         F.last("head", True).over(ahead).alias("_after"))


def interpolate_time(df: DataFrame, col: str = "v", out: str | None = None, split: bool = True) -> DataFrame:
    """Fill inner gaps linearly in elapsed time, trailing gaps with the last value.

    Leading gaps stay NULL.  Neighbours are looked up inside the chunk; the last value before and
    the first value after a chunk come from one row per chunk.  ``split=False`` promises that no
    series has a second chunk.
    """
    out = out or col
    seen = F.when(F.col(col).isNotNull(), F.struct(F.col("t"), F.col(col).alias("x")))
    up = in_chunk("i").rowsBetween(Window.unboundedPreceding, 0)
    # both look-ups use the same order, so a chunk is sorted once
    near = (
        df.withColumn("_seen", seen)
        .withColumn("_p", F.last("_seen", True).over(up))
        .withColumn("_n", F.expr("lead(_seen) ignore nulls over (partition by k, chunk order by i)"))
    )
    if split:
        near = near.join(_edge_values(df, col), ["k", "chunk"]) \
            .withColumn("_p", F.coalesce("_p", "_before")).withColumn("_n", F.coalesce("_n", "_after"))
    p, n, x = F.col("_p"), F.col("_n"), F.col(col)
    share = micros_between(p["t"], F.col("t")) / F.nullif(micros_between(p["t"], n["t"]), F.lit(0))
    filled = (
        F.when(x.isNotNull(), x)
        .when(p.isNull(), F.lit(None).cast("double"))
        .when(n.isNull(), p["x"])
        .otherwise(p["x"] + (n["x"] - p["x"]) * F.coalesce(share, F.lit(0.0)))
    )
    return near.withColumn(out, filled).drop("_seen", "_p", "_n", "_before", "_after")


def iqr_fences(df: DataFrame, col: str = "v", longest: int | None = None) -> DataFrame:
    """Per series: exact quartiles and the fences around them."""
    q = series_quantiles(df, QUARTILES, col, longest=longest)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    q = q.select("k", q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"))
    return q.select("*", (F.col("q1") - FENCE_FACTOR * F.col("iqr")).alias("lower_bound"),
                    (F.col("q3") + FENCE_FACTOR * F.col("iqr")).alias("upper_bound"))


def clean_steps(df: DataFrame, longest: int | None = None) -> DataFrame:
    """All stages side by side: ``v`` raw, ``v_filled``, ``kept``, fences, ``v_clean``.

    ``df`` should be a stored frame.  The filled stage is written once, since both the quartiles
    and the masking read it.
    """
    top = df.agg(F.max("chunk").alias("c"), F.max("i").alias("i")).first()
    split, longest = bool(top.c), (top.i or 0) + 1 if longest is None else longest
    filled = materialize(interpolate_time(df, "v", "v_filled", split), "filled")
    fences = iqr_fences(filled, "v_filled", longest)
    # without a second chunk no series is long, and a join by series is safe
    fenced = attach(filled, fences) if split else filled.join(fences, "k")
    kept = in_range(F.col("v_filled"), F.col("lower_bound"), F.col("upper_bound"))
    masked = fenced.withColumn("kept", kept).withColumn("v_masked", F.when(kept, F.col("v_filled")))
    return interpolate_time(masked, "v_masked", "v_clean", split)


def clean(df: DataFrame, longest: int | None = None) -> DataFrame:
    """Cleaned series ``(k, t, v, i, chunk)``."""
    return clean_steps(df, longest).select("k", "t", F.col("v_clean").alias("v"), "i", "chunk")
