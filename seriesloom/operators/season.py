"""Classical additive decomposition and strength of season and trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .layout import attach, in_chunk, only_home, with_halo

# Default period, detection threshold, variance guard, longest lag inspected.
PERIOD = 24
SEASONAL_THRESHOLD = 0.05
VARIANCE_GUARD = 1e-9
ACF_LAGS = 168


def _with_trend(df: DataFrame, period: int) -> DataFrame:
    half = period // 2
    w = in_chunk("i")
    wide = w.rowsBetween(-half, half)
    if period % 2:
        mean = F.avg("v").over(wide)
    else:
        mean = (F.sum("v").over(w.rowsBetween(-half, half - 1)) + F.sum("v").over(w.rowsBetween(1 - half, half))) / (2 * period)
    full = F.count("v").over(wide) == 2 * half + 1
    return only_home(with_halo(df, before=half, after=half).withColumn("trend", F.when(full, mean)))


def decompose(df: DataFrame, period: int = PERIOD) -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``remainder`` to observed rows.

    The centred moving average needs half a period of neighbours on each side; the phase means are
    one short array per series.  Series shorter than two periods get NULL parts.
    """
    # written once: the means, the join of the seasons and the result all read it
    trended = materialize(_with_trend(df, period), "trended")
    phase = F.pmod(F.col("i"), F.lit(period)).cast("int")
    means = trended.groupBy("k", phase.alias("phase")).agg(
        F.avg(F.col("v") - F.col("trend")).alias("m"), F.count(F.lit(1)).alias("c"))
    seasons = means.groupBy("k").agg(
        F.array_sort(F.collect_list(F.struct("phase", "m"))).alias("ms"), F.avg("m").alias("mean"), F.sum("c").alias("n"),
    ).select("k", F.when(F.col("n") >= 2 * period, F.transform("ms", lambda x: x["m"] - F.col("mean"))).alias("season"))
    parts = attach(trended, seasons)
    usable = F.col("season").isNotNull()
    return parts.withColumn("seasonal", F.get("season", phase)) \
        .withColumn("trend", F.when(usable, F.col("trend"))) \
        .withColumn("remainder", F.col("v") - F.col("trend") - F.col("seasonal")).drop("season")


def detect_seasonality(df: DataFrame, period: int = PERIOD) -> DataFrame:
    """Seasonal and trend strength; short series get the fixed "none" record."""
    parts = decompose(df, period).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("remainder").alias("vr"), F.var_pop("seasonal").alias("vs"), F.var_pop("trend").alias("vt"))
    vr = F.col("vr")
    enough = F.col("n") >= 2 * period
    none = F.lit(None)

    def strength(v):
        return F.when(enough, 1 - vr / (v + vr + VARIANCE_GUARD)).otherwise(F.lit(0.0))

    return parts.select(
        "k", "n", (enough & (strength(F.col("vs")) > SEASONAL_THRESHOLD)).alias("has_seasonality"),
        F.when(enough, F.lit(period).cast("long")).otherwise(none).alias("period"),
        strength(F.col("vs")).alias("strength"), strength(F.col("vt")).alias("trend_strength"),
        F.when(enough, F.least(F.lit(ACF_LAGS).cast("long"), F.col("n") - 1)).otherwise(none).alias("acf_max_lag"),
    )
