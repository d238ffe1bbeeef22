"""Linear trend on the row number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.special import t_two_sided

# Slope threshold and significance level.
FLAT_SLOPE = 0.001
SIGNIFICANCE = 0.05


def trend_line(df: DataFrame) -> DataFrame:
    """Slope, intercept and R² by one mergeable aggregation per series."""
    seen = df.filter(F.col("v").isNotNull())
    x = F.col("i").cast("double")
    return seen.groupBy("k").agg(
        F.count("v").alias("n"), F.regr_slope("v", x).alias("slope"), F.regr_intercept("v", x).alias("intercept"),
        F.regr_r2("v", x).alias("r_squared"),
        F.min("v").alias("min_value"), F.max("v").alias("max_value"),
        (F.max_by("v", "i") - F.min_by("v", "i")).alias("total_change"),
    )


def analyze_trend(df: DataFrame) -> DataFrame:
    """Trend line with slope test, class and direction; ``df`` holds observed rows."""
    line = trend_line(df)
    r2, slope, n = F.col("r_squared"), F.col("slope"), F.col("n")
    t = F.sqrt(r2 * (n - 2) / F.nullif(1 - r2, F.lit(0.0)))
    p = F.when(n < 3, F.lit(None).cast("double")).when(r2 >= 1, F.lit(0.0)).otherwise(t_two_sided(t, (n - 2).cast("double")))
    kind = (
        F.when(slope.isNull(), F.lit(None).cast("string")).when(F.abs(slope) < FLAT_SLOPE, "stationary")
        .when(slope >= FLAT_SLOPE, "rising").otherwise("falling")
    )
    way = F.when(slope > 0, "up").when(slope < 0, "down").when(slope == 0, "flat")
    return line.withColumn("p_value", p).withColumn("significant", F.col("p_value") < SIGNIFICANCE) \
        .withColumn("trend_type", kind).withColumn("direction", way)
