"""Choice among models and the comparison table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def score_models(models: DataFrame, prefer: str = "AIC") -> DataFrame:
    """Add ``score`` and ``score_metric``: the preferred metric, else MSE, else none."""
    name = prefer.lower()
    if name not in ("aic", "bic", "mse"):
        raise ValueError("prefer must be AIC, BIC or MSE")
    have = set(models.columns)
    col = lambda c: F.col(c) if c in have else F.lit(None).cast("double")
    wanted, mse = col(name), col("mse")
    metric = F.when(wanted.isNotNull(), F.lit(name)).when(mse.isNotNull(), F.lit("mse"))
    return models.withColumn("score", F.coalesce(wanted, mse)).withColumn("score_metric", metric)


def select_best(models: DataFrame, prefer: str = "AIC", order: str = "model_order") -> DataFrame:
    """One row per series: the model with the smallest score; models without a score come last.

    ``order`` breaks ties, so that the first model listed wins.
    """
    scored = score_models(models, prefer)
    rank = F.struct(F.col("score").isNull(), F.col("score"), F.col(order))
    best = scored.groupBy("k").agg(F.min_by(F.struct("model", "score", "score_metric"), rank).alias("b"))
    return best.select("k", F.col("b.model").alias("selected"), F.col("b.score").alias("score"),
                       F.col("b.score_metric").alias("score_metric"), F.lit(prefer).alias("preferred"))


def compare_models(models: DataFrame) -> DataFrame:
    """Rank per series: models with AIC by AIC, then by MSE, then the failed ones."""
    group = F.when(F.col("aic").isNotNull(), 0).when(F.col("mse").isNotNull(), 1).otherwise(2)
    order = Window.partitionBy("k").orderBy(group, F.coalesce("aic", "mse"), "model")
    return models.withColumn("rank", F.row_number().over(order))
