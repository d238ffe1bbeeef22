"""Tail probabilities needed by the tests, one value per series."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function by its odd power series (exact to about 1e-15)."""
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(150)),
        F.struct(x.alias("term"), x.alias("total")),
        lambda a, n: F.struct(
            (a["term"] * x * x / (2 * n + 1)).alias("term"),
            (a["total"] + a["term"] * x * x / (2 * n + 1)).alias("total"),
        ),
    )["total"]
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    return F.when(x < -8, F.lit(0.0)).when(x > 8, F.lit(1.0)).when(x.isNotNull(), 0.5 + density * terms)


def chi2_tail(x: Column, df: int) -> Column:
    """Upper tail of the chi-square distribution for an even number of degrees of freedom."""
    if df % 2:
        raise ValueError("closed form needs even degrees of freedom")
    h = x / 2
    total = sum((F.pow(h, F.lit(k)) / math.factorial(k) for k in range(1, df // 2)), F.lit(1.0))
    return F.exp(-h) * total


@pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided tail of Student's t, by the continued fraction of the incomplete beta function."""
    t, n = t.to_numpy(float), df.to_numpy(float)
    with np.errstate(all="ignore"):
        x = n / (n + t * t)
        swap = x >= (n / 2 + 1) / (n / 2 + 2.5)
        a, b = np.where(swap, 0.5, n / 2), np.where(swap, n / 2, 0.5)
        z = np.where(swap, 1 - x, x)
        ln_beta = np.array([math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q) if p > 0 and q > 0 else np.nan
                            for p, q in zip(a, b)])
        front = np.exp(a * np.log(z) + b * np.log1p(-z) - ln_beta) / a
        c = np.ones_like(z)
        d = 1 / (1 - (a + b) * z / (a + 1))
        f = d.copy()
        for m in range(1, 300):
            for num in (m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m)),
                        -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 / (1 + num * d)
                c = 1 + num / c
                f = f * d * c
        tail = np.where(z <= 0, 0.0, front * f)
        p = np.where(swap, 1 - tail, tail)
        p = np.where(np.isinf(t), 0.0, p)
    return pd.Series(p)
