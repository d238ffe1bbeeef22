"""Exact quantiles per series, for short and for very long series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, LongType

from ..session import materialize
from .layout import attach

# A series with up to this many values is handled by one aggregation buffer.
BUFFER_ROWS = 5_000_000
SKETCH_ACCURACY = 10_000
SLICES = 1024
# Radix selection reads a double as 64 / DIGIT_BITS digits; a histogram has at most 2 ** DIGIT_BITS rows.
DIGIT_BITS = 16


def longest_series(df: DataFrame, keys: tuple = ("k",), col: str = "v") -> int:
    """Upper bound of the rows of any series; with positions at hand one column is enough."""
    if "i" in df.columns:
        return (df.agg(F.max("i")).first()[0] or 0) + 1
    return df.groupBy(*keys).agg(F.count(col).alias("n")).agg(F.max("n")).first()[0] or 0


def series_quantiles(df: DataFrame, probs, col: str = "v", keys: tuple = ("k",),
                     longest: int | None = None) -> DataFrame:
    """``(keys, q ARRAY<DOUBLE>)`` with linear interpolation between order statistics.

    Each series takes its own way: ``percentile`` keeps a value table, which is fine up to
    ``BUFFER_ROWS``; beyond, the ranks are found digit by digit (``radix_quantiles``).
    Both are exact and both keep a series without values, with NULL, so the length of one series
    does not touch the result of another.  ``longest`` is the caller's bound: up to ``BUFFER_ROWS``
    nothing is counted; above it, every series goes the long way.
    """
    keys = tuple(keys)

    def short(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.percentile(col, F.array(*[F.lit(float(p)) for p in probs])).alias("q"))

    if longest is not None and longest > BUFFER_ROWS:
        return radix_quantiles(df, probs, col, keys)
    if (longest_series(df, keys, col) if longest is None else longest) <= BUFFER_ROWS:
        return short(df)
    sizes = df.groupBy(*keys).agg((F.count(col) > BUFFER_ROWS).alias("_long"))
    sized = attach(df, sizes, keys)
    return short(sized.filter(~F.col("_long"))).unionByName(radix_quantiles(sized.filter("_long").drop("_long"), probs, col, keys))


@pandas_udf(LongType())
def ordered_bits(x: pd.Series) -> pd.Series:
    """The bits of a double as a long whose order is that of the doubles (NaN last); both zeros are one."""
    bits = np.where(np.isnan(x), np.nan, x.to_numpy(float) + 0.0).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits))


@pandas_udf(DoubleType())
def from_ordered_bits(b: pd.Series) -> pd.Series:
    bits = b.to_numpy(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits).view(np.float64))


def radix_quantiles(df: DataFrame, probs, col: str = "v", keys: tuple = ("k",)) -> DataFrame:
    """Exact quantiles by radix selection on the ordered bits of the values, all series at once.

    Each round counts one digit of the values that share the digits found so far, and running totals
    over these counts (at most 65,536 rows for a series and wanted rank) give the next digit. After
    the last round the digits are the value itself. Four rounds read the rows, whatever the values
    are: ties, outliers and all-equal series need no bracket and nothing can be missed. ``df`` has a
    ``chunk``; counts are combined on the map side, so a hot series shuffles its histogram only.
    The wanted ranks (two for each probability and series) are stored between rounds. A series
    without values has NULL.
    """
    probs, keys = [float(p) for p in probs], list(keys)
    values = df.filter(F.col(col).isNotNull()).select(*keys, "chunk", ordered_bits(F.col(col).cast("double")).alias("bits"))

    def digit(round_: int) -> Column:
        down = F.shiftright("bits", 64 - DIGIT_BITS * (round_ + 1))  # signed, so the first digit keeps the order
        return (down if round_ == 0 else F.pmod(down, F.lit(1 << DIGIT_BITS))).cast("long").alias("digit")

    def picked(counts: DataFrame, wanted: DataFrame | None) -> DataFrame:
        """The digit of each wanted rank, and the rank among the values that share it."""
        group = [*keys, "prefix"]
        running = counts.withColumn("end", F.sum("c").over(Window.partitionBy(*group).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)))
        if wanted is None:
            n = F.sum("c").over(Window.partitionBy(*group))
            ranks = F.array(*[F.struct(F.lit(j).alias("j"), up.alias("up"), rank.cast("long").alias("rank"), h.alias("h")) for j, p in enumerate(probs)
                              for h in [F.lit(p) * (F.col("n") - 1)] for up, rank in ((F.lit(0), F.floor(h)), (F.lit(1), F.ceil(h)))])
            met = running.withColumn("n", n).select(*group, "digit", "c", "end", F.inline(F.filter(ranks, lambda r: (r["rank"] < F.col("end")) & (r["rank"] >= F.col("end") - F.col("c")))))
        else:
            met = running.join(wanted, group).filter((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("c")))
        return met.select(*keys, "j", "up", "h", (F.col("rank") - F.col("end") + F.col("c")).alias("rank"),
                          (F.col("prefix") * (1 << DIGIT_BITS) + F.col("digit")).alias("prefix"))

    first = values.groupBy(*keys, digit(0)).agg(F.count(F.lit(1)).alias("c")).withColumn("prefix", F.lit(0).cast("long"))
    wanted = materialize(picked(first, None), "ranks")
    for round_ in range(1, 64 // DIGIT_BITS):
        sought = wanted.groupBy(*keys).agg(F.collect_set("prefix").alias("sought"))  # two numbers for each probability at most
        own = F.shiftright("bits", 64 - DIGIT_BITS * round_).alias("prefix")
        counts = attach(values, sought, keys).filter(F.array_contains("sought", F.shiftright("bits", 64 - DIGIT_BITS * round_))).groupBy(
            *keys, own, digit(round_)).agg(F.count(F.lit(1)).alias("c"))
        wanted = materialize(picked(counts, wanted), "ranks")
    x = wanted.withColumn("x", from_ordered_bits("prefix")).groupBy(*keys, "j", "h").agg(
        F.max(F.when(F.col("up") == 0, F.col("x"))).alias("lo"), F.max(F.when(F.col("up") == 1, F.col("x"))).alias("hi"))
    part = F.col("h") - F.floor("h")
    point = F.when(part == 0, F.col("lo")).otherwise(F.col("lo") + part * (F.col("hi") - F.col("lo")))
    found = x.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("j", point.alias("q")))).alias("p")).select(
        *keys, F.transform("p", lambda p: p["q"]).alias("q"))
    none = F.array(*[F.lit(None).cast("double")] * len(probs))
    return df.select(*keys).distinct().join(found, keys, "left").select(*keys, F.coalesce("q", none).alias("q"))


def bracketed_quantiles(df: DataFrame, probs, col: str = "v", keys: tuple = ("k",),
                        accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Exact quantiles in two passes over the rows, where the sketch holds every rank.

    1. One mergeable sketch per series gives a low and a high value around every wanted rank.
    2. Rows below the low value are only counted; rows inside are counted per distinct value.
    3. The inside is cut into slices; running totals over the slice counts pick the slices that
       hold the wanted ranks, and only those are ranked value by value.

    A rank that the bracket misses stops the run; a series without values has NULL.
    """
    probs = [float(p) for p in probs]
    keys = list(keys)
    margin = 2.0 / accuracy
    lows = [max(p - margin, 0.0) for p in probs]
    highs = [min(p + margin, 1.0) for p in probs]
    sketch = df.groupBy(*keys).agg(
        F.count(col).alias("n"), F.min(col).alias("lo_all"), F.max(col).alias("hi_all"),
        F.percentile_approx(col, [*lows, *highs], accuracy).alias("s"),
    )
    m = len(probs)
    # the sketch is off by at most n / accuracy ranks; below this size one rank more would matter
    small = F.col("n") < 4 * accuracy
    brackets = sketch.select(*keys, F.array(*[
        F.struct(
            F.lit(j).alias("j"),
            (F.lit(probs[j]) * (F.col("n") - 1)).alias("h"),
            (F.col("lo_all") if lows[j] <= 0 else F.when(small, F.col("lo_all")).otherwise(F.col("s")[j])).alias("lo"),
            (F.col("hi_all") if highs[j] >= 1 else F.when(small, F.col("hi_all")).otherwise(F.col("s")[m + j])).alias("hi"),
        ) for j in range(m)
    ]).alias("brackets"))
    x = F.col(col)
    per = attach(df.select(*keys, "chunk", col).filter(x.isNotNull()), brackets, keys).select(
        *keys, col, F.explode("brackets").alias("b")
    ).filter(x <= F.col("b.hi"))
    inside = x >= F.col("b.lo")
    width = F.nullif(F.col("b.hi") - F.col("b.lo"), F.lit(0.0))
    cells = per.select(
        *keys, "b",
        F.when(inside, F.least(F.lit(SLICES - 1), F.coalesce(F.floor((x - F.col("b.lo")) / width * SLICES), F.lit(0))))
        .otherwise(F.lit(-1)).cast("int").alias("slice"),
        F.when(inside, x).alias("x"),
    ).groupBy(*keys, "b", "slice", "x").agg(F.count(F.lit(1)).alias("c"))
    slices = cells.groupBy(*keys, "b", "slice").agg(F.sum("c").alias("sc"))
    upto = Window.partitionBy(*keys, "b.j").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    floor_h, ceil_h = F.floor("b.h"), F.ceil("b.h")
    wanted = (
        slices.withColumn("end", F.sum("sc").over(upto)).withColumn("start", F.col("end") - F.col("sc"))
        .filter((F.col("slice") >= 0) & (F.col("start") <= ceil_h) & (F.col("end") > floor_h))
        .select(*keys, F.col("b.j").alias("j"), "slice", "start")
    )
    inner = Window.partitionBy(*keys, "j", "slice").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        cells.withColumn("j", F.col("b.j")).join(wanted, [*keys, "j", "slice"])
        .withColumn("e", F.col("start") + F.sum("c").over(inner)).withColumn("s", F.col("e") - F.col("c"))
    )

    def at(rank):
        return F.max(F.when((F.col("s") <= rank) & (rank < F.col("e")), F.col("x")))

    values = ranked.groupBy(*keys, "b").agg(at(floor_h).alias("lo"), at(ceil_h).alias("hi"))
    point = F.col("lo") + (F.col("b.h") - floor_h) * (F.col("hi") - F.col("lo"))
    pairs = values.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("b.j").alias("j"), point.alias("q")))).alias("p"))
    found = pairs.select(*keys, F.transform("p", lambda p: p["q"]).alias("q"))
    whole = (F.size("q") == m) & ~F.exists("q", lambda x: x.isNull())
    missed = F.raise_error(F.lit("a quantile lies outside its bracket; raise the accuracy of the sketch"))
    return sketch.select(*keys, "n").join(found, keys, "left").select(
        *keys, F.when(F.coalesce(whole, F.lit(False)), F.col("q")).when(F.col("n") > 0, missed.cast("array<double>")).otherwise(
            F.array(*[F.lit(None).cast("double")] * m)).alias("q"))
