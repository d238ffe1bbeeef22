"""One row per chunk with the values as an array: the unit of work of the recursive models."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.layout import chunk_rows, with_totals

CELLS = 4_000_000


def series_blocks(df: DataFrame, with_time: bool = False) -> DataFrame:
    """``(k, chunk, n, mean, y[, t])`` from observed rows; arrays hold at most one chunk.

    The recursions cost far more per byte than a scan, so the rows keep the full number of shuffle
    partitions instead of being merged by size.
    """
    sized = with_totals(df.select("k", "t", "v", "i", "chunk").withColumn("one", F.lit(1)),
                        n=("sum", "one"), total=("sum", "v"))
    row = F.struct("i", "v", "t") if with_time else F.struct("i", "v")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrays = sized.repartition(parts, "k", "chunk").groupBy("k", "chunk").agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.first("n").alias("n"),
        (F.first("total") / F.first("n")).alias("mean"),
    )
    times = [F.transform("rows", lambda r: r["t"]).alias("t")] if with_time else []
    return arrays.select("k", F.col("chunk"), "n", "mean", F.transform("rows", lambda r: r["v"]).alias("y"), *times)


def origin_marks(rows: int, n: Column, first: Column, step: Column) -> Column:
    """Local row counts inside the chunk at which a validation fold starts."""
    start = F.col("chunk") * rows
    end = F.least(start + F.size("y"), n - 1)
    lo = F.greatest(first, first + step * F.ceil((start + 1 - first) / step))
    marks = F.transform(F.sequence(lo, end, step), lambda o: (o - start).cast("int"))
    return F.when(lo <= end, marks).otherwise(F.array().cast("array<int>"))


def params_column(candidates: list[tuple]) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in candidates])


def padded(arrays) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(a) for a in arrays])
    out = np.zeros((len(size), size.max() if len(size) else 0))
    for r, a in enumerate(arrays):
        out[r, : len(a)] = a
    return out, size


def pieces(pdf: pd.DataFrame, width: int):
    """Cut a batch so that padded work arrays stay small."""
    longest = max((len(a) for a in pdf["y"]), default=1) or 1
    take = max(1, CELLS // (longest + 50 * width))
    for start in range(0, len(pdf), take):
        yield pdf.iloc[start : start + take]


def chunk_runs(batches, by: str = "chunk"):
    """Consecutive rows with the same chunk number (or other counter)."""
    for pdf in batches:
        if len(pdf):
            cuts = np.flatnonzero(np.diff(pdf[by].to_numpy())) + 1
            for part in np.split(np.arange(len(pdf)), cuts):
                yield pdf.iloc[part]
