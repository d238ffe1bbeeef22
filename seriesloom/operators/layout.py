"""Row positions, chunks and the joins that keep long series spread over tasks.

A chunk is a run of consecutive rows of one series.  Its length is fixed, so work that is
partitioned by ``(k, chunk)`` stays bounded even if one series holds a third of the input.
What has to cross chunk borders is carried by one summary row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 16384
_META = "rows_per_chunk"
_SHORT = "one_chunk"


def chunk_rows(df: DataFrame) -> int:
    """Rows per chunk, kept in the metadata of the ``chunk`` column."""
    meta = df.schema["chunk"].metadata
    if _META not in meta:
        raise ValueError("frame has no chunk length; build it with index_series()")
    return int(meta[_META])


def one_chunk(df: DataFrame) -> bool:
    """No series of the frame has a second chunk, as ``index_series`` found; do not add longer series to such a frame."""
    return bool(df.schema["chunk"].metadata.get(_SHORT, False))


def tag_chunk(chunk: Column, rows: int, short: bool = False) -> Column:
    return chunk.cast("long").alias("chunk", metadata={_META: int(rows)} | ({_SHORT: True} if short else {}))


def with_chunk(df: DataFrame, rows: int, short: bool = False) -> DataFrame:
    """Add ``chunk`` from the position ``i``."""
    keep = [c for c in df.columns if c != "chunk"]
    return df.select(*keep, tag_chunk(F.floor(F.col("i") / rows), rows, short))


def number_rows(df: DataFrame, bucket: str, order: list, keys: tuple = ("k",), out: str = "i") -> DataFrame:
    """0-based row number per series, without sorting a whole series in one task.

    ``bucket`` must not decrease along ``order``.  Rows are ranked inside their bucket; a running
    total over the bucket counts (one row per bucket) gives the first number of each bucket.
    """
    keys = list(keys)
    counts = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*keys, bucket, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    local = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order)) - 1
    ranked = df.withColumn("_rank", local).join(first, [*keys, bucket])
    return ranked.withColumn(out, (F.col("_first") + F.col("_rank")).cast("long")).drop("_rank", "_first")


def index_series(df: DataFrame, rows: int = ROWS_PER_CHUNK, span_seconds: int = 86400 * 30) -> DataFrame:
    """Add ``i`` and ``chunk`` to ``(k, t, v)``; ties in ``t`` are ordered by ``v``.

    Time buckets of ``span_seconds`` are halved until none holds more than sixteen chunks. Where no series is longer than
    that, each is numbered as a whole.
    """
    order = [F.col("t"), F.col("v").asc_nulls_last()]
    longest = df.groupBy("k").count().agg(F.max("count")).first()[0] or 0
    if longest <= 16 * max(rows, 4096):
        dated = df.filter(F.col("k").isNotNull() & F.col("t").isNotNull())
        place = (F.row_number().over(Window.partitionBy("k").orderBy(*order)) - 1).cast("long")
        return with_chunk(dated.withColumn("i", place), rows, longest <= rows)
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("t"))
    while span_seconds > 1:
        sizes = df.groupBy("k", F.floor(epoch / span_seconds).alias("_bucket")).count()
        if (sizes.agg(F.max("count")).first()[0] or 0) <= 16 * max(rows, 4096):
            break
        span_seconds = span_seconds // 2
    bucketed = df.withColumn("_bucket", F.floor(epoch / span_seconds))
    return with_chunk(number_rows(bucketed, "_bucket", order).drop("_bucket"), rows)


def observed(df: DataFrame, col: str = "v") -> DataFrame:
    """Rows with a value, renumbered per series; the old chunk serves as the bucket."""
    rows = chunk_rows(df)
    kept = df.filter(F.col(col).isNotNull()).withColumnRenamed("chunk", "_bucket").withColumnRenamed("i", "_i")
    return with_chunk(number_rows(kept, "_bucket", ["_i"]).drop("_bucket", "_i"), rows)


def attach(df: DataFrame, per_series: DataFrame, keys: tuple = ("k",)) -> DataFrame:
    """Join per-series values to rows on ``(k, chunk)``.

    A join on ``k`` alone would send a hot series to one task.  The small frame is spread over the
    chunks that exist first; whether a side is broadcast is left to its measured size.
    """
    spots = df.select(*keys, "chunk").distinct().join(per_series, list(keys))
    return df.join(spots, [*keys, "chunk"])


def with_totals(df: DataFrame, keys: tuple = ("k",), **totals: tuple) -> DataFrame:
    """Attach per-series ``sum``/``min``/``max`` of columns: ``name=(kind, column)``."""
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    if one_chunk(df):
        rest = [c for c in df.columns if c not in (*keys, "chunk")]
        return df.select(*keys, "chunk", *rest, *[fold[kind](c).over(Window.partitionBy(*keys)).alias(n) for n, (kind, c) in totals.items()])
    parts = df.groupBy(*keys, "chunk").agg(*[fold[kind](c).alias(n) for n, (kind, c) in totals.items()])
    whole = Window.partitionBy(*keys)
    spots = parts.select(*keys, "chunk", *[fold[kind](n).over(whole).alias(n) for n, (kind, _) in totals.items()])
    return df.join(spots, [*keys, "chunk"])


def with_halo(df: DataFrame, before: int = 0, after: int = 0) -> DataFrame:
    """Copy each row to every chunk whose rows may look at it, so that bounded frames are complete.

    ``home`` is true on the original rows.  ``before`` is the number of rows a frame looks back,
    ``after`` the number it looks ahead.  Only rows near a chunk edge are copied.
    """
    if one_chunk(df):
        return df.select(*[c for c in df.columns if c != "chunk"], "chunk", F.lit(True).alias("home"))
    rows = chunk_rows(df)
    own, i = F.col("chunk"), F.col("i")
    first = F.greatest(F.lit(0).cast("long"), F.floor((i - after) / rows)) if after else own
    last = F.floor((i + before) / rows) if before else own
    spread = df.withColumn("_chunk", F.explode(F.sequence(first, last)))
    keep = [c for c in df.columns if c != "chunk"]
    return spread.select(*keep, tag_chunk(F.col("_chunk"), rows), (F.col("_chunk") == own).alias("home"))


def only_home(df: DataFrame) -> DataFrame:
    return df.filter("home").drop("home")


def in_chunk(*order, keys: tuple = ("k",)) -> Window:
    return Window.partitionBy(*keys, "chunk").orderBy(*(order or ("i",)))
