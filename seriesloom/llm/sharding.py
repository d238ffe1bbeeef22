"""Shards of near equal bytes by sampled splitters, in DataFrame functions only.

Rows are keyed by a hash of their text, so equal texts are neighbours. A sample drawn with
probability in proportion to the row's size gives quantile boundaries of the key, which cut the rows
into many more ranges than there are shards. Ranges whose exact bytes or rows are too many are
subdivided: one that holds a single text by a hash of doc_id, others evenly along the key. The
running bytes over all ranges then decide the shard. Equal texts stay together unless they alone
overfill a range.

Defined cases: a null text counts as empty (size 1, crc 0). Repeated rows are placed each. An empty
table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from seriesloom.session import materialize

LEAST, MOST = -(1 << 51), 1 << 51  # keys have 52 bits, which quantiles (doubles) keep exactly


def last_not_above(bounds: list[int], key: Column) -> Column:
    """Index of the last of the sorted ``bounds`` that is at most ``key``: a binary search."""
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(len(bounds) + 1)))))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"] + 1) / 2).cast("int")
        below = F.element_at(table, middle + 1) <= key
        return F.struct(F.when(below, middle).otherwise(state["low"]).alias("low"), F.when(below, state["high"]).otherwise(F.greatest(middle - 1, state["low"])).alias("high"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(bounds) - 1).alias("high")), halve)["low"]


def split_points(keyed: DataFrame, total: int, ranges: int, per_range: int) -> list[int]:
    """Sorted first keys of about ``ranges`` ranges; a key that fills more than one stands alone."""
    chance = (F.pmod(F.xxhash64(F.lit("sample"), "h", "tie"), F.lit(1 << 30)) + 0.5) / (1 << 30)
    sample = keyed.filter(chance * total < F.col("size") * (ranges * per_range))
    at = [i / ranges for i in range(1, ranges)]
    found = sample.agg(F.percentile_approx("h", at, 100 * ranges).alias("q")).head()["q"] or []  # ``ranges`` numbers
    bounds = {LEAST, *found}
    for a, b in zip(found, found[1:]):
        if a == b and a < MOST:
            bounds.add(a + 1)
    return sorted(bounds)


def shard(docs: DataFrame, shards: int = 8, ranges: int = 512, rows_in_range: int = 250_000, most_ranges: int = 4096, per_range: int = 32) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.shiftright(F.xxhash64(text), 12).alias("h"), F.xxhash64("doc_id", text).alias("tie"))
    keyed = materialize(keyed, "shard-keys")
    total, n = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).head()
    ranges = min(most_ranges, max(ranges, n // rows_in_range))
    bounds = split_points(keyed, total, ranges, per_range)
    ranged = keyed.withColumn("range", last_not_above(bounds, F.col("h")))

    # Exact loads; what comes to the driver is one row for each range.
    loads = {r["range"]: (r["bytes"], r["rows"]) for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
    parts = []
    for i in range(len(bounds)):
        size, rows = loads.get(i, (0, 0))
        parts.append(max(math.ceil(size * ranges / max(total, 1)) if size * ranges > 1.5 * total else 1, math.ceil(rows * ranges / max(4 * n, 1))))
    ends = [*bounds[1:], MOST]
    single = [int(b - a == 1) for a, b in zip(bounds, ends)]

    def of_range(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("range") + 1)

    cuts = of_range(parts, "int")
    along = F.floor((F.col("h").cast("double") - of_range(bounds, "double")) / (of_range(ends, "double") - of_range(bounds, "double")) * cuts)
    sub = F.when(cuts == 1, 0).when(of_range(single, "int") == 1, F.pmod("tie", cuts)).otherwise(F.greatest(F.lit(0), F.least(along, cuts - 1))).cast("int")
    parted = ranged.withColumn("sub", sub).withColumn("whole", (cuts == 1) | (of_range(single, "int") == 0))

    # Bytes before each part: one row for each part, at most about four times ``ranges``.
    loads = parted.groupBy("range", "sub").agg(F.sum("size").alias("bytes"))
    before = W.orderBy("range", "sub").rowsBetween(W.unboundedPreceding, -1)
    starts = loads.select("range", "sub", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"))
    # Within a part, rows are ordered by key; equal texts share the place of the first of them.
    order = W.partitionBy("range", "sub").orderBy("h", "tie", "size", "text_crc32")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    text_start = F.min("inside").over(W.partitionBy("range", "sub", "h"))
    placed = parted.withColumn("inside", inside).withColumn("at", F.when(F.col("whole"), text_start).otherwise(F.col("inside")))
    placed = placed.join(F.broadcast(starts), ["range", "sub"])
    placed = placed.withColumn("shard", F.least(F.floor((F.col("start") + F.col("at")).cast("double") * shards / max(total, 1)), F.lit(shards - 1)).cast("int"))
    placed = placed.withColumn("place", F.row_number().over(W.partitionBy("range", "sub", "shard").orderBy("h", "tie", "size", "text_crc32")) - 1)
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "range", "sub", "shard", "place"), "shard-places")
    counts = placed.groupBy("shard", "range", "sub").count()
    first = counts.select("shard", "range", "sub", F.coalesce(F.sum("count").over(W.partitionBy("shard").orderBy("range", "sub").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return placed.join(F.broadcast(first), ["shard", "range", "sub"]).select(  # as many rows as parts, and one more for each shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
