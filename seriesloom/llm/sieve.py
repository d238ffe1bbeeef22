"""Bits of hashes of a distributed set, small enough to broadcast, and release of spent shuffle files."""

from __future__ import annotations

import gc

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sieve_of(rows: DataFrame, slot_bits: int) -> tuple[Broadcast, int]:
    """The set bits of column ``slot`` (of ``slot_bits`` bits), and how many of its upper bits they go by.

    64 bits are taken for each row, 2^``slot_bits`` at most, so the driver gets 32 MB at 28 bits, whatever the number of rows.
    """
    bits = min(slot_bits, max(16, rows.count().bit_length() + 6))
    slot = F.shiftright("slot", slot_bits - bits) + 1
    parts = rows.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("part")).collect()
    found = bytearray(1 << (bits - 3))
    for r in parts:
        found[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = r["part"]
    return rows.sparkSession.sparkContext.broadcast(bytes(found)), bits


def free(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are gone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
