"""Token ids as ORC files: ascending ids, stripes that can be read apart, Bloom filters on doc_id.

Documents are range-partitioned and sorted by doc_id (nulls first; equal ids by text), encoded, and
written as one ORC file for each range: ``doc_id``, ``row_id`` (grows in the order of the whole
table) and ``ids`` as an array of int, which ORC stores run-length encoded. Row groups and stripes
carry minima, maxima and Bloom filters of doc_id, so ``lookup`` reads only stripes that may hold an
id, and a scan reads stripes in parallel.

Defined cases: a null or empty text holds the end id only. Repeated rows are written each. An empty
table writes files without rows.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import map_rows, running_totals
from seriesloom.llm.divergence import byte_slices
from seriesloom.session import materialize, shared_dir

SCHEMA = "doc_id long, row_id long, ids array<int>"
SLICE_BYTES, SLICE_ROWS = 8 << 20, 4096  # of texts that are encoded at once here


def encode_ids(docs: DataFrame, keep: list[str], vocabulary: str, end_id: int, text: str = "text") -> DataFrame:
    """``keep`` and ``ids``: the token ids of the text, then ``end_id``."""
    end = np.array([end_id], "<u4").tobytes()

    def make():
        from seriesloom.llm.tokens import encoder

        def work(texts: pa.Array) -> list:
            own, parts, sizes = encoder(vocabulary), [], []
            for a, b in byte_slices(texts, SLICE_BYTES, SLICE_ROWS):
                for raw in own.encode(texts.slice(a, b - a).to_pylist()):
                    parts.append(raw)
                    parts.append(end)
                    sizes.append(len(raw) // 4 + 1)
            offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int32)
            values = np.frombuffer(b"".join(parts), np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]

        return work

    return map_rows(docs, keep, make, [T.StructField("ids", T.ArrayType(T.IntegerType()))], text)


def write_token_files(docs: DataFrame, path: str | None = None, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2, stripe_bytes: int = 64 << 20, row_group: int = 10_000) -> str:
    """Write the ids of all ``docs`` in ascending order of doc_id; returns the folder."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.crc32("text"), F.col("text")]
    # The checksum spreads an id of very many rows over ranges; whole texts break the last ties within one.
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).withColumn("row_id", F.monotonically_increasing_id())
    (encode_ids(rows, ["doc_id", "row_id"], vocabulary, end_id).write
     .option("compression", "zstd").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(row_group)).option("orc.stripe.size", str(stripe_bytes)).orc(path))
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some ids; row groups that cannot hold them are skipped by their metadata."""
    return read_token_files(spark, path).filter(F.col("doc_id").isin(doc_ids))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids of all rows before), n_tokens, crc32 of the row's ids."""

    def run(batches):
        for batch in batches:
            ids = batch.column(2)
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
                                             names=["doc_id", "row_id", "n_tokens", "ids_crc32"])

    rows = read_token_files(spark, path).mapInArrow(run, "doc_id long, row_id long, n_tokens long, ids_crc32 long")
    rows = materialize(rows, "token-counts")  # the ranges below are drawn from it, and need not read the files again
    return running_totals(rows, ["row_id"], {"start": "n_tokens"}, "token-digest").select("doc_id", "start", "n_tokens", "ids_crc32")
