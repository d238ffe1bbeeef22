"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from seriesloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run of characters that are no ASCII white space


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def filled(column: pa.Array) -> pa.Array:
    """A text column as one plain string array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def release() -> None:
    """Give the memory that Arrow holds without need back to the system. Workers are kept between tasks, and what one keeps counts for its executor."""
    pa.default_memory_pool().release_unused()


def map_rows(df: DataFrame, keep: list[str], make: Callable, fields: list[T.StructField], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``df``, then ``fields``, which ``make`` computes from each batch of texts.

    ``make()`` is called once in a task and returns a function from a string array (nulls as empty
    texts) to a list of arrays, one for each field. ``df`` may have columns of the same names as
    ``fields``, unless they are in ``keep``.
    """
    given = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    source = df.select(*given, F.col(text).cast("string").alias("text"))
    kept = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    made = [T.StructField(f"m{i}", f.dataType) for i, f in enumerate(fields)]
    schema = T.StructType(kept + made)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                out = work(filled(batch.column(len(keep))))
                columns = [batch.column(i) for i in range(len(keep))] + list(out)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else (pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type)) for c, f in zip(columns, arrow)], schema=arrow)
                del out, columns
            del batch
            release()

    out = source.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"m{i}").alias(f.name) for i, f in enumerate(fields)])


def running_totals(df: DataFrame, order: list[str], totals: dict[str, str], name: str) -> DataFrame:
    """``df`` with, for each entry of ``totals`` (new column: long column), the sum over all rows before.

    Rows are range-partitioned by ``order`` and written; each partition counts within itself, and
    one row per partition (their number is a setting, not a property of the data) gives the sums
    of the partitions before. ``order`` should be total up to rows that are alike.
    """
    spark = df.sparkSession
    # The value of order's first column may be equal in very many rows, so the rest takes part in the ranges too.
    parts = materialize(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn("_part", F.spark_partition_id()), name)
    sums = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("_part", *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_sum_{n}") for n in totals])
    within = W.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(W.unboundedPreceding, -1)
    out = parts.join(F.broadcast(sums), "_part")  # at most spark.sql.shuffle.partitions rows
    out = out.withColumns({n: (F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"_sum_{n}")).cast("long") for n, c in totals.items()})
    return out.drop("_part", *[f"_sum_{n}" for n in totals])
