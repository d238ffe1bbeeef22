"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import release


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most_docs: int, most_bytes: int, fold=F.max, total: bool = False) -> list[tuple[int, str, int]]:
    """At most ``most_docs`` (doc_id, text, 0 or 1), each text of at most ``most_bytes`` bytes, in an order given by the ids.

    ``allowed``: condition on doc_id. Rows of ``labels`` are picked by a hash of the id, so that the
    pick does not depend on partitions; contradicting labels are combined by ``fold``. The picked
    ids (a bounded table) are broadcast, so texts are never shuffled. With ``total``, texts of any
    length come whole, and the order ends before ``most_bytes`` bytes of all texts are passed (only a
    single text over ``most_bytes`` is left out). Where an id has several texts, the one of the least hash counts.
    """
    truth = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    truth = truth.groupBy("doc_id").agg(fold("y").alias("y")).withColumn("h", F.xxhash64(F.lit(label), "doc_id")).orderBy("h", "doc_id").limit(most_docs)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes))
    if total:
        sizes = texts.join(F.broadcast(truth), "doc_id").groupBy("h", "doc_id").agg(F.max(F.octet_length("text")).alias("size")).toArrow()
        room, last = most_bytes, None
        for h, doc_id, size in sorted(zip(*(c.to_pylist() for c in sizes.columns))):
            room -= size
            if room < 0:
                truth = truth.filter((F.col("h") < last[0]) | ((F.col("h") == last[0]) & (F.col("doc_id") <= last[1])))
                break
            last = h, doc_id
    least = F.min_by(F.struct("text", "y"), F.struct(F.xxhash64("text"), "text")).alias("one")
    rows = texts.join(F.broadcast(truth), "doc_id").groupBy("doc_id").agg(least).select("doc_id", "one.text", "one.y")
    found = rows.toArrow()
    out = sorted(zip(*(c.to_pylist() for c in found.columns)))
    del found
    release()  # of the texts only the strings are needed while they are fitted
    return out
