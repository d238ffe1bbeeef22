"""From raw documents to packed training sequences: quality, toxicity, near duplicates, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import jaccard, mixing, packing, rules, toxicity
from seriesloom.llm.common import table
from seriesloom.session import materialize

OWN = ("doc_id", "text", "source")


def _apart(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with other columns under names that no operator uses, and those names."""
    names = [c if c in OWN else f"_extra{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    plain, names = _apart(docs)
    g = rules.Guarantee()
    # Counts are taken twice, once for the cutoffs and once beside the rows: cheaper than to store all texts again.
    counted = materialize(rules.text_counts(plain, ["doc_id"]), "rule-counts")
    broken = rules.broken(rules.calibrate(counted, table(spark, sf_dir, "labels"), g), g.bands)
    return rules.text_counts(plain, names).filter(~rules.base_failed() & (F.size(broken) == 0)).select(*names).toDF(*docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7."""
    plain, names = _apart(docs)
    scored = toxicity.detect(plain, table(spark, sf_dir, "labels"), F.lit(True), names)
    return scored.filter(F.col("score") < 0.7).select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    plain, names = _apart(docs)
    return jaccard.representatives(plain, width=5, over=80, under=100).select(*names).toDF(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    plain, names = _apart(docs)
    return mixing.mixed_documents(plain).select(*names).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packed),
]

#: Trained scores and hashed draws have no plain SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
