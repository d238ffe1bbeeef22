"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import id_remainder, table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import rules

    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("broken_rules", ",").alias("broken_rules"))


@query
def op1_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import toxicity

    scored = toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder("doc_id", 3) != 1)
    return scored.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"),
                         F.size("sentences").alias("n_offending"))


@query
def op5_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import neighbours

    scored = neighbours.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder("doc_id", 5) != 0)
    return scored.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))


@query
def op6_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_orc_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import token_files

    return token_files.digest(spark, token_files.write_token_files(table(spark, sf_dir, "documents")))


@query
def op3_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import sharding

    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op4_universe_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import jaccard

    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), width=3, over=90, under=100)


@query
def op8_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import suffix_tree

    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 7) == 2
    tree, unigrams = suffix_tree.grow(docs.filter(~held_out))
    return suffix_tree.score_texts(docs, tree, unigrams, held_out)


@query
def op2_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import collisions

    return collisions.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query
def op12_chunk_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import divergence

    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_filter_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import collocations

    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from seriesloom.llm import replies

    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return replies.digest(spark, replies.write_chats(replies.linear_messages(rows)))
