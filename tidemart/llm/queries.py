"""Named queries of this package and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import (
    chat, classes, mixing, packing, prefixes, private, quality, rules, simhash, toxicity, trie, vectors, whitening)
from tidemart.session import tune


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of poor quality and, after it in the chain, of toxicity of every document."""
    chain = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"), chain)


def op2_class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    """Class bigram and unigram scores of every document."""
    return classes.judge(table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Pre-tokens, unigram tokens and their log probability of every document."""
    return trie.token_counts(table(spark, folder, "documents"))


def op4_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return packing.pack(table(spark, folder, "documents"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity, threshold of the language and verdict of every document."""
    trusted = rules.trusted_labels(table(spark, folder, "labels"))
    return quality.judge(table(spark, folder, "documents"), trusted).drop("mark")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts, verdict and score of every document."""
    trusted = rules.trusted_labels(table(spark, folder, "labels"))
    return rules.judge(table(spark, folder, "documents"), trusted).drop("mark")


def op7_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every conversation and of one whose texts hold control strings, read back from
    the marked text."""
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    return chat.digests(chat.formatted(chat.canonical(rows.select("conv_id", "turn", record.alias("record")))))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Size, target of the source and words taken, for every document."""
    return mixing.decisions(table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations."""
    return prefixes.conversation_trie(table(spark, folder, "conversations"))


def op12_private_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of base spans, their digest, and all spans of personal data of every document."""
    return private.digests(private.spans(table(spark, folder, "documents")))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the 32 strongest axes, with unit variance on each."""
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_class_ngrams, op3_token_counts, op4_length_buckets, op5_quality_classifier, op6_quality_rules,
    op7_embeddings, op8_chat, op9_mixing, op10_simhash, op11_prefix_trie, op12_private_spans, op13_whitening)}

ORACLES: dict[str, str] = {"op9_mixing": mixing.ORACLE}
