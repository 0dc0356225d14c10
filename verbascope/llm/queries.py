"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope.llm import decontam, hardneg, langid, merkle, minhash, mixing, pii, quality, repeats, sharding, tokens, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_host_quality(spark, sf):
    found = quality.host_verdicts(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host", "host_rate"
    )


@query
def op2_source_mix(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op4_sanitisation(spark, sf):
    found = pii.find_personal_data(table(spark, sf, "documents"))
    count = [pii.count_of(k).alias(f"n_{k}") for k in pii.KINDS]
    base = F.sha2(pii.span_text(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *count, base.alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


@query
def op5_extendible_shards(spark, sf):
    return sharding.shards(table(spark, sf, "documents"))


@query
def op6_language_id(spark, sf):
    return langid.identify(table(spark, sf, "documents"))


@query
def op7_decontamination(spark, sf):
    return decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op8_token_files(spark, sf):
    return tokens.token_round_trip(table(spark, sf, "documents"), TOKENIZER)


@query
def op9_repeat_removal(spark, sf):
    found = repeats.remove_repeats(table(spark, sf, "documents"))
    has_repeat = (F.col("n_removed") > 0).alias("has_repeat")
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", has_repeat, "shares_passage")


@query
def op10_minmax_near_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents")).drop("print", "group")


@query
def op11_hard_negatives(spark, sf):
    """A seventh of the labels is moved on by one; every hundredth row is an anchor."""
    key, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    return hardneg.hard_negatives(table(spark, sf, "embeddings").withColumn("label", moved), key % 100 == 0)


@query
def op12_warc_revisits(spark, sf):
    return warc.archive_round_trip(table(spark, sf, "pages"))


@query
def op13_merkle_manifest(spark, sf):
    """The copy under test has lost the line ends of every text whose id has an even crc32."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.prove(table(spark, sf, "documents"), F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
