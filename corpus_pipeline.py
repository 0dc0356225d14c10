"""From raw documents to token files: language ID, near-dedup, decontamination, mixing, token output."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope.llm import decontam, langid, minhash, mixing, tokens
from verbascope.llm.queries import TOKENIZER
from verbascope.session import ensure_checkpoint_dir

# A language is rejected if its share of the evidence is below this.
MIN_LANGUAGE_SCORE = 0.5

# The stages learn, compare and order by what they are given; SQL can express neither the models nor the token files.
ORACLE_SQL = None


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; rows stay as they are.

    Null and empty texts and those without a letter have no language and go. Repeated rows are judged alike and all stay;
    a missing id is a value like others. An empty table gives no rows.
    """
    found = langid.identify(docs, with_print=True).where(
        (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    )
    kept = found.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("__id"), F.col("print").alias("__print")).distinct()
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.withColumns({"__id": F.coalesce(key, F.lit(-(2**63))), "__print": F.xxhash64(key, text)})
    return _columns(rows.join(kept, ["__id", "__print"], "left_semi"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id.

    Ids come before missing ones; of texts that share the least id one stays. Rows equal in id and text become one. Texts
    without a word are alike to nothing and stay. An empty table gives no rows.
    """
    return _columns(minhash.keep_one(docs, minhash.near_duplicates(docs)), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts hold none and stay; rows without an id are judged like others, repeated rows alike. Items without
    an id, or without a letter or digit, are not looked for. An empty table of documents or of items takes nothing out.
    """
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Documents come whole, chosen in an order by hash that reruns repeat; a missing source is a source of its own, the
    last. Rows equal in id and text are one document whose shares add up. Rows without a word, and those the mix takes
    nothing of, go. An empty table gives no rows.
    """
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row for each document and copy.

    Null and empty texts give the end token only. Rows go by id, missing ones first. An empty table gives no rows.
    """
    return tokens.token_round_trip(docs, TOKENIZER)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
    ("tokens", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
