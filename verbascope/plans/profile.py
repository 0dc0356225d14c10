"""Profile of the source corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.functions import text as t
from verbascope.operators.metrics import means_and_quantiles_in_one_pass


def source_profile(rows: DataFrame) -> DataFrame:
    """Rows, text lengths, code-switching, languages and similarity per dataset; missing numbers skipped."""
    known = rows.where(F.col("dataset").isNotNull())
    means = {
        "mean_chars": F.col("text_chars"),
        "mean_words": F.col("text_words"),
        "pct_code_switched": F.col("is_code_switched").cast("double"),
        "mean_lang_count": F.col("lang_count"),
        "mean_sem_sim": F.col("semantic_similarity"),
    }
    lengths = {"median_chars": 0.5, "p90_chars": 0.9}
    return means_and_quantiles_in_one_pass(known, ["dataset"], means, F.col("text_chars"), lengths)


def language_counts(rows: DataFrame) -> DataFrame:
    """Rows per dataset and single language code; a row with two codes counts for both."""
    codes = rows.select("dataset", F.explode(t.code_list(F.col("lang_codes"))).alias("lang"))
    return codes.groupBy("dataset", "lang").agg(F.count(F.lit(1)).alias("n")).orderBy("dataset", F.desc("n"), "lang")


def code_switch_rate(rows: DataFrame) -> DataFrame:
    return rows.groupBy("dataset").agg(F.avg(F.col("is_code_switched").cast("double")).alias("pct_code_switched"))


def language_count_sizes(rows: DataFrame) -> DataFrame:
    """Rows per dataset and number of languages in a row."""
    keys = ["dataset", "lang_count"]
    return rows.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def language_breakdown(rows: DataFrame) -> DataFrame:
    """Rows per whole language value, a missing one counted too."""
    return rows.groupBy("lang_codes").agg(F.count(F.lit(1)).alias("n"))
