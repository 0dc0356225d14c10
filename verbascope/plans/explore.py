"""Browsing scored rows and comparing models on the same source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.functions import scores as s
from verbascope.functions import text as t
from verbascope.operators.joins import semi_join_split
from verbascope.operators.ranking import first_per_key

# Limits of the browsing view.
BROWSE_LIMIT = 500
CANDIDATE_LIMIT = 500

SOURCE_KEY = ("id1", "id2", "language", "dataset")


def browse_order(sort_by: str, row_id: str = "row_id") -> list[Column]:
    """``worst``, ``best``, ``polluted`` or ``longest`` first, ties in input order."""
    orders = {
        "worst": [F.asc_nulls_first("comet_qe")],
        "best": [F.desc_nulls_last("comet_qe")],
        "polluted": [F.asc_nulls_last("ifeval"), F.asc_nulls_last("comet_qe")],
        "longest": [F.desc("source_chars")],
    }
    return [*orders[sort_by], F.asc(row_id)]


def browse(df: DataFrame, sort_by: str = "worst", limit: int = BROWSE_LIMIT, row_id: str = "row_id") -> DataFrame:
    """First rows in the chosen order, texts as previews; the sort holds the previews, not the texts."""
    short = df.select(
        "model",
        "dataset",
        "language",
        t.preview(F.col("source"), t.LABEL_LIMIT).alias("source_preview"),
        t.preview(F.col("hypothesis"), t.LABEL_LIMIT).alias("hyp_preview"),
        t.preview(F.col("reference"), t.LABEL_LIMIT).alias("reference_preview"),
        "ifeval",
        "comet_qe",
        *[c for c in ("slang_density", "slang_hits") if c in df.columns],
        "id1",
        "id2",
        row_id,
        t.char_length(F.col("source")).alias("source_chars"),
    )
    return short.orderBy(*browse_order(sort_by, row_id)).limit(limit).drop("source_chars")


def _compared(df: DataFrame, *measures: Column) -> DataFrame:
    """Models and rows per source key."""
    models, rows = F.count_distinct("model").alias("n_models"), F.count(F.lit(1)).alias("n_rows")
    return df.groupBy(*SOURCE_KEY).agg(models, rows, *measures)


def candidates(
    df: DataFrame, dataset: str | None = None, language: str | None = None, disagreements: bool = False
) -> DataFrame:
    """Sources that at least two models translated, keys with null parts included.

    ``disagreements`` keeps those one model kept clean and another polluted; keys with a null part never qualify.
    """
    if disagreements:
        low, high = F.min("ifeval").alias("low"), F.max("ifeval").alias("high")
        found = _compared(df.na.drop(subset=list(SOURCE_KEY)), low, high)
        found = found.where((F.col("low") < s.CLEAN) & (F.col("high") >= s.CLEAN)).drop("low", "high")
    else:
        found = _compared(df)
    found = found.where(F.col("n_models") >= 2)
    if dataset is not None:
        found = found.where(F.col("dataset") == dataset)
    if language is not None:
        found = found.where(F.col("language") == language)
    return found


def candidate_labels(df: DataFrame, limit: int | None = CANDIDATE_LIMIT, row_id: str = "row_id") -> DataFrame:
    """Candidates with a label made from the first row's source; ``None`` lists all of them.

    The preview is cut before the grouping, so that whole texts are never shuffled.
    """
    keys = list(SOURCE_KEY)
    short = df.select(*keys, "model", row_id, t.preview(F.col("source"), t.LABEL_LIMIT).alias("text"))
    named = (
        short.groupBy(*keys)
        .agg(
            F.min_by("text", row_id).alias("text"),
            (F.min("model") < F.max("model")).alias("compared"),
        )
        .where(F.col("compared"))
        .select(*keys, t.selector_label(F.col("dataset"), F.col("language"), F.col("text")).alias("label"))
    )
    if limit is None:
        return named
    return named.orderBy(*[F.asc_nulls_last(k) for k in keys]).limit(limit)


_SHOWN = ("model", "hypothesis", "reference", "ifeval", "comet_qe")


def side_by_side(df: DataFrame, key: Mapping[str, str | None], row_id: str = "row_id") -> DataFrame:
    """All outputs for one source key, best first; a null in the key matches nulls."""
    kept = df
    for column in SOURCE_KEY:
        kept = kept.where(F.col(column).eqNullSafe(F.lit(key[column]).cast("string")))
    return kept.select(*_SHOWN, row_id).orderBy(F.desc_nulls_last("comet_qe"), F.asc(row_id))


def side_by_side_all(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """The same for every source that two or more models translated, sorted by key."""
    keys = list(SOURCE_KEY)
    rows = semi_join_split(df.select(*keys, *_SHOWN, row_id), _compared(df), keys, "n_rows", F.col("n_models") >= 2)
    return rows.orderBy(*[F.asc_nulls_last(k) for k in keys], F.desc_nulls_last("comet_qe"), F.asc(row_id))


def first_references(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """First reference that is not null, per source key."""
    known = df.where(F.col("reference").isNotNull())
    return first_per_key(known, list(SOURCE_KEY), F.col("reference"), "reference", row_id)
