"""Model comparison tables: coverage, quality, speed, revisions, load counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.operators.joins import null_safe_join

# Datasets of the comparison, in column order.
SPLITS = ("mono_me", "mono_sea", "bilingual")


def coverage(scored: DataFrame, datasets: Sequence[str] = SPLITS) -> DataFrame:
    """Per model and dataset whether it ran, and on how many rows."""
    known = scored.where(F.col("dataset").isin(*datasets))
    counts = [F.count_if(F.col("dataset") == d).alias(d) for d in datasets]
    cells = [
        F.when(F.col(d) > 0, F.concat(F.lit("ran ("), F.col(d).cast("string"), F.lit(")")))
        .otherwise("missing")
        .alias(d)
        for d in datasets
    ]
    return known.groupBy("model").agg(*counts).select("model", *cells).orderBy("model")


def speed(scored: DataFrame, meta: DataFrame) -> DataFrame:
    """Elapsed time, throughput, concurrency and errors of the scored runs that have metadata."""
    keys = ["model", "dataset"]
    runs = scored.select(*keys).distinct()
    facts = meta.select(*keys, "elapsed_seconds", "req_per_s", "concurrency", "n_errors")
    return null_safe_join(runs, facts, keys).orderBy(*keys)


def revisions(meta: DataFrame) -> DataFrame:
    """Distinct revisions per model, sorted and comma-joined, and whether there is only one."""
    distinct = meta.where(F.col("model_revision").isNotNull()).select("model", "model_revision").distinct()
    listed = F.array_sort(F.collect_list("model_revision"))
    return distinct.groupBy("model").agg(
        F.array_join(listed, ",").alias("model_revision"),
        F.count(F.lit(1)).alias("n_revisions"),
        (F.count(F.lit(1)) == 1).alias("consistent"),
    )


def load_counts(rows: DataFrame, file: str = "file_name") -> DataFrame:
    """Rows, files and datasets loaded."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(file).alias("n_files"),
        F.count_distinct("dataset").alias("n_datasets"),
    )


def option_values(rows: DataFrame, columns: Sequence[str] = ("model", "dataset", "language")) -> DataFrame:
    """Distinct values of each column as (option, value), sorted; nulls left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("option"), F.col(c).alias("value")) for c in columns]))
    options = rows.select(*columns).distinct().select(pairs.alias("o")).select("o.option", "o.value")
    return options.where(F.col("value").isNotNull()).distinct().orderBy("option", "value")
