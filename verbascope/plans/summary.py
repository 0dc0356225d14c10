"""Summary of a set of scored runs: overall, per language, examples, and the bundle of all three."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.functions import scores as s
from verbascope.operators.exemplars import examples
from verbascope.operators.joins import null_safe_join
from verbascope.operators.metrics import metric_block, metric_blocks
from verbascope.session import stable_copy
from verbascope.sources.writers import write_bundle, write_summaries

RUN = ["model", "dataset"]


def with_run_meta(groups: DataFrame, meta: DataFrame) -> DataFrame:
    """Add what the run metadata says to a table of one row per run; runs without metadata stay.

    Of several records of one run the newest counts, so a repeated run does not multiply its rows.
    """
    time = F.col("timestamp") if "timestamp" in meta.columns else F.lit(None).cast("timestamp")
    figures = F.struct(time.alias("at"), "n_rows", "n_errors", "elapsed_seconds", "req_per_s")
    newest = meta.groupBy(*RUN).agg(F.max(figures).alias("newest"))
    facts = newest.select(
        *RUN, F.col("newest.n_rows").alias("n_source_rows"), *[f"newest.{c}" for c in ("n_errors", "elapsed_seconds", "req_per_s")]
    )
    joined = null_safe_join(groups, facts, RUN, "left")
    return joined.withColumn("error_rate", s.error_rate(F.col("n_errors"), F.col("n_source_rows")))


def overall(scored: DataFrame, meta: DataFrame, threshold: float = s.JOINT_THRESHOLD) -> DataFrame:
    """One row per model and dataset: metric block, and rows, errors and speed of the run."""
    return _overall(metric_block(scored, RUN, threshold), meta)


def _overall(block: DataFrame, meta: DataFrame) -> DataFrame:
    return with_run_meta(block.withColumnRenamed("n_rows", "n_rows_scored"), meta).select(
        *RUN,
        "n_rows_scored",
        "n_source_rows",
        "n_errors",
        "error_rate",
        "mean_ifeval",
        "mean_comet_qe",
        "median_comet_qe",
        "p10_comet_qe",
        "p90_comet_qe",
        "joint_pass_rate",
        "elapsed_seconds",
        "req_per_s",
    )


def by_language(
    scored: DataFrame, threshold: float = s.JOINT_THRESHOLD, low_sample: int = s.LOW_SAMPLE
) -> DataFrame:
    """One row per model, dataset and language, a missing language being one of them."""
    return _by_language(metric_block(scored, [*RUN, "language"], threshold), low_sample)


def _by_language(block: DataFrame, low_sample: int) -> DataFrame:
    return block.withColumn("low_sample", F.col("n_rows") < low_sample)


def both_levels(
    scored: DataFrame, meta: DataFrame, threshold: float = s.JOINT_THRESHOLD, low_sample: int = s.LOW_SAMPLE
) -> tuple[DataFrame, DataFrame]:
    """:func:`overall` and :func:`by_language` from one reading of the scored rows."""
    languages, runs = metric_blocks(scored, [[*RUN, "language"], RUN], threshold)
    return _overall(runs, meta), _by_language(languages, low_sample)


def write_summary(
    scored: DataFrame, meta: DataFrame, path: str, threshold: float = s.JOINT_THRESHOLD, results_dir: str = ""
) -> None:
    """Write the three summary tables and the bundle; no scored rows at all is an error."""
    if scored.isEmpty():
        raise ValueError("no scored rows")
    parts = *both_levels(scored, meta, threshold), examples(scored)
    tables = [stable_copy(part) for part in parts]
    write_summaries(*tables, path)
    write_bundle(*tables, f"{path}/summary_json", threshold, results_dir or path)
