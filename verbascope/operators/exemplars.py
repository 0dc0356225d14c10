"""Best, worst and polluted example rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.functions import scores as s
from verbascope.functions import text as t
from verbascope.operators.joins import null_safe_join, small_side
from verbascope.operators.ranking import top_per_group
from verbascope.schema import SUMMARY_EXAMPLE

PER_CATEGORY = 5
EXAMPLE_COLUMNS = SUMMARY_EXAMPLE.fieldNames()


def _attach(rows: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fetch the wide columns of a few chosen rows; ranking itself never touches them.

    A row id is unique in its group only, so the group is part of the key.
    """
    chosen, _ = small_side(winners)
    return null_safe_join(rows, chosen, keys)


def examples(
    df: DataFrame, keys: Sequence[str] = ("model", "dataset"), n: int = PER_CATEGORY, row_id: str = "row_id"
) -> DataFrame:
    """Per group the ``n`` best clean rows, ``n`` worst rows and ``n`` worst polluted rows.

    Missing scores count as zero; ties keep input order; long texts are cut. A row may appear twice.
    ``position`` is the rank within the category.
    """
    filled = df.select(
        *keys,
        row_id,
        s.zero_filled(F.col("ifeval")).alias("ifeval"),
        s.zero_filled(F.col("comet_qe")).alias("comet_qe"),
    )
    clean = F.col("ifeval") >= s.CLEAN
    falling = [F.desc("comet_qe"), F.asc(row_id)]
    rising = [F.asc("comet_qe"), F.asc(row_id)]

    def category(rows: DataFrame, order, label: str) -> DataFrame:
        return top_per_group(rows, keys, order, n, rank="position").select(
            *keys, row_id, "ifeval", "comet_qe", F.lit(label).alias("category"), "position"
        )

    winners = (
        category(filled.where(clean), falling, "best")
        .unionByName(category(filled, rising, "worst"))
        .unionByName(category(filled.where(~clean), rising, "polluted"))
    )
    wide = df.select(*keys, row_id, "language", "source", "hypothesis", "reference")
    cut = {c: t.truncate(F.col(c)) for c in ("source", "hypothesis", "reference")}
    return _attach(wide, winners, [*keys, row_id]).withColumns(cut).select(*EXAMPLE_COLUMNS, "position")


def worst_rows(
    df: DataFrame, keys: Sequence[str] = ("model", "dataset"), n: int = PER_CATEGORY, row_id: str = "row_id"
) -> DataFrame:
    """Per file the ``n`` rows of lowest quality; rows without a score come last."""
    order = [F.asc_nulls_last("comet_qe"), F.asc(row_id)]
    winners = top_per_group(df.select(*keys, "comet_qe", row_id), keys, order, n).select(*keys, row_id)
    shown = [*keys, *[c for c in ("lang_codes", "source", "hypothesis", "comet_qe") if c in df.columns]]
    return _attach(df.select(*shown, row_id), winners, [*keys, row_id])
