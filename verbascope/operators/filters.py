"""Row filters of the browsing view, and of the scorer's input."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.functions import scores as s
from verbascope.functions import text as t


def missing_text(column: Column) -> Column:
    """Null or empty: an empty string does not survive a CSV round trip."""
    return column.isNull() | (column == "")


def drop_missing(df: DataFrame, column: str = "hypothesis") -> DataFrame:
    return df.where(~missing_text(F.col(column)))


def count_missing(df: DataFrame, keys: Sequence[str] = ("model", "dataset"), column: str = "hypothesis") -> DataFrame:
    """Rows before, dropped and kept by :func:`drop_missing`, per group."""
    gone = F.count_if(missing_text(F.col(column)))
    total = F.count(F.lit(1))
    return df.groupBy(*keys).agg(total.alias("n_before"), gone.alias("n_dropped"), (total - gone).alias("n_after"))


def member(column: str, values: Sequence[str] | None) -> Column | None:
    """Membership in a list; an empty list filters nothing."""
    return F.col(column).isin(list(values)) if values else None


def cleanliness(choice: str = "any") -> Column | None:
    """``any``, ``clean`` or ``polluted``; a missing score is polluted."""
    if choice == "any":
        return None
    if choice not in ("clean", "polluted"):
        raise ValueError(f"unknown cleanliness {choice!r}")
    clean = s.is_clean(F.col("ifeval"))
    return clean if choice == "clean" else ~clean


def within(column: str, bounds: tuple[float, float] | None) -> Column | None:
    """Inclusive range; a missing number counts as 0."""
    return s.zero_filled(F.col(column)).between(*bounds) if bounds is not None else None


def mentions(query: str | None, columns: Sequence[str] = ("source", "hypothesis")) -> Column | None:
    """Case-insensitive literal substring in any of the columns."""
    if not query:
        return None
    needle = F.lower(F.lit(query))
    return reduce(lambda a, b: a | b, [F.contains(F.lower(t.text_or_empty(F.col(c))), needle) for c in columns])


def select_rows(
    df: DataFrame,
    datasets: Sequence[str] | None = None,
    models: Sequence[str] | None = None,
    languages: Sequence[str] | None = None,
    ifeval: str = "any",
    comet_qe: tuple[float, float] | None = None,
    slang_density: tuple[float, float] | None = None,
    min_slang_hits: int = 0,
    text: str | None = None,
) -> DataFrame:
    """All filters together; one that is not given drops nothing. The slang ones apply only where the columns exist."""
    conditions = [
        member("dataset", datasets),
        member("model", models),
        member("language", languages),
        cleanliness(ifeval),
        within("comet_qe", comet_qe),
        mentions(text),
    ]
    if "slang_density" in df.columns:
        conditions.append(within("slang_density", slang_density))
        if min_slang_hits > 0:
            conditions.append(F.coalesce(F.col("slang_hits"), F.lit(0)) >= min_slang_hits)
    active = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, active)) if active else df
