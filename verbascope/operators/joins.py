"""Joins that survive null keys, hot keys and small sides that turn out large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.session import stable_copy

# A side is broadcast only when its measured text form stays below this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024

# Copies made of a per-group table when a large table joins to it on the group alone.
SALTS = 32

# A key is hot when it holds more than this share of all rows, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with nulls matching nulls, keeping the left copy of each key; without keys, one row with one row."""
    if not keys:
        return left.withColumn("__one", F.lit(1)).join(right.withColumn("__one", F.lit(1)), "__one", how).drop("__one")
    other = right.select(*[F.col(c).alias(f"__right_{c}" if c in keys else c) for c in right.columns])
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])
    return left.join(other, matches, how).drop(*[f"__right_{k}" for k in keys])


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as JSON text, by one aggregation."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("bytes")).first()["bytes"]
    return size or 0


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Compute ``df`` once and say whether it may be broadcast; if so it carries the hint."""
    kept = stable_copy(df)
    fits = measured_bytes(kept) <= limit
    return (F.broadcast(kept) if fits else kept), fits


def spread_join(
    left: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join a large table to a one-row-per-group table, each group spread over ``salts`` partitions."""
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return null_safe_join(salted, copies, [*keys, "__salt"], how).drop("__salt")


def semi_join_split(
    df: DataFrame, counted: DataFrame, keys: Sequence[str], n_rows: str, wanted: Column, share: float = HOT_SHARE
) -> DataFrame:
    """Rows of ``df`` whose key fulfils ``wanted`` in ``counted``, which has every key with its rows in ``df``.

    The few hot keys, wanted or not, are broadcast, so that their rows stay where they are; all others shuffle.
    """
    total = df.agg((F.count(F.lit(1)) * share).alias("rows"))
    is_hot = F.col(n_rows) > total.scalar()
    hot = counted.where(is_hot)
    from_hot = null_safe_join(df, F.broadcast(hot.where(wanted).select(*keys)), keys, "left_semi")
    rest = null_safe_join(df, F.broadcast(hot.select(*keys)), keys, "left_anti")
    from_rest = null_safe_join(rest, counted.where(~is_hot & wanted).select(*keys), keys, "left_semi")
    return from_hot.unionByName(from_rest)
