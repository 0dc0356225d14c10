"""First and best rows, per group or overall, with the input order as tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbascope.operators.joins import null_safe_join
from verbascope.session import stable_copy

# Up to this many rows a limit is merged in one task, which gets that many from every task before it;
# above it ranks are counted in parallel.
DIRECT_LIMIT = 1000

# From this many rows per group on, groups are first cut down in this many parts.
_WIDE_TOP = 100
_PARTS = 64

_BLOCK_BITS = 20


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str | None = None,
    row_id: str = "row_id",
) -> DataFrame:
    """First ``n`` rows of each group in ``order``; every task drops the rest before the shuffle.

    ``row_id`` spreads the parts of a group when ``n`` is large.
    """
    name = rank or "__rank"
    if n >= _WIDE_TOP and row_id in df.columns:
        parted = df.withColumn("__part", F.pmod(F.xxhash64(row_id), F.lit(_PARTS)))
        part = Window.partitionBy(*keys, "__part").orderBy(*order)
        df = parted.withColumn(name, F.row_number().over(part)).where(F.col(name) <= n).drop("__part", name)
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def head_per_group(
    df: DataFrame, keys: Sequence[str], n: int | None, row_id: str = "row_id", direct: int = DIRECT_LIMIT
) -> DataFrame:
    """First ``n`` rows of each group by the whole-number column ``row_id``; ``None`` keeps all."""
    if n is None:
        return df
    if n <= direct:
        return top_per_group(df, keys, [F.col(row_id)], n, row_id=row_id)
    block = F.shiftright(F.col(row_id), _BLOCK_BITS)
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        df.groupBy(*keys, block.alias("__block"))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .where(F.col("__before") < n)
        .drop("__rows")
    )
    in_block = Window.partitionBy(*keys, "__block").orderBy(row_id)
    return (
        null_safe_join(df.withColumn("__block", block), blocks, [*keys, "__block"])
        .withColumn("__rank", F.col("__before") + F.row_number().over(in_block))
        .where(F.col("__rank") <= n)
        .drop("__block", "__before", "__rank")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], value: Column, name: str, row_id: str = "row_id") -> DataFrame:
    """Value of the first row of each key, keys with null parts included."""
    return df.select(*keys, row_id, value.alias(name)).groupBy(*keys).agg(F.min_by(name, row_id).alias(name))


def nth_row(df: DataFrame, order: Sequence[tuple[str, bool]], n: int, direct: int = DIRECT_LIMIT) -> DataFrame:
    """The ``n``-th row (or the last, when there are fewer) in ``order``: pairs (column, descending)."""
    names = [name for name, _ in order]
    forward = [F.desc(name) if down else F.asc(name) for name, down in order]
    backward = [F.asc(name) if down else F.desc(name) for name, down in order]
    narrow = df.select(*names)
    if n <= direct:
        return narrow.orderBy(*forward).limit(n).orderBy(*backward).limit(1)
    parts = stable_copy(narrow.orderBy(*forward)).withColumn("__part", F.spark_partition_id())
    one_group = Window.partitionBy(F.lit(0))
    up_to = one_group.orderBy("__part")
    holder = (
        parts.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__end", F.sum("__rows").over(up_to))
        .withColumn("__wanted", F.least(F.lit(n), F.sum("__rows").over(one_group)))
        .where((F.col("__wanted") <= F.col("__end")) & (F.col("__wanted") > F.col("__end") - F.col("__rows")))
        .withColumn("__offset", F.col("__wanted") - (F.col("__end") - F.col("__rows")))
        .select("__part", "__offset")
    )
    inside = Window.partitionBy("__part").orderBy(*forward)
    return (
        parts.join(F.broadcast(holder), "__part")
        .withColumn("__rank", F.row_number().over(inside))
        .where(F.col("__rank") == F.col("__offset"))
        .select(*names)
    )


def flag_first(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    n: int,
    name: str,
    among: Column | None = None,
    direct: int = DIRECT_LIMIT,
) -> DataFrame:
    """Add a boolean: is the row among the first ``n`` in ``order``? The order must have no ties or nulls.

    Only the cutoff row is sought; every row then compares itself with it, so nothing wide is sorted.
    Rows outside ``among`` do not count and get false.
    """
    if n <= 0:
        return df.withColumn(name, F.lit(False))
    counted = df if among is None else df.where(among)
    cutoff = nth_row(counted, order, n, direct)
    limit = cutoff.select(F.struct(*cutoff.columns)).scalar()
    ahead, level = F.lit(False), F.lit(True)
    for column, down in order:
        bound = limit[column]
        ahead = ahead | (level & (F.col(column) > bound if down else F.col(column) < bound))
        level = level & (F.col(column) == bound)
    chosen = F.coalesce(ahead | level, F.lit(False))
    return df.withColumn(name, chosen if among is None else chosen & F.coalesce(among, F.lit(False)))
