"""Exact quantiles of groups of any size.

A built-in exact percentile gathers all distinct values of a group in one task. Here a rank is found by narrowing: rows
are counted in buckets of nearby values per group, and only the buckets that hold a wanted rank are cut into finer ones,
all groups in one job, until they hold few rows or one value. Single values are ranked inside these buckets only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbascope.operators.joins import BROADCAST_BYTES, null_safe_join, small_side
from verbascope.session import stable_copy, stable_table

# Buckets per power of two. Scores between 0 and 1 meet some 10^4 buckets, few enough to count before the shuffle and
# to rank in one task.
_STEPS = 4096

# Bits by which each further cut refines a bucket; with the steps they name every double there is.
_CUTS = (14, 13, 13)

# Rows of a bucket that may be ranked one by one; one that holds more is cut again.
SINGLE_ROWS = 65_536

_LARGEST = 1.7976931348623157e308


def _power(value: Column) -> tuple[Column, Column]:
    """Size of a double and the power of two below it."""
    size = F.least(F.abs(value), F.lit(_LARGEST))
    return size, F.least(F.floor(F.log2(size)), F.lit(1023))


def order_bucket(value: Column) -> Column:
    """A bucket number that never decreases with the value, for doubles of any sign and size."""
    size, power = _power(value)
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1.0) * _STEPS)
    bucket = (power + 1100) * _STEPS + step
    return F.when(value == 0, F.lit(0)).otherwise((F.signum(value) * bucket).cast("long"))


def order_digit(value: Column, cut: int) -> Column:
    """The bucket's part that a value lies in after ``cut`` further cuts, in rising order; scaling by powers of two is exact."""
    size, power = _power(value)
    place = (size / F.pow(F.lit(2.0), power) - 1.0) * (_STEPS * 2.0 ** sum(_CUTS[:cut]))
    digit = F.floor(F.pmod(place, F.lit(1.0)) * 2.0 ** _CUTS[cut])
    return F.when(value == 0, F.lit(0)).otherwise((F.signum(value) * digit).cast("long"))


Ranks = Mapping[str, Callable[[Column], Column]]


def _known_values(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    values = df.select(*keys, value.cast("double").alias("__value"))
    return values.where(F.col("__value").isNotNull() & ~F.isnan("__value"))


def value_counts(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Distinct values per group with their row counts; nulls skipped."""
    return _known_values(df, keys, value).groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__n"))


def bucket_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, least and largest value of each bucket of each group, from values with their ``__n``."""
    return counts.groupBy(*keys, order_bucket(F.col("__value")).alias("__bucket")).agg(*_in_bucket())


def _in_bucket() -> list[Column]:
    value = F.col("__value")
    return [F.sum("__n").alias("__in_bucket"), F.min(value).alias("__least"), F.max(value).alias("__most")]


def _holding(buckets: DataFrame, group: Sequence[str], bucket: str, total: Column, before: Column, ranks: Column) -> DataFrame:
    """The buckets that hold a wanted rank, and those ranks; ``before`` rows stand ahead of a group's first bucket."""
    so_far = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        buckets.withColumn("__total", total)
        .withColumn("__up_to", before + F.sum("__in_bucket").over(so_far))
        .withColumn("__before", F.col("__up_to") - F.col("__in_bucket"))
        .withColumn("__ranks", F.filter(ranks, lambda r: (r["rank"] >= F.col("__before")) & (r["rank"] < F.col("__up_to"))))
        .where(F.size("__ranks") > 0)
        .drop("__up_to")
    )


def _inside(counts: DataFrame, wanted: DataFrame, fits: bool, keys: Sequence[str], prefix: Sequence[str]) -> DataFrame:
    """The counted values that lie in wanted buckets. Too many buckets to broadcast join all values later instead."""
    digits = {name: order_bucket(F.col("__value")) if cut == 0 else order_digit(F.col("__value"), cut - 1) for cut, name in enumerate(prefix)}
    placed = counts.withColumns(digits)
    return null_safe_join(placed, wanted.select(*keys, *prefix), [*keys, *prefix], "left_semi") if fits else placed


def _select(counts: DataFrame, keys: Sequence[str], ranks: Ranks, limit: int, buckets: DataFrame | None = None) -> DataFrame:
    """One row per group: ``total`` and, for each name, the value at its rank. ``counts`` is read once for each cut."""
    group, prefix = list(keys) or [F.lit(0)], ["__bucket"]
    asked = F.array(
        *[F.struct(F.lit(slot).alias("slot"), rank(F.col("__total")).cast("long").alias("rank")) for slot, rank in enumerate(ranks.values())]
    )
    found = bucket_counts(counts, keys) if buckets is None else buckets
    total = F.sum("__in_bucket").over(Window.partitionBy(*group))
    wanted, fits = small_side(_holding(found, group, "__bucket", total, F.lit(0), asked), limit)
    for cut in range(len(_CUTS)):
        many = F.when(F.col("__least") < F.col("__most"), F.col("__in_bucket"))
        if (wanted.agg(F.max(many)).first()[0] or 0) <= SINGLE_ROWS:
            break
        digit = f"__cut{cut}"
        inside = _inside(counts, wanted, fits, keys, prefix)
        finer = inside.groupBy(*keys, *prefix, order_digit(F.col("__value"), cut).alias(digit)).agg(*_in_bucket())
        above = wanted.select(*keys, *prefix, "__total", F.col("__before").alias("__ahead"), F.col("__ranks").alias("__asked"))
        finer = null_safe_join(finer, above, [*keys, *prefix])
        held = _holding(finer, [*keys, *prefix], digit, F.col("__total"), F.col("__ahead"), F.col("__asked")).drop("__ahead", "__asked")
        wanted, fits = small_side(held, limit)
        prefix.append(digit)
    single = _inside(counts, wanted, fits, keys, prefix).groupBy(*keys, *prefix, "__value").agg(F.sum("__n").alias("__n"))
    so_far = Window.partitionBy(*keys, *prefix).orderBy("__value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = null_safe_join(single, wanted.drop("__in_bucket", "__least", "__most"), [*keys, *prefix])
    placed = placed.withColumn("__end", F.col("__before") + F.sum("__n").over(so_far))
    reached = F.filter("__ranks", lambda r: (r["rank"] >= F.col("__end") - F.col("__n")) & (r["rank"] < F.col("__end")))
    hits = placed.withColumn("__hit", F.explode(reached))
    picks = [F.max(F.when(F.col("__hit.slot") == slot, F.col("__value"))).alias(name) for slot, name in enumerate(ranks)]
    return hits.groupBy(*keys).agg(F.max("__total").alias("total"), *picks)


def values_at(counts: DataFrame, keys: Sequence[str], ranks: Ranks, limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per group of :func:`value_counts`: its ``total`` and, for each name, the value at a rank.

    Ranks count from 0 in rising order; each is given as a function of the group's number of values. The
    counts are computed once.
    """
    return _select(stable_copy(counts), keys, ranks, limit)


def values_at_of_rows(
    df: DataFrame, keys: Sequence[str], value: Column, ranks: Ranks, limit: int = BROADCAST_BYTES, buckets: DataFrame | None = None
) -> DataFrame:
    """The same from rows that are cheap to read again and hold many different values, such as scores.

    Each reading counts before the shuffle or keeps the few wanted buckets, so that hardly any value is shuffled.
    ``buckets`` may give what the first reading would find, see :func:`bucket_counts`.
    """
    return _select(_known_values(df, keys, value).withColumn("__n", F.lit(1).cast("long")), keys, ranks, limit, buckets)


def _edge_ranks(probabilities: Mapping[str, float]) -> Ranks:
    """Ranks on both sides of each probability's position."""
    ranks = {}
    for name, p in probabilities.items():
        ranks[f"__low_{name}"] = lambda total, p=p: F.floor((total - 1) * p)
        ranks[f"__high_{name}"] = lambda total, p=p: F.ceil((total - 1) * p)
    return ranks


def _interpolated(edges: DataFrame, keys: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    columns = []
    for name, p in probabilities.items():
        low, high = F.col(f"__low_{name}"), F.col(f"__high_{name}")
        position = (F.col("total") - 1) * p
        columns.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return edges.select(*keys, *columns)


def quantiles(
    df: DataFrame, keys: Sequence[str], value: Column, probabilities: Mapping[str, float], buckets: DataFrame | None = None
) -> DataFrame:
    """One row per group: for each name its quantile, interpolated linearly between the two nearest ranks."""
    edges = values_at_of_rows(df, keys, value, _edge_ranks(probabilities), buckets=buckets)
    return _interpolated(edges, keys, probabilities)


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """:func:`quantiles` from a table of :func:`value_counts`."""
    return _interpolated(values_at(counts, keys, _edge_ranks(probabilities)), keys, probabilities)


def box_numbers(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Box-plot numbers per group: extremes, quartiles, and the outermost values within 1.5 IQR of the box.

    The input is read once, into a table of keys and values. Quartiles, extremes and fences all come from the counts of
    its buckets; single values are looked up in the buckets that a quartile or a fence cuts.
    """
    values = stable_table(_known_values(df, keys, value).withColumn("__n", F.lit(1).cast("long")))
    buckets = stable_copy(bucket_counts(values, keys))
    quartiles = quantiles(values, keys, F.col("__value"), {"q1": 0.25, "median": 0.5, "q3": 0.75}, buckets)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    boxes = stable_copy(quartiles.withColumns({"__low": F.col("q1") - reach, "__high": F.col("q3") + reach}))
    low, high, least, most = (F.col(c) for c in ("__low", "__high", "__least", "__most"))
    fenced = stable_copy(null_safe_join(buckets, boxes, keys))
    # A bucket that a fence cuts: some of its values are inside, so they are asked one by one.
    cut = fenced.where(((least < low) & (most >= low)) | ((least <= high) & (most > high))).select(*keys, "__bucket", "__low", "__high")
    edges, _ = small_side(cut)
    v = F.col("__value")
    in_cut = null_safe_join(values.withColumn("__bucket", order_bucket(v)), edges, [*keys, "__bucket"]).where(v.between(low, high))
    whole = fenced.where((least >= low) & (most <= high)).select(*keys, "__least", "__most")
    inside = whole.unionByName(in_cut.select(*keys, v.alias("__least"), v.alias("__most")))
    fences = inside.groupBy(*keys).agg(F.min("__least").alias("lower_fence"), F.max("__most").alias("upper_fence"))
    summed = buckets.groupBy(*keys).agg(F.sum("__in_bucket").alias("n"), F.min("__least").alias("min"), F.max("__most").alias("max"))
    both = null_safe_join(null_safe_join(summed, boxes, keys), fences, keys, "left")
    return both.select(*keys, "n", "min", "lower_fence", "q1", "median", "q3", "upper_fence", "max")
