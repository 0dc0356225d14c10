"""Equal-width histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.operators.quantiles import value_counts


def histogram(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    bins: int,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Rows per group and bin; bins share one width over all groups, nulls and NaN are skipped.

    Without ``low`` and ``high`` the bins span the data. With them, values below fall in bin -1 and values
    above in bin ``bins``; the top edge itself belongs to the last bin.
    """
    v, n = F.col("__value"), F.count(F.lit(1))
    if low is None or high is None:
        # Counted values first: the edges and the bins then share one pass over the data.
        values, n = value_counts(df, keys, value), F.sum("__n")
        span = values.agg(F.min(v).alias("low"), F.max(v).alias("high"))
        edges = span.select(F.struct("low", "high")).scalar()
        bottom, top = edges["low"], edges["high"]
    else:
        values = df.select(*keys, value.cast("double").alias("__value")).where(v.isNotNull() & ~F.isnan(v))
        bottom, top = F.lit(float(low)), F.lit(float(high))
    width = (top - bottom) / bins
    place = F.coalesce(F.floor(F.try_divide(v - bottom, width)), F.lit(0))
    chosen = F.when(v < bottom, -1).when(v > top, bins).otherwise(F.least(place, F.lit(bins - 1)))
    counted = values.groupBy(*keys, chosen.cast("int").alias("bin")).agg(n.alias("n"))
    return counted.withColumn("bin_start", bottom + F.col("bin") * width)
