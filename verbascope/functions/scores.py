"""Number columns: rates, rounding, similarity, fields of metadata text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the reports.
CLEAN = 1.0
JOINT_THRESHOLD = 0.80
LOW_SAMPLE = 30


def zero_filled(score: Column) -> Column:
    return F.coalesce(score, F.lit(0.0))


def is_clean(ifeval: Column) -> Column:
    """A missing cleanliness score counts as polluted."""
    return zero_filled(ifeval) >= CLEAN


def joint_pass(ifeval: Column, comet_qe: Column, threshold: float = JOINT_THRESHOLD) -> Column:
    """1.0 where the output is clean and its quality reaches the threshold, else 0.0."""
    return F.when(is_clean(ifeval) & (zero_filled(comet_qe) >= threshold), 1.0).otherwise(0.0)


def percent_equal(column: Column, value) -> Column:
    """Aggregate: share of rows equal to ``value`` in percent; null rows stay in the denominator."""
    return 100.0 * F.avg(F.when(column.eqNullSafe(F.lit(value)), 1.0).otherwise(0.0))


def error_rate(n_errors: Column, n_rows: Column) -> Column:
    """Null when the row count is missing or 0, or the error count is missing."""
    return F.try_divide(n_errors.cast("double"), n_rows.cast("double"))


def throughput(n_rows: Column, elapsed_seconds: Column) -> Column:
    """Rows per second to 3 places; null when no time passed."""
    return F.when(elapsed_seconds > 0, F.round(n_rows / elapsed_seconds, 3))


def rounded(value: Column, places: int, half_even: bool = False) -> Column:
    """Half away from zero by default; ``half_even`` is what NumPy does."""
    return F.bround(value, places) if half_even else F.round(value, places)


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity of two equally long numeric arrays, summed as doubles."""

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, item: total + item)

    return F.try_divide(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))


def _unit(vector: Column) -> Column:
    """The vector at length one; null if it has no direction."""
    as_doubles = F.transform(vector, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(as_doubles, F.lit(0.0), lambda total, x: total + x * x))
    return F.when(length > 0, F.transform(as_doubles, lambda x: x / length))


def alignment(candidate: Column, reference: Column) -> Column:
    """Greedy alignment of two arrays of token vectors: struct(precision, recall, f1).

    Every token takes the most similar one of the other side, by cosine; precision is the mean over the candidate's
    tokens, recall over the reference's. Tokens without a direction are similar to nothing (0). A side without tokens, or
    a null one, gives nulls.
    """

    def best(tokens: Column, others: Column) -> Column:
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
        nearest = F.transform(tokens, lambda a: F.array_max(F.transform(others, lambda b: F.coalesce(dot(a, b), F.lit(0.0)))))
        return F.try_divide(F.aggregate(nearest, F.lit(0.0), lambda total, x: total + x), F.size(tokens))

    left, right = F.transform(candidate, _unit), F.transform(reference, _unit)
    both = (F.size(candidate) > 0) & (F.size(reference) > 0)
    precision, recall = F.when(both, best(left, right)), F.when(both, best(right, left))
    f1 = F.when(precision + recall == 0, 0.0).otherwise(F.try_divide(2 * precision * recall, precision + recall))
    return F.struct(precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def meta_number(json_text: Column, key: str) -> Column:
    """A numeric field of metadata text; null when absent, null or not a JSON number."""
    field = F.variant_get(F.try_parse_json(json_text), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(field) != "STRING", F.try_variant_get(field, "$", "double"))
