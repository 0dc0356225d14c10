"""Mixing sources to target weights by hash-random order and prefix sums of words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbascope.llm.common import stable_table
from verbascope.operators.joins import null_safe_join, small_side, spread_join

WEIGHTS = (5, 2, 1)
SHARE = 1.0
MAX_EPOCHS = 3
SEED = "mix"
# Least rows in a range of hash keys; with many rows it is their square root, so neither rows nor ranges pile up.
RANGE_ROWS = 500


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ranked(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``rank`` from 0 in ascending order of ``column``, nulls last, without one task for all rows."""
    order = F.col(column).asc_nulls_last()
    placed = df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__at", F.monotonically_increasing_id())
    placed = stable_table(placed).withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts, _ = small_side(sizes.select("__part", before.alias("__before")))
    joined = placed.join(parts, "__part")
    return joined.withColumn("rank", F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at", "__part", "__before")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target: ``share`` of all words by weight, no source beyond ``max_epochs`` times its size.

    Sources in code point order, null last, take the weights in turn. What a full source leaves goes to the others by
    weight, until none is above its bound: the common level rises until the sources it fills stay the same.
    """
    sources = ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stable_table(sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("bound")))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        is_full = F.col("weight") * F.lit(level) > F.col("bound")
        found = sources.agg(
            F.count_if(is_full).alias("full"),
            F.sum(F.when(is_full, F.col("bound")).otherwise(0)).alias("given"),
            F.sum(F.when(is_full, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if found["full"] == full or not found["open"]:
            break
        full, level = found["full"], (share * total - found["given"]) / found["open"]
    target = F.least(F.col("weight") * F.lit(level), F.col("bound").cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Words that the mix takes of each row of ``docs`` (doc_id, text, source).

    Returns doc_id, print (hash of id and text), size, source, source_size, target, taken. Within a source, documents
    stand in the order of a hash of id and seed. The mix goes through the whole source as often as the target holds it,
    then through the documents up to the word at which the budget ends; only that document is taken in part. So each
    source's taken words are its target without the fraction. Null texts have size 0; a null source is a source of its
    own, the last; equal rows are told apart at will, as their sum is the same; an empty table gives no rows. Other
    columns are ignored. Prefix sums come from sums of hash ranges, so a hot source is spread like the rest.
    """
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    sized = stable_table(docs.select(
        key.alias("doc_id"), F.xxhash64(key, text).alias("print"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"),
        F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary")).alias("hash"),
    ))
    rows = sized.count()
    bits = max(0, math.ceil(math.log2(max(1, rows) / max(RANGE_ROWS, math.isqrt(rows)))))
    place = F.shiftright(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long"), 32 - bits)
    placed = sized.withColumn("range", place)
    ranges = placed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    targets = source_targets(sized, weights, share, max_epochs)
    starts = null_safe_join(ranges.select("source", "range", F.coalesce(before, F.lit(0)).alias("start")), targets, ["source"])
    side, fits = small_side(starts)
    keys = ["source", "range"]
    joined = null_safe_join(placed, side, keys) if fits else spread_join(placed, side, keys, ["hash"])
    inner = Window.partitionBy("source", "range").orderBy("hash", "size", "print").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("start") + F.coalesce(F.sum("size").over(inner), F.lit(0))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    placed = joined.withColumns({"ahead": ahead, "epochs": epochs}).withColumn("left", budget - F.col("epochs") * F.col("source_size"))
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("ahead")))
    return placed.select("doc_id", "print", "size", "source", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as it takes them, with all their columns.

    Documents stay whole: one that the budget cuts comes once more if at least half of it is wanted. Rows of no words,
    and rows that the mix takes nothing of, are left out.
    """
    found = mix(docs, **options).groupBy("doc_id", "print").agg(F.sum("taken").alias("taken"), F.max("size").alias("size"))
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    wanted = found.select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("__id"), F.col("print").alias("__print"), copies.cast("int").alias("__copies")
    ).where("__copies > 0")
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.withColumns({"__id": F.coalesce(key, F.lit(-(2**63))), "__print": F.xxhash64(key, text)})
    joined = rows.dropDuplicates(["__id", "__print"]).join(wanted, ["__id", "__print"])
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
