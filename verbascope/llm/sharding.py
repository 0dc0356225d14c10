"""Extendible hashing: a directory of hash prefixes in which only oversized buckets take another bit."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import stable_table

LIMIT_BYTES = 8 << 20
BITS = 60
# Bits beyond an even division that are looked at in one round.
AHEAD = 4


def hash_bits() -> Column:
    """60 bits of a hash of id and text; texts count, so that rows without an id spread too."""
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def directory(rows: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """depth, prefix, shard_bytes, shard_docs of every shard, for ``rows`` with bits and n_bytes.

    A bucket splits while it is above ``limit`` and has two rows or more. Each round sums the rows of the buckets still
    too large once, by a few more bits than an even division needs, and derives the depths between from those sums.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    done, depth, open_rows = None, 0, rows
    while True:
        deep = min(BITS, depth + AHEAD + (math.ceil(math.log2(total / limit)) if total > limit else 0))
        fine = open_rows.groupBy(F.shiftright("bits", BITS - deep).alias("prefix")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")
        )
        levels = fine.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(deep))))
        levels = levels.withColumn("up", F.expr(f"shiftright(prefix, {deep} - depth)"))
        sums = levels.groupBy("depth", F.col("up").alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        sums = stable_table(sums.withColumn("fits", (F.col("bytes") <= limit) | (F.col("docs") < 2) | (F.col("depth") == BITS)))
        # A bucket is a shard if it fits and the bucket it was split from does not.
        above = sums.where("not fits").select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
        fitting = sums.where("fits")
        shards = fitting.where(F.col("depth") > depth).join(above, ["depth", "prefix"], "left_semi").unionByName(fitting.where(F.col("depth") == depth))
        shards = shards.select("depth", "prefix", F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"))
        done = shards if done is None else done.unionByName(shards)
        large = sums.where((F.col("depth") == deep) & ~F.col("fits")).select("prefix", "bytes")
        total = large.agg(F.max("bytes")).first()[0]
        if total is None:
            return done
        left = open_rows.withColumn("prefix", F.shiftright("bits", BITS - deep)).join(large.select("prefix"), "prefix", "left_semi")
        open_rows, depth = left.drop("prefix"), deep + 1
        # The next round starts below the buckets that are too large.
        depth = min(depth, BITS)


def _assigned(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with depth, shard, shard_bytes, shard_docs."""
    found = stable_table(directory(rows, limit))
    depths = [F.lit(r["depth"]) for r in found.select("depth").distinct().collect()]  # at most BITS + 1
    # Of the prefixes that a row has at the depths in use, exactly one is a shard.
    tried = rows.withColumn("depth", F.explode(F.array(*depths) if depths else F.array().cast("array<int>")))
    joined = tried.withColumn("prefix", F.expr(f"shiftright(bits, {BITS} - depth)")).join(found, ["depth", "prefix"])
    shard = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return joined.withColumn("shard", shard).drop("prefix")


def _sized(docs: DataFrame) -> DataFrame:
    n_bytes = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    return stable_table(docs.select(F.col("doc_id").cast("long"), n_bytes.alias("n_bytes"), hash_bits().alias("bits")))


def shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """Shard of each row of ``docs`` (doc_id, text).

    Returns doc_id, n_bytes (UTF-8 bytes of the text, null: 0), depth, shard (the prefix as ``depth`` bits), shard_bytes,
    shard_docs. A shard is the shortest prefix whose rows hold at most ``limit`` bytes, or a single row. Rows equal in id
    and text have equal bits and share a shard, which only then can be above the limit with several rows. Null ids are
    spread by their texts. Other columns are ignored; an empty table gives no rows.
    """
    return _assigned(_sized(docs), limit).select("doc_id", "n_bytes", "depth", "shard", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, folder: str, limit: int = LIMIT_BYTES) -> None:
    """Write the rows with all their columns, one folder ``shard=s<bits>`` for each shard."""
    named = _assigned(_sized(docs), limit).select(F.col("bits").alias("__bits"), F.concat(F.lit("s"), "shard").alias("shard"))
    rows = docs.withColumn("__bits", hash_bits()).join(named.distinct(), "__bits").drop("__bits")
    rows.repartition("shard").write.partitionBy("shard").parquet(folder)
