"""Substring search through an index: blocks of rows, and for each run of three letters the blocks that hold it.

A text holds a needle only if it holds all its three-letter runs. So the blocks that hold all of them are looked up,
only their files are read, and their whole texts are compared. The answer is that of a scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope.functions import text as t
from verbascope.operators.filters import mentions

SEARCHED = ("source", "hypothesis")
BLOCK_ROWS = 5_000
GRAM = 3


def grams(text: Column) -> Column:
    """Distinct runs of three characters of a lower-cased text, overlapping ones included; none of a shorter one."""
    return F.array_distinct(F.regexp_extract_all(F.lower(t.text_or_empty(text)), F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    path: str
    columns: Sequence[str] = SEARCHED

    def build(self, rows: DataFrame, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> None:
        """Write ``rows`` in blocks along ``order``, and the blocks of each run. Both replace what is there.

        Postings are distinct pairs, counted before the shuffle: their number is bounded by the runs of the language
        times the blocks, not by the length of the texts.
        """
        n = rows.count()
        blocks = max(1, -(-n // block_rows))
        placed = rows.repartitionByRange(blocks, *[F.asc_nulls_first(c) for c in order], F.xxhash64(*order, *self.columns))
        # Without rows there is no folder of a block, and a plain file has to say what the columns are.
        placed.withColumn("block", F.spark_partition_id()).write.mode("overwrite").partitionBy(*["block"][:n]).parquet(f"{self.path}/rows")
        runs = F.array_distinct(F.flatten(F.array(*[grams(F.col(c)) for c in self.columns])))
        held = self._rows().select("block", F.explode(runs).alias("gram"))
        postings = held.distinct().repartitionByRange("gram", "block").sortWithinPartitions("gram", "block")
        postings.write.mode("overwrite").parquet(f"{self.path}/postings")

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def candidates(self, query: str) -> DataFrame | None:
        """Blocks that hold every run of the needle; None if it is too short to have one, so that all blocks do."""
        wanted = self.spark.range(1).select(grams(F.lit(query))).first()[0]
        if not wanted:
            return None
        postings = self.spark.read.parquet(f"{self.path}/postings").where(F.col("gram").isin(wanted))
        return postings.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted)).select("block")

    def search(self, query: str) -> DataFrame:
        """Rows that mention the query in any of the columns, whatever the case of either; an empty query finds all."""
        rows = self._rows()
        if not query:
            return rows.drop("block")
        found = self.candidates(query)
        if found is not None:
            # Numbers of blocks, one in thousands of rows, as a filter: files of other blocks are never opened.
            listed = [row["block"] for row in found.collect()]
            rows = rows.where(F.col("block").isin(listed))
        return rows.where(mentions(query, self.columns)).drop("block")
