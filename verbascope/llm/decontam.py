"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of ``e`` edits is cut into ``e + 1`` pieces: a text within the budget has one of them
unchanged. Exact piece hits come from one automaton over all pieces; the window around hits is verified with the
bit-parallel edit distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import batch_of, map_rows, stable_table

# Edits per character of an item.
ERROR_RATE = 0.08
# Items of fewer characters, after folding, are matched without an error, and as whole words.
MIN_CHARS = 40
# Characters of items that one automaton holds; more items go in several blocks, each over all documents.
BLOCK_CHARS = 4_000_000

_BREAK = re.compile(r"[\W_]+")
_HITS = pa.schema([("id", pa.int64()), ("print", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32())])
_KEY = ["id", "print"]


def fold(text: str | None) -> str:
    """Lower case, letters and digits with single spaces between."""
    return _BREAK.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """Start and text of ``budget + 1`` pieces of nearly equal length."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(cuts[i], item[cuts[i] : cuts[i + 1]]) for i in range(n)]


def best_distance(item: str, text: str) -> int:
    """Least edit distance of ``item`` to any part of ``text``, with one bit of an integer for each character."""
    n = len(item)
    where: dict[str, int] = {}
    for i, char in enumerate(item):
        where[char] = where.get(char, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best = n
    for char in text:
        equal = where.get(char, 0)
        steady = equal | down
        equal |= ((equal & up) + up) ^ up
        raised, lowered = down | (full & ~(equal | up)), up & equal
        if raised & top:
            score += 1
        elif lowered & top:
            score -= 1
        raised, lowered = raised << 1 & full, lowered << 1 & full
        up = lowered | (full & ~(steady | raised))
        down = raised & steady
        best = min(best, score)
    return best


class Matcher:
    """Finds items in folded texts within their budgets; short ones exactly, between spaces."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_chars: int = MIN_CHARS):
        import ahocorasick

        self.items = [(key, text, int(rate * len(text)) if len(text) >= min_chars else 0) for key, text in items]
        self.short = {i for i, (_, text, _) in enumerate(self.items) if len(text) < min_chars}
        self.pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, budget) in enumerate(self.items):
            for start, piece in pieces(text, budget):
                self.pieces.setdefault(piece, []).append((i, start))
        self.automaton = ahocorasick.Automaton()
        for piece in self.pieces:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        """(item id, distance) of each item within its budget."""
        places: dict[int, set[int]] = {}
        for end, piece in self.automaton.iter(text):
            for i, start in self.pieces[piece]:
                places.setdefault(i, set()).add(end + 1 - len(piece) - start)
        for i, found in places.items():
            key, item, budget = self.items[i]
            if i in self.short:
                ends = ((p - 1, p + len(item)) for p in found)
                if any((a < 0 or text[a] == " ") and (z >= len(text) or text[z] == " ") for a, z in ends):
                    yield key, 0
                continue
            best, at = budget + 1, sorted(found)
            k = 0
            while k < len(at):
                first = at[k]
                while k + 1 < len(at) and at[k + 1] - at[k] <= 2 * budget:
                    k += 1
                window = text[max(0, first - budget) : max(0, at[k] + len(item) + budget)]
                k += 1
                best = min(best, 0 if item in window else best_distance(item, window))
            if best <= budget:
                yield key, best


def _matched(items: list[tuple[int, str]], rate: float, min_chars: int):
    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, rate, min_chars)
        for batch in batches:
            rows = [
                (key, mark, *hit)
                for key, mark, text in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "text"]), strict=True)
                for hit in (matcher.find(fold(text)) if text else ())
            ]
            if rows:
                yield batch_of(_HITS, **dict(zip(_HITS.names, zip(*rows, strict=True), strict=True)))

    return matched


def _keyed(docs: DataFrame) -> DataFrame:
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(F.coalesce(key, F.lit(-(2**63))).alias("id"), F.xxhash64(key, text).alias("print"), key.alias("doc_id"), text.alias("text"))


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Folded items, in lists of bounded size; rows of one block travel at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null and text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-total // block_chars)
    placed = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n_blocks))))
    for block in range(n_blocks):
        folded = {(r["item_id"], fold(r["text"])) for r in placed.where(F.col("block") == block).collect()}
        if items := sorted(x for x in folded if x[1]):
            yield items


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """id, print, item_id, distance for every document and item within its budget; the least distance of each pair."""
    texts = _keyed(docs).select(*_KEY, "text")
    found = docs.sparkSession.createDataFrame([], "id long, print long, item_id long, distance int")
    for items in item_blocks(benchmark, block_chars):
        found = found.unionByName(map_rows(texts, _matched(items, rate, min_chars), "id long, print long, item_id long, distance int"))
    return found.groupBy(*_KEY, "item_id").agg(F.min("distance").alias("distance"))


def contamination(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Verdict for each row of ``docs`` (doc_id, text) against ``benchmark`` (item_id, text).

    Returns doc_id, contaminated, n_items, items (array of item_id and distance, by item_id). Texts are folded to lower
    case, letters, digits and single spaces. Null and empty texts are clean; items without id, or without a letter or digit,
    are not looked for; items of fewer than ``min_chars`` folded characters must stand in a text unchanged, between spaces or
    its ends; items that share an id count once. Rows that come twice get
    the same verdict twice. Other columns are ignored; empty tables give no rows or no verdicts.
    """
    found = stable_table(matches(docs, benchmark, rate, min_chars, block_chars))
    listed = found.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("item_id", "distance"))).alias("items"))
    keys = _keyed(docs).drop("text")
    joined = keys.join(listed, _KEY, "left")
    items = F.coalesce("items", F.array().cast("array<struct<item_id:bigint,distance:int>>"))
    return joined.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.size(items).cast("long").alias("n_items"), items.alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that hold no item, with all their columns."""
    bad = matches(docs, benchmark, **options).select(F.col("id").alias("__id"), F.col("print").alias("__print")).distinct()
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.withColumns({"__id": F.coalesce(key, F.lit(-(2**63))), "__print": F.xxhash64(key, text)})
    return rows.join(stable_table(bad), ["__id", "__print"], "left_anti").select(*docs.columns)
