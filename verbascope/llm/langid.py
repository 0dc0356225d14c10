"""Language identification with word-first backoff.

A known word counts by its log frequency in each language. An unseen word is spelled in character n-grams: the longest
known n-gram at each place, backing off to shorter ones.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbascope.llm.common import batch_of, held_out, map_rows

# The model is fitted on whole texts of this many labelled rows of each language at most, the least hashes of id and text.
SAMPLE_ROWS = 1500
# Languages, and words and n-grams of each, that the model holds at most: the most frequent.
LANGUAGES = 256
WORDS = 30_000
GRAMS = 30_000
LONGEST = 5
# Unseen words that a worker remembers.
CACHED = 300_000
# Terms of one text that are summed at once.
SLICE = 1 << 15
UNDETERMINED = "und"



# Fits letters and, beyond ASCII, also numbers that are no digits.
_PLAIN = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=1)
def _odd() -> frozenset[str]:
    """Marks, and numbers that are no digits: without them the plain pattern is exact."""
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if (kind := category(c))[0] == "M" or kind in ("Nl", "No"))


@lru_cache(maxsize=1)
def _exact() -> re.Pattern:
    """A letter, and the letters and marks after it."""

    def ranges(*first: str) -> str:
        inside = [c for c in range(sys.maxunicode + 1) if category(chr(c))[0] in first]
        starts = [c for c, before in zip(inside, [-2, *inside]) if c != before + 1]
        ends = [c for c, after in zip(inside, [*inside[1:], -2], strict=True) if c + 1 != after]
        return "".join(f"{chr(x)}-{chr(z)}" for x, z in zip(starts, ends, strict=True))

    return re.compile(f"[{ranges('L')}][{ranges('L', 'M')}]*")


def words_of(text: str) -> list[str]:
    """Words: a letter, and the letters and marks after it. Numbers are no letters; vowel signs do not cut a word."""
    plain = text.isascii() or _odd().isdisjoint(text)
    return (_PLAIN if plain else _exact()).findall(text)


_COUNTED = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("term", pa.string()), ("n", pa.int64())])
_PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("print", pa.int64())])


def grams(word: str, size: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (kind 0) and n-grams (kind n) of the sampled texts."""
    found: Counter = Counter()

    def flush():
        keys = list(found)
        out = batch_of(_COUNTED, lang=[k[0] for k in keys], kind=[k[1] for k in keys], term=[k[2] for k in keys], n=list(found.values()))
        found.clear()
        return out

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for word, n in Counter(words_of(text.lower())).items():
                found[lang, 0, word] += n
                for size in range(1, LONGEST + 1):
                    for gram in grams(word, size):
                        found[lang, size, gram] += n
            if len(found) > 300_000:
                yield flush()
    if found:
        yield flush()


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """lang, text of the labelled rows that the model may learn from: ``rows`` of each language at most.

    A coarse cut by hash keeps what one language sends to the ranking near ``rows``, however many documents it has.
    """
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out())
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    shares = F.broadcast(counts.select("lang", (F.lit(2.0 * rows + 100) / F.col("n")).alias("share")))  # LANGUAGES rows at most
    hashed = labelled.join(shares, "lang").withColumn("at", F.xxhash64("doc_id", "text"))
    near = hashed.where(F.pmod("at", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    best = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("at", "text"))).where(F.col("place") <= rows)
    return best.select("lang", "text")


class Model:
    """Log frequencies of words and n-grams by language, one row of a matrix for each term; small by its bounds."""

    def __init__(self, counts: dict[tuple[int, str], dict[str, int]], languages: list[str]):
        self.languages = languages
        at = {lang: i for i, lang in enumerate(languages)}
        totals = np.ones((LONGEST + 1, len(languages)))
        self.rows = np.full((len(counts), len(languages)), 0.25)
        kinds = np.empty(len(counts), np.int64)
        self.terms: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        for place, ((kind, term), by) in enumerate(counts.items()):
            kinds[place] = kind
            self.terms[kind][term] = place
            for lang, n in by.items():
                totals[kind, at[lang]] += n
                self.rows[place, at[lang]] += n
        if languages:
            self.rows = np.log(self.rows / totals[kinds])
            self.rows -= self.rows.max(axis=1, keepdims=True)

    def spelled(self, word: str) -> list[int]:
        """Rows that stand for an unseen word: at each place that of the longest known n-gram."""
        marked, found = f"<{word}>", []
        for place in range(len(marked)):
            for size in range(min(LONGEST, len(marked) - place), 0, -1):
                row = self.terms[size].get(marked[place : place + size])
                if row is not None:
                    found.append(row)
                    break
        return found

    def predict(self, counts: Counter, cache: dict[str, list[int]]) -> tuple[str, float]:
        """Language and its share of the evidence; the n-grams of an unseen word count as much in all as one word."""
        words, rows, weights = self.terms[0], [], []
        for word, times in counts.items():
            row = words.get(word)
            if row is not None:
                rows.append(row)
                weights.append(times)
                continue
            spelled = cache.get(word)
            if spelled is None:
                if len(cache) >= CACHED:
                    cache.clear()
                spelled = cache[word] = self.spelled(word)
            rows += spelled
            weights += [times / max(1, len(spelled))] * len(spelled)
        total = np.zeros(len(self.languages))
        for start in range(0, len(rows), SLICE):
            weight = np.array(weights[start : start + SLICE], np.float64)
            total += (self.rows[rows[start : start + SLICE]] * weight[:, None]).sum(axis=0)
        total /= math.sqrt(counts.total())
        chances = np.exp(total - total.max())
        best = int(np.argmax(chances))
        return self.languages[best], float(chances[best] / chances.sum())


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Learn from ``docs`` (doc_id, text, lang), from rows that are not held out. Bounded by its parameters."""
    counted = map_rows(sample(docs, rows), _counted, "lang string, kind int, term string, n long")
    summed = counted.groupBy("lang", "kind", "term").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "term")
    most = F.when(F.col("kind") == 0, words).otherwise(grams // LONGEST)
    kept = summed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    counts: dict[tuple[int, str], dict[str, int]] = {}
    for r in kept.select("lang", "kind", "term", "n").toLocalIterator():
        counts.setdefault((r["kind"], r["term"]), {})[r["lang"]] = r["n"]
    return Model(counts, sorted({lang for by in counts.values() for lang in by}))


def _predicted(model):
    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache = model.value, {}
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text").to_pylist():
                counts = Counter(words_of(text.lower())) if text else None
                if not counts or not known.languages:
                    lang, score = UNDETERMINED, 0.0
                else:
                    lang, score = known.predict(counts, cache)
                langs.append(lang)
                scores.append(score)
            yield batch_of(_PREDICTED, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), lang_pred=langs, score=scores, print=batch.column("print"))

    return predicted


def identify(docs: DataFrame, model: Model | None = None, with_print: bool = False) -> DataFrame:
    """Language of each row of ``docs`` (doc_id, text, and lang to learn from if no model is given).

    Returns doc_id, held_out, lang_pred, score (share of the winner). ``und`` with score 0 for null texts, texts without
    a letter, and if nothing was labelled. Ties go to the first language in code point order. Repeated rows get equal
    answers. Other columns are ignored; an empty table gives no rows. ``with_print`` adds a hash of id and text.
    """
    spark = docs.sparkSession
    if model is None:
        model = fit(docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string")))
    sent = spark.sparkContext.broadcast(model)
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(key, text, held_out().alias("held_out"), F.xxhash64(key, text).alias("print"))
    found = map_rows(rows, _predicted(sent), "doc_id long, held_out boolean, lang_pred string, score double, print long")
    return found if with_print else found.drop("print")
