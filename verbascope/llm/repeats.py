"""Maximal repeats of at least ``length`` bytes by common-prefix interval trees over sampled suffixes.

Suffixes are sampled by content: every window of ``length`` bytes has one anchor, the leftmost least hash of its
``GRAM``-byte strings, so equal windows anywhere have their anchor at the same place. Windows with one anchor form a run;
the suffixes at the anchors of equal hash form one small enhanced suffix array with left extensions:

* runs with equal bytes are counted by a hash aggregation and need no text;
* the others are sorted by their suffix. A stack scan over the common-prefix lengths builds the interval tree; as
  intervals close, their members merge in the order of their left contexts, and neighbours there show how far each
  repeat extends to the left. Common prefix plus common left context of at least ``length`` bytes is a repeat;
* anchors with more than ``limit`` different runs are handled exactly too, by counting the hash of each window.

Windows of words are sampled in the same way to tell which rows share a passage of so many words with another row, which
may have fewer than ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import RangeHash, batch_of, map_rows, runs_of, slices, stable_table, text_bytes, word_hashes
from verbascope.operators.joins import small_side

LENGTH = 400
GRAM = 32
# Words of a passage that tells that a row shares it, and words that are hashed together for its anchor.
PASSAGE = 51
WORD_GRAM = 16
# Different runs of one anchor that a task compares at once; each holds less than 800 bytes.
LIMIT = 50_000
# Window starts handled at once in a long text.
_STEP = 1 << 19
_ROWS = 50_000

_RUNS = pa.schema(
    [("id", pa.int64()), ("print", pa.int64()), ("anchor", pa.int64()), ("one", pa.int64()), ("two", pa.int64()),
     ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]
)
_SPANS = pa.schema([("id", pa.int64()), ("print", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
_WINDOWS = pa.schema([("id", pa.int64()), ("print", pa.int64()), ("start", pa.int32()), ("one", pa.int64()), ("two", pa.int64())])
_PASSAGES = pa.schema([("id", pa.int64()), ("print", pa.int64()), ("anchor", pa.int64()), ("content", pa.int64())])
_KEY = ["id", "print"]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width``, in linear time."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchor_runs(hashes: RangeHash, size: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor position, first and last window start of each run of windows with that anchor."""
    width = length - gram + 1
    found = []
    for base in range(0, size - length + 1, _STEP):
        starts = min(_STEP, size - length + 1 - base)
        at = np.arange(base, base + starts + width - 1)
        values = hashes.of(at, at + gram)
        local = np.arange(len(at), dtype=np.uint64)
        least = sliding_min(values & ~np.uint64((1 << 20) - 1) | local, width) & np.uint64((1 << 20) - 1)
        edge = np.flatnonzero(np.diff(least)) + 1
        low = np.concatenate([[0], edge])
        found.append((base + least[low].astype(np.int64), base + low, base + np.concatenate([edge, [starts]]) - 1))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _sampled(length: int, gram: int):
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            parts, n = [], 0
            for text, key, mark in zip(text_bytes(batch), *(batch.column(k).to_pylist() for k in _KEY), strict=True):
                if text is None or len(text) < length:
                    continue
                data = np.frombuffer(text, np.uint8)
                one, two = RangeHash(data, 0), RangeHash(data, 1)
                at, low, high = anchor_runs(one, len(data), length, gram)
                end, place = high + length, ((at - low) << 20 ^ (high - low)).astype(np.uint64)
                parts.append((np.full(len(at), key), np.full(len(at), mark), one.of(at, at + gram).view(np.int64),
                              (one.of(low, end) ^ place).view(np.int64), two.of(low, end).view(np.int64), at, low, high))
                n += len(at)
                if n >= _ROWS:
                    yield _batch(_RUNS, parts)
                    parts, n = [], 0
            if parts:
                yield _batch(_RUNS, parts)

    return sampled


def _batch(schema: pa.Schema, parts: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    return pa.record_batch([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, schema, strict=True)], schema=schema)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def interval_repeats(suffixes: list[bytes], lefts: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """(member, left, right): how far each member's repeats reach, for every left context and interval that matters.

    ``lefts`` are the contexts before the anchors, nearest byte first. For every pair with a common suffix prefix R and
    a common left context L of together ``length`` bytes, both members get a row that reaches as far at least.
    """
    n = len(suffixes)
    order = sorted(range(n), key=suffixes.__getitem__)
    lcp = [common_prefix(suffixes[order[i]], suffixes[order[i + 1]]) for i in range(n - 1)]
    by_left = sorted(range(n), key=lefts.__getitem__)
    rank = [0] * n
    for place, i in enumerate(by_left):
        rank[i] = place

    def merge(a: list[int], b: list[int], prefix: int) -> tuple[list[int], list]:
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        found = []
        for x in small:
            at = bisect_left(large, x)
            for other in large[max(0, at - 1) : at + 1]:
                i, j = by_left[x], by_left[other]
                left = common_prefix(lefts[i], lefts[j])
                if left + prefix >= length:
                    found += [(i, left, prefix), (j, left, prefix)]
            large.insert(at, x)
        return large, found

    # Open intervals: common prefix with the next suffix, and the members in the order of their left contexts.
    stack: list[tuple[int, list[int]]] = []
    for place, i in enumerate(order):
        members = [rank[i]]
        ahead = lcp[place] if place < n - 1 else -1
        while stack and stack[-1][0] > ahead:
            prefix, before = stack.pop()
            members, found = merge(before, members, prefix)
            yield from found
        if stack and stack[-1][0] == ahead:
            prefix, before = stack.pop()
            members, found = merge(before, members, prefix)
            yield from found
        stack.append((ahead, members))


def _intervals(length: int):
    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for group in runs_of(batches, ["anchor"]):
            at = [a - low for a, low in zip(group["at"], group["low"], strict=True)]
            suffixes = [bytes(c[a:]) for c, a in zip(group["bytes"], at, strict=True)]
            lefts = [bytes(c[:a][::-1]) for c, a in zip(group["bytes"], at, strict=True)]
            for i, left, right in interval_repeats(suffixes, lefts, length):
                rows.append((group["id"][i], group["print"][i], group["at"][i] - left, group["at"][i] + right))
            if len(rows) >= _ROWS:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    return intervals


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    key, mark, start, end = zip(*set(rows), strict=True)
    return batch_of(_SPANS, id=key, print=mark, start=start, end=end)


def _cut(length: int):
    """Bytes of each wanted run of a document."""
    schema = pa.schema([*_SPANS][:2] + [("anchor", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("hot", pa.bool_()), ("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = {f.name: [] for f in schema}
            size = 0
            for text, key, mark, runs in zip(text_bytes(batch), *(batch.column(k).to_pylist() for k in [*_KEY, "runs"]), strict=True):
                for run in runs:
                    piece = text[run["low"] : run["high"] + length]
                    for name, value in zip(columns, (key, mark, run["anchor"], run["at"], run["low"], run["hot"], piece), strict=True):
                        columns[name].append(value)
                    size += len(piece)
                if size > 8_000_000:
                    yield batch_of(schema, **columns)
                    columns, size = {f.name: [] for f in schema}, 0
            if columns["id"]:
                yield batch_of(schema, **columns)

    return cut


def _every_window(length: int):
    """Both hashes of each window of a run."""

    def every_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, n = [], 0
            for key, mark, low, piece in zip(*(batch.column(k).to_pylist() for k in [*_KEY, "low", "bytes"]), strict=True):
                data = np.frombuffer(piece, np.uint8)
                at = np.arange(len(data) - length + 1)
                one, two = (RangeHash(data, k).of(at, at + length).view(np.int64) for k in (0, 1))
                parts.append((np.full(len(at), key), np.full(len(at), mark), at + low, one, two))
                n += len(at)
                if n >= _ROWS:
                    yield _batch(_WINDOWS, parts)
                    parts, n = [], 0
            if parts:
                yield _batch(_WINDOWS, parts)

    return every_window


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that is never null: the id, or the least number without one, and a hash of id and text."""
    text, key = F.col("text").cast("string"), F.col("doc_id").cast("long")
    return docs.select(F.coalesce(key, F.lit(-(2**63))).alias("id"), F.xxhash64(key, text).alias("print"), key.alias("doc_id"), text.alias("text"))


def repeat_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = LIMIT) -> DataFrame:
    """Occurrences of repeats: id, print (hash of id and text), start, end in bytes; they overlap and touch.

    Each byte that a repeated ``length``-byte string covers is in a span, and no other byte is.
    """
    texts = _keyed(docs)
    runs = stable_table(map_rows(texts.select(*_KEY, "text"), _sampled(length, gram), "id long, print long, anchor long, one long, two long, at int, low int, high int"))
    same = ["anchor", "one", "two"]
    counted = stable_table(runs.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in [*_KEY, "at", "low", "high"]]))
    twice = counted.where("n > 1").select(*same)
    whole = runs.join(twice, same, "left_semi").select(*_KEY, F.col("low").alias("start"), (F.col("high") + length).cast("int").alias("end"))
    several = counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    wanted = counted.join(several, "anchor").select(*_KEY, F.struct("anchor", "at", "low", "high", (F.col("kinds") > limit).alias("hot")).alias("run"))
    wanted = wanted.groupBy(*_KEY).agg(F.collect_list("run").alias("runs"))
    asked = texts.join(wanted, _KEY).select(*_KEY, "text", "runs")
    pieces = stable_table(map_rows(asked, _cut(length), "id long, print long, anchor long, at int, low int, hot boolean, bytes binary"))
    tasks = pieces.where("not hot").repartition("anchor").sortWithinPartitions("anchor")
    compared = map_rows(tasks, _intervals(length), "id long, print long, start int, end int")
    one_by_one = map_rows(pieces.where("hot"), _every_window(length), "id long, print long, start int, one long, two long")
    repeated = one_by_one.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = one_by_one.join(repeated, ["one", "two"], "left_semi").select(*_KEY, "start", (F.col("start") + length).cast("int").alias("end"))
    return whole.unionByName(compared).unionByName(hot)


def _word_runs(words: int, gram: int, each: bool = False):
    """Anchor and hash of each run of windows of words, or of each window whose anchor the row's ``anchors`` name.

    A row has equal ones once, so that as many as there are come from as many rows.
    """

    def word_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            parts, n = [], 0
            asked = batch.column("anchors").to_pylist() if each else [None] * batch.num_rows
            for text, key, mark, wanted in zip(text_bytes(batch), *(batch.column(k).to_pylist() for k in _KEY), asked, strict=True):
                if text is None or len(text) < 2 * words - 1 or len(hashed := word_hashes(text)) < words:
                    continue
                one, two = RangeHash(hashed, 0), RangeHash(hashed, 1)
                at, low, high = anchor_runs(one, len(hashed), words, gram)
                anchor = one.of(at, at + gram).view(np.int64)
                if each:
                    # The runs have every window once, in order.
                    runs = np.repeat(np.arange(len(at)), high - low + 1)
                    low = high = np.flatnonzero(np.isin(anchor, wanted)[runs])
                    anchor = anchor[runs[low]]
                content, first = np.unique(two.of(low, high + words).view(np.int64), return_index=True)
                parts.append((np.full(len(first), key), np.full(len(first), mark), anchor[first], content))
                n += len(first)
                if n >= _ROWS:
                    yield _batch(_PASSAGES, parts)
                    parts, n = [], 0
            if parts:
                yield _batch(_PASSAGES, parts)

    return word_runs


def shared_passages(docs: DataFrame, words: int = PASSAGE, gram: int = WORD_GRAM) -> DataFrame:
    """id and print (hash of id and text) of the rows with ``words`` words in a row that another row has too.

    White space between the words doesn't count. What a row repeats in itself alone is not shared. Rows with an equal run
    are found without a text; the windows of runs that meet by their anchor only are counted for the other rows.
    """
    texts = _keyed(docs)
    kind = "id long, print long, anchor long, content long"
    runs = stable_table(map_rows(texts.select(*_KEY, "text"), _word_runs(words, gram), kind))
    met = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    runs = stable_table(runs.join(met, "anchor", "left_semi"))

    def held_twice(found: DataFrame) -> DataFrame:
        same = ["anchor", "content"]
        twice = found.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return found.join(twice, same, "left_semi").select(*_KEY).distinct()

    equal = stable_table(held_twice(runs))
    # Rows that are unclear have runs of their own, so one row of each equal run is enough for them to meet.
    unclear = runs.join(equal, _KEY, "left_anti").select("anchor").distinct()
    met = runs.join(unclear, "anchor", "left_semi").groupBy("anchor", "content").agg(F.min(F.struct(*_KEY)).alias("row"))
    asked, _ = small_side(met.groupBy("row.id", "row.print").agg(F.collect_set("anchor").alias("anchors")))
    windows = map_rows(texts.join(asked, _KEY).select(*_KEY, "text", "anchors"), _word_runs(words, gram, each=True), kind)
    return equal.unionByName(held_twice(stable_table(windows))).distinct()


def merged_spans(spans: list, size: int) -> list[list[int]]:
    """Maximal runs of bytes under the spans."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [[s, min(e, size)] for s, e in out]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.list_(pa.int64()))), ("kept_sha256", pa.string()), ("shares_passage", pa.bool_())])
    for batch in slices(batches):
        columns = {f.name: [] for f in schema}
        for key, text, spans, shares in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), *(batch.column(k).to_pylist() for k in ("spans", "shares")), strict=True):
            text = text or b""
            gone = merged_spans([(s["start"], s["end"]) for s in spans or ()], len(text))
            edges = [0, *(e for span in gone for e in span), len(text)]
            kept = b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
            values = (key, kept, len(text), len(text) - len(kept), gone, hashlib.sha256(kept).hexdigest(), bool(shares))
            for name, value in zip(columns, values, strict=True):
                columns[name].append(value)
        yield batch_of(schema, **columns)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = LIMIT, words: int = PASSAGE, word_gram: int = WORD_GRAM
) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) without the bytes that a repeated ``length``-byte string covers.

    Returns doc_id, kept_text (binary: a cut may fall inside a character), n_bytes, n_removed, spans ([start, end) byte
    runs removed), kept_sha256, shares_passage (has the row ``words`` words in a row that another row has too? It may lose
    nothing, as they may have fewer than ``length`` bytes). Null texts count as empty. A row that comes twice repeats
    itself, also with equal or null ids. Texts shorter than ``length`` stay whole. Other columns are ignored; an empty
    table gives no rows.
    """
    shared = shared_passages(docs, words, word_gram).select(*_KEY, F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))
    found = repeat_spans(docs, length, gram, limit).unionByName(shared)
    span = F.when(F.col("start").isNotNull(), F.struct("start", "end"))
    found = found.groupBy(*_KEY).agg(F.collect_set(span).alias("spans"), F.max(F.col("start").isNull()).alias("shares"))
    joined = _keyed(docs).join(found, _KEY, "left").select("doc_id", "text", "spans", "shares")
    kind = "doc_id long, kept_text binary, n_bytes long, n_removed long, spans array<array<long>>, kept_sha256 string, shares_passage boolean"
    return map_rows(joined, _removed, kind)
