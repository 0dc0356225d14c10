"""Hard negatives by secondary sort: scores keyed by (anchor, falling score, id), mined by one pass over the sorted rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import batch_of, map_rows, stable_table

N_POSITIVES = 5
N_NEGATIVES = 5
# A negative's score is at least this share of the positive's, in percent.
LOW_PERCENT = 80
SCALE = 256

# Anchors, and rows, that one task holds at a time while it scores them.
BLOCK = 512
CHUNK = 4096
MAX_TASKS = 10_000

_LEAST = np.iinfo(np.int64).min
_MOST = np.iinfo(np.int64).max
_PAIRS = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("lowered", pa.int64()), ("negative", pa.bool_()), ("id", pa.int64())])
_MINED = pa.schema(
    [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())]
)
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Vectors:
    """Rows in ascending order of id, null ids last, so that ties of score fall to the smaller id."""

    row: np.ndarray
    ids: list
    label: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, dim: int, scale: int) -> Vectors:
        table = table.take(pa.compute.sort_indices(table, [("id", "ascending"), ("row", "ascending")], null_placement="at_end"))
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        with np.errstate(over="ignore"):
            values = np.nan_to_num(np.floor(flat * scale)).reshape(table.num_rows, dim)
        return cls(table.column("row").to_numpy(), table.column("id").to_pylist(), table.column("label").to_numpy(), values)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows with all; those beyond 64 bits become the outermost long but one."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if most < 2**53:
        return (left @ right.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(left) @ whole(right).T
    return np.minimum(np.maximum(exact, _LEAST + 1), _MOST).astype(np.int64)


def _first_of_each(group: np.ndarray, n: int) -> np.ndarray:
    """Of values that stand in runs, which are among the first ``n`` of their run."""
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    lengths = np.diff(np.concatenate([starts, [len(group)]]))
    return np.arange(len(group)) - np.repeat(starts, lengths) < n


def candidates(anchors: Vectors, rows: Vectors, n_positives: int, n_negatives: int, low: int) -> tuple[np.ndarray, ...]:
    """Pairs that can matter, as (anchor place, row place, score, negative).

    Among these rows only the best ``n_positives`` of an anchor's label can be among its best of all. The last of them
    scores no higher than the last of all, so a negative below ``low`` percent of it is outside every window, as is one
    below zero. Of negatives with one score a window holds all or none, and takes those of the least ids.
    """
    scores = inner_products(anchors.values, rows.values)
    same = anchors.label[:, None] == rows.label[None, :]
    positive = same & (anchors.row[:, None] != rows.row[None, :])
    held = np.where(positive, scores, _LEAST)
    if held.shape[1] > n_positives:
        last = np.partition(held, held.shape[1] - n_positives, axis=1)[:, held.shape[1] - n_positives]
    else:
        last = np.full(len(held), _LEAST)
    i, j = np.nonzero(positive & (held >= last[:, None]))
    order = np.lexsort((j, -scores[i, j], i))
    i, j = i[order], j[order]
    best = _first_of_each(i, n_positives)
    lowest = np.array([-(-low * max(0, int(x)) // 100) for x in last], np.int64)
    k, m = np.nonzero(~same & (scores >= lowest[:, None]))
    order = np.lexsort((m, -scores[k, m], k))
    k, m = k[order], m[order]
    run = np.cumsum(np.concatenate([[0], (k[1:] != k[:-1]) | (scores[k[1:], m[1:]] != scores[k[:-1], m[:-1]])])) if len(k) else k
    first = _first_of_each(run, n_negatives)
    i, j, k, m = i[best], j[best], k[first], m[first]
    place, other = np.concatenate([i, k]), np.concatenate([j, m])
    return place, other, scores[place, other], np.arange(len(place)) >= len(i)


def _pieces(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys, from rows sorted by them, in pieces of ``rows`` rows at most."""
    held: list[pa.RecordBatch] = []
    key, n = None, 0
    for batch in batches:
        codes = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        edges = (np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1).tolist()
        for start, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            while start < end:
                found = tuple(codes[:, start].tolist())
                if held and (found != key or n == rows):
                    yield key, pa.Table.from_batches(held)
                    held, n = [], 0
                key, taken = found, min(end - start, rows - n)
                held.append(batch.slice(start, taken))
                start, n = start + taken, n + taken
    if held:
        yield key, pa.Table.from_batches(held)


def _scored(n_positives: int, n_negatives: int, low: int, scale: int):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, anchors = None, []
        for (dim, *place, is_row), table in _pieces(batches, ["dim", "block", "chunk", "is_row"], CHUNK):
            if (dim, place) != block:
                block, anchors = (dim, place), []
            if not is_row:
                # Few anchors at a time, so that a block of scores stays small.
                anchors += [Vectors.of(table.slice(s, 128), dim, scale) for s in range(0, table.num_rows, 128)]
                continue
            rows = Vectors.of(table, dim, scale) if anchors else None
            for some in anchors:
                at, other, score, negative = candidates(some, rows, n_positives, n_negatives, low)
                ids, anchor_ids = pa.array(rows.ids, pa.int64()), pa.array(some.ids, pa.int64())
                yield batch_of(_PAIRS, anchor=some.row[at], anchor_id=anchor_ids.take(pa.array(at)), lowered=-score, negative=negative, id=ids.take(pa.array(other)))

    return scored


def _mined(n_positives: int, n_negatives: int, low: int):
    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Holds the open windows of one anchor: (positive, its score, negatives so far)."""
        current, found, windows = None, 0, []
        for batch in batches:
            out = []
            for anchor, anchor_id, lowered, negative, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != current:
                    current, found, windows = anchor, 0, []
                if not negative:
                    if found < n_positives and lowered <= 0:
                        windows.append([other, -lowered, 0])
                    found += 1
                elif windows:
                    windows = [w for w in windows if w[2] < n_negatives and -100 * lowered >= low * w[1]]
                    for w in windows:
                        w[2] += 1
                        out.append((anchor_id, w[0], w[2], other, w[1], -lowered))
            columns = zip(*out, strict=True) if out else [[]] * len(_MINED)
            yield batch_of(_MINED, **dict(zip(_MINED.names, columns, strict=True)))

    return mined


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column | None = None,
    n_positives: int = N_POSITIVES,
    n_negatives: int = N_NEGATIVES,
    low: int = LOW_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id, label, embedding) for which ``is_anchor`` holds (none: all).

    Components become floor(scale * x); a row's score is its integer inner product with the anchor. An anchor's
    positives are its ``n_positives`` best other rows of its label; for each of them come the ``n_negatives`` best rows
    of another label with ``low`` percent of the positive's score at least and its whole score at most. Best is the
    higher score, then the smaller vec_id, a null one last. Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Anchors in blocks meet rows in chunks, dealt out by number, so no label, id or vector is hot. What can be in a window
    is shuffled under the key (anchor, falling score, positives first, id), which is repartitionAndSortWithinPartitions
    in DataFrame terms; the sorted rows stream by and only the open windows of one anchor are held.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A null id is no anchor unless
    ``is_anchor`` says so, and comes last among ties. Every row is a row of its own, also one that repeats an id or all
    values of another; repeated anchors answer once each. Vectors of different length have no score with each other;
    empty ones score zero. Scores beyond 64 bits count as the outermost long. An empty table gives no rows. Other
    columns are ignored.
    """
    vector = F.col("embedding")
    if dict(vectors.dtypes)["embedding"] != "array<float>":
        vector = vector.cast("array<double>")
    unfit = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    chosen = F.lit(True) if is_anchor is None else F.coalesce(is_anchor, F.lit(False))
    fit = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~unfit)
    # Written first: numbers of rows must be the same in every reading.
    rows = stable_table(fit.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.size(vector).alias("dim"), vector.alias("vector"), chosen.alias("is_anchor"),
    ))
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    chunks, blocks = max(1, -(-n_rows // CHUNK)), max(1, -(-n_anchors // BLOCK))
    own_block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    own_chunk = F.pmod(F.xxhash64("row", F.lit("chunk")), F.lit(chunks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    values = ["row", "id", "label", "dim", "vector"]
    as_anchor = rows.where("is_anchor").select(*values, own_block.alias("block"), every(chunks).alias("chunk"), F.lit(0).alias("is_row"))
    as_row = rows.select(*values, every(blocks).alias("block"), own_chunk.alias("chunk"), F.lit(1).alias("is_row"))
    tasks = min(blocks * chunks, MAX_TASKS)
    task = ((F.col("block").cast("long") * chunks + F.col("chunk")) % tasks).cast("int")
    met = as_anchor.unionByName(as_row).repartitionById(tasks, task).sortWithinPartitions("dim", "block", "chunk", "is_row")
    pairs = map_rows(met, _scored(n_positives, n_negatives, low, scale), "anchor long, anchor_id long, lowered long, negative boolean, id long")
    ordered = pairs.repartition("anchor").sortWithinPartitions("anchor", "lowered", "negative", F.asc_nulls_last("id"))
    return map_rows(ordered, _mined(n_positives, n_negatives, low), _RESULT)
