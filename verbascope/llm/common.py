"""Helpers the operators of this subpackage share: row streams, the held-out rule, word and range hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.session import ship_package, stable_table

__all__ = ["held_out", "map_rows", "runs_of", "stable_table", "word_hashes", "shingle_set", "RangeHash"]

# ASCII white space, as in [^\x20\x09-\x0D]+; bytes.split() cuts at the same six bytes.
SPACES = b" \t\n\v\f\r"

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_RANDOM = np.random.default_rng(20_011)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def held_out() -> Column:
    """Documents that no model may learn from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def map_rows(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package sent to the workers first."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def runs_of(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[dict[str, list]]:
    """Columns of one group after the other, from rows that arrive sorted by ``keys``; holds one group at a time."""
    held: dict[str, list] | None = None
    key: tuple | None = None
    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        found = list(zip(*[columns[k] for k in keys], strict=True))
        start = 0
        while start < len(found):
            end = start + 1
            while end < len(found) and found[end] == found[start]:
                end += 1
            piece = {name: values[start:end] for name, values in columns.items()}
            if found[start] == key:
                for name, values in piece.items():
                    held[name].extend(values)
            else:
                if held is not None:
                    yield held
                held, key = piece, found[start]
            start = end
    if held is not None:
        yield held


def slices(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """The same rows in shorter batches, so that few texts at a time become Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_POWERS = [Powers(b) for b in _BASES]


class RangeHash:
    """Hash of any byte range of a text in constant time, from prefix sums of byte values times powers."""

    def __init__(self, data: np.ndarray, which: int = 0):
        """``data``: bytes, or 64-bit hashes of words for ranges of words."""
        up, self.down = _POWERS[which].reach(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_BYTES[data] if data.dtype == np.uint8 else data) * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text given as bytes."""
    edge = np.ones(len(data) + 2, np.int8)
    edge[1:-1] = _SPACE[data]
    step = np.diff(edge)
    return np.flatnonzero(step == -1), np.flatnonzero(step == 1)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_bounds(data)
    return RangeHash(data).of(starts, ends)


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; of the whole sequence if it is shorter; none without words."""
    width = min(width, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = (total + words[i : i + n]) * np.uint64(_BASES[0])
    return mixed(total + np.uint64(width))


def shingle_set(text: str | bytes | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text with A-Z lower-cased."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = text.encode() if isinstance(text, str) else text
    return np.unique(windows(word_hashes(raw.lower()), width))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The texts of a batch as UTF-8 bytes, without decoding them."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
