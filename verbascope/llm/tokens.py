"""Token ids in patched frame-of-reference blocks.

File format, little endian. A segment holds the ids of whole documents in a row:
``b"VPF1"``, number of ids (u32), number of blocks (u32), start of every block from the first block on (u32 each), blocks.
A block holds up to 512 ids: least id (u32), bit width (u8), number of exceptions (u16), packed differences to the least
id (``width`` bits each, low bit first, the last block filled up with zeros), places of the exceptions (u16 each) and
their differences (u32 each). The width is that of the 90th percentile of the differences; larger ones are exceptions.
Segments are rows of a Parquet table in the folder: part, segment, start in the part, doc ids, ids per document, payload.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbascope.llm.common import batch_of, map_rows
from verbascope.operators.joins import small_side
from verbascope.session import ensure_checkpoint_dir

END_ID = 2
BLOCK = 512
PERCENTILE = 0.9
# A segment ends with the document that brings it to this many ids.
SEGMENT_IDS = 1 << 18
# Chunks of text whose ids a worker remembers.
CACHED = 800_000
MAGIC = b"VPF1"

_SEGMENTS = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("payload", pa.binary())]
)
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = byte_characters()


def in_chunks(tokenizer) -> bool:
    """Whether texts may be encoded by chunks: byte level, with the usual pattern, and nothing before or around it."""
    made = json.loads(tokenizer.to_str())
    pre = made["pre_tokenizer"] or {}
    return made["normalizer"] is None and made["model"]["type"] == "BPE" and all(
        pre.get(k) == v for k, v in (("type", "ByteLevel"), ("use_regex", True), ("add_prefix_space", False))
    ) and all(t["content"].startswith("<|") for t in made["added_tokens"])


class Unsplit(Exception):
    """A chunk at whose edge the pre-tokenizer may look across."""


# Marks that are one piece together after a letter.
_MARKS = ".,;:!?#*$%&"


class ChunkIds(dict):
    """Ids of `` chunk`` as bytes, for chunks between single spaces; without the space for ``bare`` chunks.

    The pre-tokenizer always starts a piece at a space between two characters that are not white space, so a text's ids
    are those of its chunks. It also parts a letter from the marks after it, and a single line break from what stands around
    it; so words are remembered without these. Chunks next to other white space, and those that may spell a special
    token, are refused.
    """

    def __init__(self, tokenizer, lead: str = " "):
        self.tokenizer, self.lead, self.model = tokenizer, lead, tokenizer.model
        self.bare = ChunkIds(tokenizer, "") if lead else self
        self.line = ids_bytes(tokenizer.encode("\n", add_special_tokens=False).ids)

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        if chunk.isalpha():  # one piece: only the model's merges are left to do
            shown = (self.lead + chunk).encode().decode("latin-1").translate(_SHOWN)
            found = self[chunk] = ids_bytes([token.id for token in self.model.tokenize(shown)])
            return found
        if not chunk or chunk[0].isspace() or chunk[-1].isspace() or "<|" in chunk:
            raise Unsplit
        if "\n" in chunk:
            first, *rest = chunk.split("\n")
            return self.line.join([self[first], *map(self.bare.__getitem__, rest)])
        word = chunk.rstrip(_MARKS)
        if word and len(word) < len(chunk) and word[-1].isalpha():
            found = self[word] + self.bare[chunk[len(word) :]]
        else:
            found = ids_bytes(self.tokenizer.encode(self.lead + chunk, add_special_tokens=False).ids)
        self[chunk] = found
        return found


def ids_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def text_ids(text: str, tokenizer, known: ChunkIds | None, tail: bytes) -> bytes:
    """Ids of a text and the end id, as little-endian unsigned 32-bit integers."""
    if known is None:
        return ids_bytes(tokenizer.encode(text, add_special_tokens=False).ids) + tail
    head, *chunks = text.split(" ")
    try:
        if not chunks:
            raise Unsplit
        return known.bare[head] + b"".join(map(known.__getitem__, chunks)) + tail
    except Unsplit:
        return ids_bytes(tokenizer.encode(text, add_special_tokens=False).ids) + tail


def _whole(width: int) -> np.dtype:
    """The integers that values of ``width`` bits go through."""
    return np.dtype("<u2" if width <= 16 else "<u4")


def pack(ids: np.ndarray) -> bytes:
    """One segment's payload."""
    n, n_blocks = len(ids), -(-len(ids) // BLOCK)
    table = np.zeros((n_blocks, BLOCK), np.uint32)
    table.ravel()[:n] = ids
    sizes = np.full(n_blocks, BLOCK)
    if n % BLOCK:
        sizes[-1] = n % BLOCK
        table[-1, n % BLOCK :] = table[-1, 0]
    least = table.min(axis=1)
    rest = table - least[:, None]
    place = int(np.ceil((BLOCK - 1) * PERCENTILE))
    limit = np.partition(rest, place, axis=1)[:, place]
    widths = np.zeros(n_blocks, np.uint8)
    for bit in range(32):
        widths[limit >> np.uint32(bit) > 0] = bit + 1
    outlier = rest > ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    packed: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        kind = _whole(width)
        low = np.where(outlier[at], 0, rest[at]).astype(kind)
        bits = np.unpackbits(low.view(np.uint8), axis=1, bitorder="little").reshape(len(at), BLOCK, -1)[:, :, :width]
        for i, row in zip(at, np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little"), strict=True):
            packed[i] = row.tobytes()
    blocks = []
    for i in range(n_blocks):
        places = np.flatnonzero(outlier[i])
        head = least[i].tobytes() + widths[i].tobytes() + np.uint16(len(places)).tobytes()
        blocks.append(head + packed[i] + places.astype(np.uint16).tobytes() + rest[i, places].tobytes())
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.uint32)[:n_blocks]
    return MAGIC + np.uint32(n).tobytes() + np.uint32(n_blocks).tobytes() + starts.tobytes() + b"".join(blocks)


def unpack(payload: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """Ids of a segment, or of some of its blocks by the index of their starts."""
    if payload[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    n, n_blocks = np.frombuffer(payload, np.uint32, 2, 4).tolist()
    starts = np.frombuffer(payload, np.uint32, n_blocks, 12).astype(np.int64) + 12 + 4 * n_blocks
    wanted = range(n_blocks)[first_block:last_block]
    table = np.zeros((len(wanted), BLOCK), np.uint32)
    widths: dict[int, list[int]] = {}
    for row, i in enumerate(wanted):
        widths.setdefault(payload[starts[i] + 4], []).append(row)
    for width, rows in widths.items():
        if width:
            size = BLOCK * width // 8
            raw = np.frombuffer(b"".join(payload[(s := starts[wanted[r]] + 7) : s + size] for r in rows), np.uint8)
            bits = np.unpackbits(raw, bitorder="little").reshape(len(rows), BLOCK, width)
            kind = _whole(width)
            wide = np.zeros((len(rows), BLOCK, 8 * kind.itemsize), np.uint8)
            wide[:, :, :width] = bits
            table[rows] = np.packbits(wide.reshape(len(rows), -1), axis=1, bitorder="little").view(kind)
    for row, i in enumerate(wanted):
        s = int(starts[i])
        n_out = int.from_bytes(payload[s + 5 : s + 7], "little")
        if n_out:
            s += 7 + BLOCK * payload[s + 4] // 8
            table[row, np.frombuffer(payload, np.uint16, n_out, s)] = np.frombuffer(payload[s + 2 * n_out : s + 6 * n_out], np.uint32)
        table[row] += np.uint32(int.from_bytes(payload[starts[i] : starts[i] + 4], "little"))
    end = min(n, wanted.stop * BLOCK) - first_block * BLOCK
    return table.ravel()[: max(0, end)]


@lru_cache(maxsize=1)
def _loaded(path: str):
    """The tokenizer and the chunks it knows by now; a Python worker keeps them from task to task."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, ChunkIds(tokenizer) if in_chunks(tokenizer) else None


def _encoded(path: str, end_id: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = _loaded(path)
        tail, part = ids_bytes([end_id]), TaskContext.get().partitionId()
        segment, first, n = 0, 0, 0
        keys, pieces = [], []

        def close():
            counts = [len(p) // 4 for p in pieces]
            payload = pack(np.frombuffer(b"".join(pieces), np.uint32))
            return batch_of(_SEGMENTS, part=[part], segment=[segment], first=[first], n_ids=[n], doc_ids=[keys], counts=[counts], payload=[payload])

        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                keys.append(key)
                pieces.append(text_ids(text or "", tokenizer, known, tail))
                n += len(pieces[-1]) // 4
                if n >= SEGMENT_IDS:
                    yield close()
                    segment, first, n, keys, pieces = segment + 1, first + n, 0, [], []
        if keys:
            yield close()

    return encoded


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every row of ``docs`` (doc_id, text) and write the segments to ``folder`` in ascending doc_id order.

    ``tokenizer`` is the path of a tokenizers file that every executor has. Null ids come first; a null text is empty and
    has the end id only; rows with one id stay in the order of their texts. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "part int, segment int, first long, n_ids long, doc_ids array<long>, counts array<long>, payload binary"
    map_rows(ordered, _encoded(tokenizer, end_id), schema).write.parquet(folder)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ["before", "doc_ids", "counts", "payload"]
        for before, keys, counts, payload in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            ids = unpack(payload)
            ends = np.cumsum(counts)
            starts = ends - counts
            crcs = [zlib.crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield batch_of(_READ, doc_id=keys, start=(starts + before).tolist(), n_tokens=counts, ids_crc32=crcs)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    ``start`` counts the ids of all documents before it: segments carry their start in their part, and the totals of
    the parts, one short row for each, are summed up.
    """
    segments = spark.read.parquet(folder)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts, _ = small_side(totals.select("part", before.alias("of_part")))
    placed = segments.join(parts, "part").select((F.col("first") + F.col("of_part")).alias("before"), "doc_ids", "counts", "payload")
    return map_rows(placed, _decoded, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write to a new folder beside the checkpoints and read back; see ``write_tokens`` and ``read_tokens``."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tokens-{uuid4().hex}"
    write_tokens(docs, folder, tokenizer, end_id)
    return read_tokens(spark, folder)
