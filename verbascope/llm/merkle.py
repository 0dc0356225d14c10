"""Merkle manifest of a dataset: a ternary tree per source under one root, and proofs by one multiproof a partition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbascope.llm.common import batch_of, map_rows, runs_of, stable_table
from verbascope.llm.mixing import ranked
from verbascope.operators.joins import null_safe_join, small_side

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Leaves that one task proves at a time, and levels that one shuffle of the build goes up (3^6 leaves in a block).
PART_LEAVES = 16_384
ROUND_LEVELS = 6
# Number of the tree over the subroots of all sources.
TOP = -1

_NODES = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])
_WANTED = pa.schema([("part", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("place", pa.int64())])
_PROVED = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])


def above(n: int) -> int:
    """Nodes of the next level over ``n`` nodes."""
    return -(-n // ARITY)


def parent(run: Sequence[bytes]) -> bytes:
    """Node over a run of nodes; nodes are hex digests in ASCII."""
    return sha256(b"".join(run)).hexdigest().encode()


def leaf_of(*values: Column) -> Column:
    """Digest of a row: each value as ``-`` if null, else its UTF-8 length, a colon and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def missing(lo: int, hi: int, n: int) -> Iterator[tuple[int, int]]:
    """(level, place) of the nodes that leaves ``lo`` to ``hi`` of a tree of ``n`` need beside their own to reach the top.

    What the leaves and the nodes over them give is left out, so this is the least such set: siblings beyond either end,
    four a level at most.
    """
    level = 0
    while n > 1:
        start, end = lo // ARITY * ARITY, min(above(hi) * ARITY, n)
        yield from ((level, place) for place in (*range(start, lo), *range(hi, end)))
        lo, hi, n, level = lo // ARITY, above(hi), above(n), level + 1


def derive(tree: int, lo: int, own: list[bytes], n: int, fetched: dict[tuple[int, int, int], bytes]) -> tuple[list[tuple[int, list[bytes]]], bytes]:
    """Whole runs of each level as (place of the first node, nodes), and the top, from own leaves and fetched nodes."""
    levels = []
    while n > 1:
        hi, level = lo + len(own), len(levels)
        start, end = lo // ARITY * ARITY, min(above(hi) * ARITY, n)
        left, right = ([fetched[tree, level, place] for place in span] for span in (range(start, lo), range(hi, end)))
        nodes = left + own + right
        levels.append((start, nodes))
        own = [parent(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
        lo, n = start // ARITY, above(n)
    return levels, own[0]


def siblings(levels: list[tuple[int, list[bytes]]], tail: bytes) -> list[bytes]:
    """For each node of the lowest level its siblings on all levels from there to the top, then ``tail``, as one text."""
    tails, first = [tail], 0
    for start, nodes in reversed(levels):
        found = []
        for i in range(len(nodes)):
            run = nodes[i - i % ARITY : i - i % ARITY + ARITY]
            found.append(b"".join(run[: i % ARITY] + run[i % ARITY + 1 :]) + tails[(start + i) // ARITY - first])
        tails, first = found, start
    return tails


def fold(node: bytes, place: int, levels: list[tuple[int, list[bytes]]]) -> bytes:
    """The top that ``node``, put at ``place``, gives with the siblings of that place."""
    for start, nodes in levels:
        at = place - start
        run = nodes[at - at % ARITY : at - at % ARITY + ARITY]
        run[at % ARITY] = node
        node, place = parent(run), place // ARITY
    return node


def _reduced(base: int):
    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nodes of the next levels over each block of ``ARITY ** ROUND_LEVELS`` nodes, ``n`` being those of the whole level."""
        for block in runs_of(batches, ["tree", "block"]):
            tree, n, first, out = block["tree"][0], block["n"][0], block["place"][0], []
            nodes = [x.hex().encode() for x in block["node"]]
            for level in range(base + 1, base + ROUND_LEVELS + 1):
                if n == 1:
                    break
                nodes = [parent(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
                first, n = first // ARITY, above(n)
                out += [(tree, level, first + i, n, bytes.fromhex(x.decode())) for i, x in enumerate(nodes)]
            if out:
                yield batch_of(_NODES, **dict(zip(_NODES.names, zip(*out, strict=True), strict=True)))

    return reduced


def build(leaves: DataFrame, widest: int) -> DataFrame:
    """All nodes (tree, level, place, n, node) over ``leaves`` (tree, place, n, node), ``n`` being the nodes of the level.

    ``widest`` is the largest tree's number of leaves. A shuffle goes up several levels at once: a block of consecutive
    nodes is one group, and a tree of any size many of them.
    """
    level, current, found = 0, leaves, []
    while widest > 1:
        block = F.floor(F.col("place") / ARITY**ROUND_LEVELS).cast("long").alias("block")
        dealt = current.select("tree", "place", "n", "node", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
        found.append(stable_table(map_rows(dealt, _reduced(level), "tree long, level int, place long, n long, node binary")))
        level += ROUND_LEVELS
        current = found[-1].where((F.col("level") == level) & (F.col("n") > 1))
        for _ in range(ROUND_LEVELS):
            widest = above(widest)
    base = leaves.select("tree", F.lit(0).alias("level"), "place", "n", "node")
    return reduce(DataFrame.unionByName, found, base)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("part", "tree", "lo", "hi", "n")), strict=True)
        out = [(part, tree, level, place) for part, tree, lo, hi, n in rows for level, place in missing(lo, hi, n)]
        if out:
            yield batch_of(_WANTED, **dict(zip(_WANTED.names, zip(*out, strict=True), strict=True)))


def _proved(n_sources: int, root: bytes):
    def proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One part at a time: nodes it fetched come first, then its leaves by tree and place."""
        for part in runs_of(batches, ["part"]):
            names = ["is_leaf", "tree", "level", "place", "n", "node", "altered", "doc_id"]
            fetched, trees = {}, {}
            for is_leaf, tree, level, place, n, node, altered, doc_id in zip(*(part[c] for c in names), strict=True):
                if is_leaf:
                    trees.setdefault(tree, (place, n, []))[2].append((node.hex().encode(), altered.hex().encode() if altered else None, doc_id))
                else:
                    fetched[tree, level, place] = node.hex().encode()
            below = {tree: derive(tree, lo, [row[0] for row in rows], n, fetched) for tree, (lo, n, rows) in trees.items()}
            first = min(trees)
            top, found = derive(TOP, first, [below[tree][1] for tree in sorted(trees)], n_sources, fetched)
            if found != root:
                raise ValueError(f"nodes of part {part['part'][0]} do not lead to the root of the manifest")
            above_all = siblings(top, b"")
            for tree, (lo, _, rows) in trees.items():
                levels, subroot = below[tree]
                proofs = siblings(levels, above_all[tree - (top[0][0] if top else first)])
                skip = lo - levels[0][0] if levels else 0
                out = []
                for i, (leaf, altered, doc_id) in enumerate(rows):
                    folded = fold(fold(altered or leaf, lo + i, levels), tree, top)
                    out.append((doc_id, leaf.decode(), subroot.decode(), root.decode(), sha256(proofs[skip + i]).hexdigest(), folded.decode(), folded == root))
                yield batch_of(_PROVED, **dict(zip(_PROVED.names, zip(*out, strict=True), strict=True)))

    return proved


def prove(docs: DataFrame, altered_text: Column | None = None) -> DataFrame:
    """Root, proof and verdict of every row of ``docs`` (doc_id, source, lang, n_chars, text).

    A row is a leaf, the digest of its five values. Per source, leaves in ascending order of doc_id go up in runs of
    three until one node is left, the subroot; subroots in order of source, null first, go up the same way to the root.
    ``altered_text`` is the text of the copy under test (none: the text itself): ``folded_root`` is what its leaf gives
    with the siblings of the row, and ``verified`` whether that is the root. Returns doc_id, leaf, subroot, root,
    proof_sha256 (digest of the siblings, from the leaf to the root, left to right), folded_root, verified.

    Leaves are ranged in parts of some thousand by (source, doc_id, leaf, number), so no source, id or repeated row is
    hot. For each part the nodes that its leaves cannot give are listed once and fetched by one join on (tree, level,
    place); the part derives the shared nodes over its leaves, and cuts every single proof from them.

    A null id comes first in its source and a null source first of all; rows of one id go by their leaf; equal rows are
    leaves of their own. Nulls, empty and long texts are hashed like others. A table without rows gives none. Other
    columns are ignored.
    """
    altered = F.col("text") if altered_text is None else altered_text
    given = [F.col(c) for c in FIELDS[:-1]]
    leaf, changed = leaf_of(*given, F.col("text")), leaf_of(*given, altered)
    leaves = stable_table(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf.alias("leaf"), changed.alias("changed")
    ).select(
        "doc_id", "source", F.unhex("leaf").alias("node"), F.when(F.col("leaf") != F.col("changed"), F.unhex("changed")).alias("altered"),
        F.monotonically_increasing_id().alias("number"),
    ))
    parts = max(1, -(-leaves.count() // PART_LEAVES))
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("node"), F.asc("number")]
    ranged = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stable_table(ranged.select("doc_id", "source", "node", "altered", F.monotonically_increasing_id().alias("at"))).withColumn("part", F.shiftright("at", 33))

    # Which leaves of which source each part has: a row for each part, and one more for each source that begins in it.
    spans = stable_table(placed.groupBy("part", "source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")))
    sources = spans.groupBy("source").agg(F.sum("rows").alias("n"))
    n_sources, widest, has_null = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0)), F.count_if(F.col("source").isNull())).first()
    tree = F.when(F.col("source").isNull(), 0).otherwise(F.col("rank") + has_null).cast("long")
    sources = ranked(sources, "source").select("source", "n", tree.alias("tree"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("lo", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    spans = stable_table(null_safe_join(spans, sources, ["source"]).select("part", "source", "first", "lo", (F.col("lo") + F.col("rows")).alias("hi"), "tree", "n"))
    side, _ = small_side(spans.select("part", "source", "first", "lo", "tree", "n"))
    numbered = null_safe_join(placed, side, ["part", "source"])
    numbered = numbered.select("part", "tree", (F.col("at") - F.col("first") + F.col("lo")).alias("place"), "n", "node", "altered", "doc_id")

    nodes = build(numbered.select("tree", "place", "n", "node"), widest)
    subroots = nodes.where("n = 1").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n_sources).cast("long").alias("n"), "node")
    tops = build(stable_table(subroots), n_sources)
    root = tops.where("n = 1").select(F.lower(F.hex("node"))).first()

    over = spans.groupBy("part").agg(F.min("tree").alias("lo"), (F.max("tree") + 1).alias("hi"))
    over = over.select("part", F.lit(TOP).cast("long").alias("tree"), "lo", "hi", F.lit(n_sources).cast("long").alias("n"))
    wanted = map_rows(spans.select("part", "tree", "lo", "hi", "n").unionByName(over), _wanted, "part long, tree long, level int, place long")
    wanted, _ = small_side(wanted)
    fetched = nodes.unionByName(tops).join(wanted, ["tree", "level", "place"])
    none = lambda kind: F.lit(None).cast(kind)
    together = fetched.select(
        "part", F.lit(False).alias("is_leaf"), "tree", "level", "place", "n", "node", none("binary").alias("altered"), none("long").alias("doc_id")
    ).unionByName(numbered.select("part", F.lit(True).alias("is_leaf"), "tree", F.lit(0).alias("level"), "place", "n", "node", "altered", "doc_id"))
    dealt = together.repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions("part", "is_leaf", "tree", "place")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return map_rows(dealt, _proved(n_sources, root[0].encode() if root else b""), schema)
