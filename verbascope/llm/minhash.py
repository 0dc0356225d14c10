"""Near-duplicate documents by min-max hashing.

One permutation gives two signature values, the least and the greatest hash of the set, so ``BANDS * VALUES`` values
cost half as many hash evaluations. Documents with the same set are one class. Classes that share a band form candidate
groups; links inside a group are confirmed on the full shingle sets.

In small sets a permutation's minimum and maximum depend on each other, so bands miss more there. Small sets therefore
also meet by their rarest shingles: two sets that share three quarters of their union share one of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.llm.common import batch_of, map_rows, mixed, runs_of, shingle_set, stable_table, text_bytes
from verbascope.llm.components import connected_components

WIDTH = 5
PERCENT = 75
# A pair at exactly the threshold shares no band with probability (1 - 0.75^6)^48 = 8e-5.
BANDS = 48
VALUES = 6
# Two linked sets of up to this many shingles always meet; beyond, bands alone miss 1e-4 of the pairs at the threshold.
SMALL = 16
# Members of a candidate group that one task compares at once; larger groups go in pairs of blocks.
BLOCK = 2048

_RANDOM = np.random.default_rng(75)
_PERMS = BANDS * VALUES // 2
_FLIP = _RANDOM.integers(0, 2**32, _PERMS, dtype=np.uint32)
_TIMES = _RANDOM.integers(0, 2**31, _PERMS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _RANDOM.integers(0, 2**63, VALUES, dtype=np.uint64) | np.uint64(1)

_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("print", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("bands", pa.list_(pa.int64())),
    ("few", pa.list_(pa.int64())),
])
_LINKED = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, from the minima and maxima of the set under each permutation."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(_PERMS, 2**32 - 1, np.uint32)
    most = np.zeros(_PERMS, np.uint32)
    for start in range(0, len(values), 512):
        hashed = (values[start : start + 512, None] ^ _FLIP) * _TIMES
        np.minimum(least, hashed.min(axis=0), out=least)
        np.maximum(most, hashed.max(axis=0), out=most)
    signature = np.stack([least, most], axis=1).reshape(BANDS, VALUES).astype(np.uint64)
    return mixed((signature * _BAND).sum(axis=1, dtype=np.uint64)).view(np.int64)


def set_hash(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a set; none for the empty set."""
    if not len(shingles):
        return None
    return b"".join(mixed(shingles ^ np.uint64(flip)).sum(dtype=np.uint64).tobytes() for flip in (0, 0x5DEECE66D))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, hashes, bands, few = [], [], [], []
        for text in text_bytes(batch):
            found = shingle_set(text, WIDTH)
            sizes.append(len(found))
            hashes.append(set_hash(found))
            bands.append(band_hashes(found) if len(found) else None)
            few.append(found.view(np.int64) if 0 < len(found) <= SMALL else None)
        yield batch_of(
            _SIGNED, doc_id=batch.column("doc_id"), print=batch.column("print"), n_shingles=sizes, set_hash=hashes, bands=bands, few=few
        )


class Forest:
    """Union-find over the positions of a group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct values."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, ["part", "one", "two"]):
            sets = [shingle_set(t, WIDTH) for t in group["text"]]
            right = [i for i, found in enumerate(sets) if set_hash(found) == group["set_hash"][i]]
            if len(right) < 2:
                continue
            sets = [sets[i] for i in right]
            keys = np.array(group["key"], np.int64)[right]
            blocks = np.array(group["block"])[right]
            apart = group["one"][0] != group["two"][0]
            bands = np.array([group["bands"][i] for i in right], np.int64)
            rare = [group["rare"][i] or () for i in right]
            holders: dict[int, list[int]] = {}
            forest = Forest(len(keys))
            for i in range(len(keys)):
                shared = (bands[:i] == bands[i]).any(axis=1)
                for shingle in rare[i]:
                    shared[holders.setdefault(shingle, [])] = True
                    holders[shingle].append(i)
                if apart:
                    shared &= blocks[:i] != blocks[i]
                for j in np.flatnonzero(shared).tolist():
                    if forest.root(i) != forest.root(j) and similar(sets[i], sets[j], percent):
                        forest.join(i, j)
            roots = [forest.root(i) for i in range(len(keys))]
            yield batch_of(
                _LINKED,
                u=[int(keys[i]) for i in range(len(keys)) if roots[i] != i],
                v=[int(keys[r]) for i, r in enumerate(roots) if r != i],
            )

    return confirm


def _with_rare(classes: DataFrame, percent: int) -> DataFrame:
    """Add ``rare`` to small sets: the n - ceil(n * percent / 100) + 1 shingles that the fewest small sets hold.

    All sets order shingles alike, by count and then by hash, so linked sets share one of these.
    """
    held = classes.where(F.col("few").isNotNull()).select("key", F.explode("few").alias("shingle"))
    shared = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_sets")).where("n_sets > 1")
    counted = held.join(shared, "shingle", "left").select("key", F.struct(F.coalesce("n_sets", F.lit(1)), "shingle").alias("counted"))
    # At most SMALL entries a set.
    ordered = counted.groupBy("key").agg(F.sort_array(F.collect_list("counted")).alias("ordered"))
    n = F.size("ordered")
    first = F.slice("ordered", F.lit(1), (n - F.ceil(n * percent / 100) + 1).cast("int"))
    rare = ordered.select("key", F.transform(first, lambda x: x["shingle"]).alias("rare"))
    return classes.drop("few").join(rare, "key", "left")


def _candidate_groups(classes: DataFrame) -> DataFrame:
    """(key, part): the classes that share a band or a rare shingle with another, by component of these."""
    banded = classes.select("key", F.posexplode("bands").alias("band", "value"))
    banded = banded.unionByName(classes.select("key", F.lit(BANDS).alias("band"), F.explode("rare").alias("value")))
    buckets = banded.groupBy("band", "value").agg(F.min("key").alias("v"), F.max("key").alias("most"))
    shared = buckets.where(F.col("v") != F.col("most")).drop("most")
    links = banded.join(shared, ["band", "value"]).where(F.col("key") != F.col("v")).select(F.col("key").alias("u"), "v").distinct()
    return connected_components(links).select(F.col("node").alias("key"), F.col("component").alias("part"))


def _blocks(groups: DataFrame, block: int) -> DataFrame:
    """Repeat each member for every pair of blocks it takes part in; groups of one block stay single."""
    sizes = groups.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_blocks"))
    placed = groups.join(sizes, "part").withColumn("block", F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int"))
    others = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    return others.select(
        "key", "part", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Component of linked documents for each row of ``docs`` (doc_id, text).

    Returns doc_id, n_shingles, component_id (least doc_id that links reach), kept (doc_id = component_id), print (hash of
    id and text) and group (the component's own number; null without shingles; not the same in each run). Null and
    empty texts have no shingles and are their own component. A null doc_id takes no part in the minimum; it is kept
    only if its whole component has no id. Repeated rows come out as often as they came in. Other columns are ignored.
    """
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    given = docs.select(key.alias("doc_id"), F.xxhash64(key, text).alias("print"), text.alias("text"))
    signed = stable_table(map_rows(given, _signatures, "doc_id long, print long, n_shingles long, set_hash binary, bands array<long>, few array<long>"))
    full = signed.where(F.col("set_hash").isNotNull())
    # Each class is known by one row: that of its least id, known ids before missing ones.
    chosen = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print"))
    first = full.groupBy("set_hash").agg(chosen.alias("row")).select(
        "set_hash", F.col("row.doc_id").alias("first_id"), F.col("row.print").alias("first_print")
    )
    sample = full.select("set_hash", "bands", "few").dropDuplicates(["set_hash"])
    classes = stable_table(first.join(sample, "set_hash").withColumn("key", F.monotonically_increasing_id()))
    classes = stable_table(_with_rare(classes, percent))
    groups = stable_table(_candidate_groups(classes))
    members = _blocks(groups, block).join(classes.drop("first_id"), "key")
    # Its text is fetched by the print, which covers the id; the task asks whether it has that set.
    texts = given.select(F.col("print").alias("first_print"), "text")
    tasks = texts.join(members, "first_print").repartition("part", "one", "two").sortWithinPartitions("part", "one", "two", "key")
    columns = ["part", "one", "two", "key", "block", "bands", "rare", "set_hash", "text"]
    links = map_rows(tasks.select(*columns), _confirm(percent), "u long, v long")
    labels = connected_components(links)
    named = classes.select("key", "set_hash", "first_id").join(labels.withColumnRenamed("node", "key"), "key", "left")
    named = stable_table(named.select("set_hash", "first_id", F.coalesce("component", "key").alias("component")))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_set = named.join(least, "component").select("set_hash", "component_id", F.col("component").alias("group"))
    rows = signed.select("doc_id", "print", "n_shingles", "set_hash").join(by_set, "set_hash", "left")
    component = F.when(F.col("set_hash").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "print", "group"
    )


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of ``found``, which is of ``near_duplicates(docs)``.

    It is the row of the least id; where that id repeats inside the component, one of its texts. Rows without shingles
    all stay. Different texts that merely share an id, or have none, are judged by their components. Rows equal in id
    and text count as one.
    """
    kept = found.where("kept").select(F.coalesce("doc_id", F.lit(-(2**63))).alias("__id"), F.col("print").alias("__print"), "group")
    grouped = kept.where(F.col("group").isNotNull()).groupBy("group", "__id").agg(F.min("__print").alias("__print"))
    wanted = grouped.select("__id", "__print").unionByName(kept.where(F.col("group").isNull()).select("__id", "__print"))
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.withColumns({"__id": F.coalesce(key, F.lit(-(2**63))), "__print": F.xxhash64(key, text)})
    return rows.join(wanted, ["__id", "__print"], "left_semi").dropDuplicates(["__id", "__print"]).drop("__id", "__print")
