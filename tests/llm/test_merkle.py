"""Manifest and proofs on small tables, against a plain tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from verbascope.llm import merkle
from verbascope.llm.queries import op13_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, place):
    """(siblings to the left, siblings to the right) on every level that has more than one node."""
    for nodes in levels[:-1]:
        start = place // 3 * 3
        yield nodes[start:place], nodes[place + 1 : start + 3]
        place //= 3


def brute(rows, alter=lambda row: row[4]):
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append(row[:5])
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for group in by.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in by[s]]) for s in sources]
    top = tree([t[-1][0] for t in trees])
    found = Counter()
    for number, s in enumerate(sources):
        for place, row in enumerate(by[s]):
            steps = [*path(trees[number], place), *path(top, number)]
            node = leaf((*row[:4], alter(row)))
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*(x for left, right in steps for x in (*left, *right)))
            found[row[0], leaf(row), trees[number][-1][0], top[-1][0], proof, node, node == top[-1][0]] += 1
    return found


def tampered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 2:
        return row[4]
    return row[4].replace("\n", "")


def altered():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def proved(spark, rows, text=None, extra=""):
    return Counter(map(tuple, merkle.prove(spark.createDataFrame(rows, SCHEMA + extra).repartition(3), text).collect()))


@pytest.mark.parametrize("part,levels", [(7, 1), (40, 2), (16_384, 6)])
def test_equals_plain_tree(spark, monkeypatch, part, levels):
    monkeypatch.setattr(merkle, "PART_LEAVES", part)
    monkeypatch.setattr(merkle, "ROUND_LEVELS", levels)
    rng = random.Random(part)
    sizes = {"hot": 130, "a": 1, "b": 2, "c": 3, "d": 4, "é": 10, "": 28, None: 27, "z": 1}
    rows = [(i, s, "en", i % 5, f"t\n{i}") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rng.shuffle(rows)
    found = proved(spark, rows, altered())
    assert found == brute(rows, tampered)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_sizes_of_one_source(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "PART_LEAVES", 10)
    rows = [(i * 7 - 50, "s", None, None, None) for i in range(n)]
    assert proved(spark, rows) == brute(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PART_LEAVES", 5)
    rows = [
        (None, None, None, None, None), (None, "s", "en", 1, "x"), (None, "s", "en", 1, "y"), (1, "s", "en", 1, ""), (1, "s", "en", 1, ""), (1, "s", "en", 2, "\n"),
        (2, "s", "en", None, "\n" * 100_000 + "é"), (-3, "s", "12:en", 1, "-"), (4, "t", "", 0, "a:b"), *[(9, "t", "en", 1, "same\n")] * 30,
    ]
    assert proved(spark, rows, altered()) == brute(rows, tampered)
    more = [(*r, 1, "x", b"y") for r in rows]
    assert proved(spark, more, altered(), ", tree int, node string, altered binary") == brute(rows, tampered)


def test_empty_table(spark):
    assert not proved(spark, [])


def test_missing_nodes_are_least():
    """A node that the part can derive is never fetched, and every fetched one is used."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 200)
        lo = rng.randrange(n)
        hi = rng.randrange(lo + 1, n + 1)
        levels = tree([h(str(i)) for i in range(n)])
        wanted = list(merkle.missing(lo, hi, n))
        assert len(set(wanted)) == len(wanted)
        fetched = {(0, level, place): levels[level][place].encode() for level, place in wanted}
        used = {}

        class Seen(dict):
            def __getitem__(self, key):
                used[key] = True
                return fetched[key]

        _, top = merkle.derive(0, lo, [x.encode() for x in levels[0][lo:hi]], n, Seen())
        assert top.decode() == levels[-1][0] and used.keys() == fetched.keys()
        for level, place in wanted:
            span = 3**level
            assert place * span >= hi or (place + 1) * span <= lo


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*merkle.FIELDS).collect()]
    assert Counter(map(tuple, op13_merkle_manifest(spark, sf).collect())) == brute(rows, tampered)
