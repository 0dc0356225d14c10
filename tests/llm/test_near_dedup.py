"""Min-max near-dedup and components against brute force."""

import random
import re

import pytest

from verbascope.llm import minhash
from verbascope.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """component_id and set size by all pairs of exact shingle sets."""
    sets = []
    for _, text in rows:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        width = min(5, len(words))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                up[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in members.items()}
    return sorted(((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))), key=repr)


def answer(frame):
    found = frame.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)


def family(seed, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def rows():
    texts = family(1, 40, 4) + family(2, 6, 2) + [family(3, 1, 0)[0]] * 5
    texts += [None, "", " \n\t", "one two", "ONE  two", "one two three", "a b c d e", "A b c d e f", "Ä b c d e", "ä b c d e"]
    texts += [f"only {i} here and nowhere else at all {i * 7}" for i in range(20)]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("block", [2048, 7])
def test_components_equal_brute_force(spark, rows, block):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answer(minhash.near_duplicates(docs, block=block)) == brute(rows)


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert answer(minhash.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    long = family(4, 1, 0)[0]
    rows = [(1, long), (1, long), (None, long), (2, "other text with enough words in it"), (2, long), (None, None)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, key int, component int, bands int")
    found = minhash.near_duplicates(docs)
    assert answer(found.where("doc_id is not null")) == [(1, 116, 1), (1, 116, 1), (2, 116, 1), (2, 3, 2)]
    assert {(r.component_id, r.n_shingles) for r in found.where("doc_id is null").collect()} == {(1, 116), (None, 0)}
    kept = minhash.keep_one(docs, found)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2]


def test_shared_ids_lose_no_document(spark):
    one, two = family(5, 1, 0)[0], family(6, 1, 0)[0]
    rows = [(7, one), (7, one + " end"), (7, two), (None, "quite another text"), (None, "yet one more text"), (8, ""), (9, None), (9, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, group int, print int")
    kept = minhash.keep_one(docs, minhash.near_duplicates(docs))
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert len([t for t in texts if t in rows[:2]]) == 1
    assert sorted((t for t in texts if t not in rows[:2]), key=repr) == sorted(set(rows[2:]), key=repr)


def test_no_link_of_small_sets_is_lost(spark):
    """Pairs at the threshold, 3 of 4 to 12 of 16 shingles: bands alone would lose some of them."""
    rng, rows = random.Random(9), []
    for pair in range(20_000):
        n = 3 * (1 + pair % 4)
        words = [f"v{rng.randrange(10**7)}" for _ in range(n + 4 + n // 3)]
        # A common opening, so that many sets share their shingles without being alike.
        start = "all of these notes begin" if n == 12 and pair % 3 == 0 else ""
        rows += [(2 * pair, f"{start} {' '.join(words[: n + 4])}"), (2 * pair + 1, f"{start} {' '.join(words)}")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    lost = found.where("component_id != doc_id - doc_id % 2").count()
    assert (lost, found.count()) == (0, len(rows))


def test_many_rows_without_an_id(spark):
    texts = family(8, 30, 3) + [f"short {i} text {i} here" for i in range(300)] + [None] * 40
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    found = minhash.near_duplicates(docs)
    assert found.count() == len(texts)
    assert found.where("n_shingles > 50").select("group").distinct().count() == 1
    assert minhash.keep_one(docs, found).count() == 1 + 300 + 1


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101), (100, 101)], "u long, v long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
