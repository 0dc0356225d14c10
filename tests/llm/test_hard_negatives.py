"""Hard negatives on small tables, against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbascope.llm import hardneg
from verbascope.llm.queries import op11_hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, is_anchor, n_positives=5, n_negatives=5, low=80, scale=256):
    fit = [
        (n, i, label, [math.floor(scale * x) for x in v])
        for n, (i, label, v, *_) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for n, i, label, v in fit:
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for m, j, other, w in fit if m != n and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, positive, _ in [s for s in scored if s[2] == label][:n_positives]:
            fits = [s for s in scored if s[2] != label and low * score <= 100 * s[0] <= 100 * score][:n_negatives]
            found += [(i, positive, rank, j, score, s) for rank, (s, j, _) in enumerate(fits, 1)]
    return Counter(found)


def mined(spark, rows, extra="", **options):
    frame = spark.createDataFrame(rows, SCHEMA + extra).repartition(3)
    return Counter(map(tuple, hardneg.hard_negatives(frame, F.col("vec_id") % 10 == 0, **options).collect()))


def every_tenth(i):
    return i is not None and i % 10 == 0


@pytest.mark.parametrize("seed,spread", [(1, 2.0), (2, 0.02), (3, 300.0)])
def test_equals_brute_force(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(hardneg, "BLOCK", 4)
    monkeypatch.setattr(hardneg, "CHUNK", 40)
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), [rng.gauss(0.3 * spread, spread) for _ in range(3)]) for i in range(200)]
    want = brute(rows, every_tenth)
    assert sum(want.values()) > 100
    assert mined(spark, rows) == want


def test_one_vector_in_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "CHUNK", 50)
    rng = random.Random(4)
    hot = [0.5, 0.25, -0.125]
    rows = [(i, rng.randrange(2), hot if rng.random() < 0.4 else [rng.uniform(-1, 1) for _ in hot]) for i in range(300)]
    assert mined(spark, rows) == brute(rows, every_tenth)


def test_odd_rows(spark):
    one, half = [1.0, 0.0], [0.9, 0.1]
    rows = [
        (0, 1, one, "x", 1), (1, 1, one, "x", 1), (2, 2, half, "x", 1), (3, 2, one, None, 2), (3, 2, one, None, 2),
        (10, 2, one, "x", 1), (10, 2, one, "x", 1), (10, 1, half, "x", 1), (20, 1, [], "x", 1), (21, 1, [], "x", 1), (22, 2, [], "x", 1),
        (30, 1, [1.0], "x", 1), (31, None, one, "x", 1), (32, 1, None, "x", 1), (33, 1, [1.0, None], "x", 1),
        (34, 1, [1.0, float("nan")], "x", 1), (35, 1, [float("inf"), 1.0], "x", 1), (None, 1, one, "x", 1), (None, 2, one, "x", 1),
        (-10, 1, [-1.0, 0.0], "x", 1),
    ]
    found = mined(spark, rows, ", score string, anchor int")
    assert found == brute(rows, every_tenth) and (20, 21, 1, 22, 0, 0) in found


def test_whole_numbers_beyond_floats(spark):
    rows = [(i, i % 2, [1e6 + i, 3e5 - i, 1.0 * i]) for i in range(40)]
    assert mined(spark, rows) == brute(rows, every_tenth)
    far = np.array([[1e300, 1.0]])
    assert hardneg.inner_products(far, far)[0, 0] == 2**63 - 1
    assert hardneg.inner_products(far, -far)[0, 0] == -(2**63) + 1


def test_empty_tables(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(1, 1, [1.0])])
    assert not mined(spark, [(0, 1, [1.0])])


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    found = op11_hard_negatives(spark, sf)
    assert found.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert Counter(map(tuple, found.collect())) == brute(rows, lambda i: i % 100 == 0)
