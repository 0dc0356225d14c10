import random

import pytest
from pyspark.sql import functions as F

from verbascope.operators import joins, ranking
from verbascope.operators.ranking import first_per_key, flag_first, head_per_group, nth_row, top_per_group


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.choice([0.1, 0.5, 0.9, None]), i << 18) for i in range(200)]
    return spark.createDataFrame(data, "k string, v double, row_id bigint").repartition(6).cache()


def python_rows(rows):
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: r[2])


@pytest.mark.parametrize("n", [4, 30, 500])
def test_top_per_group_keeps_input_order_on_ties(rows, monkeypatch, n):
    monkeypatch.setattr(ranking, "_WIDE_TOP", 10)
    got = top_per_group(rows, ["k"], [F.asc_nulls_last("v"), F.asc("row_id")], n).collect()
    for key in ("a", "b", None):
        mine = [r for r in python_rows(rows) if r[0] == key]
        want = sorted(mine, key=lambda r: (r[1] is None, r[1] or 0))[:n]
        assert sorted((tuple(r) for r in got if r.k == key), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("n", [0, 1, 3, 17, 500])
def test_head_per_group_both_ways(rows, n):
    direct = head_per_group(rows, ["k"], n)
    counted = head_per_group(rows, ["k"], n, direct=-1)
    assert python_rows(direct) == python_rows(counted)
    for key in ("a", "b", None):
        mine = [r for r in python_rows(rows) if r[0] == key]
        assert [r for r in python_rows(counted) if r[0] == key] == mine[:n]


def test_head_without_limit(rows):
    assert head_per_group(rows, ["k"], None).count() == 200


ORDER = (("v", True), ("row_id", False))


@pytest.mark.parametrize("n", [1, 2, 75, 150, 999])
def test_nth_row_both_ways(rows, n):
    known = rows.where("v is not null")
    ordered = sorted(python_rows(known), key=lambda r: (-r[1], r[2]))
    want = ordered[min(n, len(ordered)) - 1][1:]
    assert tuple(nth_row(known, ORDER, n).first()) == want
    assert tuple(nth_row(known, ORDER, n, direct=0).first()) == want


@pytest.mark.parametrize("n", [0, 1, 60, 150, 999])
@pytest.mark.parametrize("direct", [1_000_000, 0])
def test_flag_first(rows, n, direct):
    among = F.col("k") == "a"
    known = rows.where("v is not null")
    flagged = flag_first(known, ORDER, n, "first", among, direct)
    mine = [r for r in python_rows(known) if r[0] == "a"]
    want = {r[2] for r in sorted(mine, key=lambda r: (-r[1], r[2]))[:n]}
    assert {r.row_id for r in flagged.where("first").collect()} == want
    assert flagged.where("first is null").count() == 0


def test_first_per_key(spark):
    frame = spark.createDataFrame([("x", 2, "late"), ("x", 1, "early"), (None, 5, "n")], "k string, row_id int, v string")
    got = {r.k: r.v for r in first_per_key(frame, ["k"], F.col("v"), "v").collect()}
    assert got == {"x": "early", None: "n"}


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, l int")
    right = spark.createDataFrame([("a", 10), (None, 20), ("c", 30)], "k string, r int")
    got = joins.null_safe_join(left, right, ["k"]).collect()
    assert sorted((r.l, r.r) for r in got) == [(1, 10), (2, 20)]
    assert joins.null_safe_join(left, right.where("k = 'a'"), ["k"], "left_anti").first().l == 2


def test_spread_join_equals_plain_join(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, "hot").alias("k"))
    groups = spark.createDataFrame([("hot", 1), (None, 2), ("unused", 3)], "k string, g int")
    got = joins.spread_join(big, groups, ["k"], ["id"], salts=7)
    assert got.columns == ["id", "k", "g"]
    assert {(r.k, r.n, r.g) for r in got.groupBy("k").agg(F.count("*").alias("n"), F.max("g").alias("g")).collect()} == {
        ("hot", 900, 1), (None, 100, 2),
    }


@pytest.mark.parametrize("parity", [0, 1])
def test_semi_join_with_hot_keys(spark, parity):
    big = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id").cast("string")).alias("k")
    )
    counted = big.groupBy("k").agg(F.count("*").alias("n_rows"), F.max("id").alias("m"))
    got = joins.semi_join_split(big, counted, ["k"], "n_rows", F.col("m") % 2 == parity)
    want = {r.k for r in counted.where(f"m % 2 = {parity}").collect()}
    assert (None in want) == (parity == 1)
    expected = [r.id for r in big.collect() if r.k in want]
    assert sorted(r.id for r in got.collect()) == expected


def test_small_side_measures(spark):
    frame = spark.createDataFrame([("x" * 100,)] * 3, "v string")
    assert joins.small_side(frame)[1] is True
    assert joins.small_side(frame, limit=50)[1] is False
    assert joins.measured_bytes(frame.where("false")) == 0
