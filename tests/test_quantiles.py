import numpy as np
import pytest
from pyspark.sql import functions as F

from verbascope.operators.histograms import histogram
from verbascope.operators import quantiles as module
from verbascope.operators.quantiles import (
    box_numbers,
    order_bucket,
    quantiles,
    quantiles_of_counts,
    value_counts,
    values_at,
)

PROBS = {"p0": 0.0, "p10": 0.1, "q1": 0.25, "median": 0.5, "p90": 0.9, "p100": 1.0}
RNG = np.random.default_rng(7)
CASES = {
    "scores": RNG.random(997),
    "few_values": RNG.integers(0, 4, 500) / 3,
    "one": np.array([0.25]),
    "two": np.array([-1.5, 4.0]),
    "signs_and_zero": np.concatenate([RNG.normal(0, 1, 300), np.zeros(50), -np.zeros(3)]),
    "wide": np.concatenate([10.0 ** RNG.uniform(-300, 300, 200), -(10.0 ** RNG.uniform(-300, 300, 200))]),
    "outlier": np.concatenate([RNG.random(100), [1e300]]),
    "close": 1.0 + np.arange(400) * 2.0**-52,
    "hot": np.concatenate([np.full(2000, 0.5), RNG.random(50)]),
}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(name, float(v)) for name, values in CASES.items() for v in values]
    rows += [(None, float(v)) for v in range(10)] + [("scores", None), ("scores", float("nan")), ("empty", None)]
    return spark.createDataFrame(rows, "k string, v double").repartition(5).cache()


@pytest.mark.parametrize("way", ["rows", "rows_unbroadcast", "counts"])
def test_quantiles_match_numpy(table, monkeypatch, way):
    if way == "rows_unbroadcast":
        original = module.small_side
        monkeypatch.setattr(module, "small_side", lambda frame, limit: original(frame, 0))
    if way == "counts":
        frame = quantiles_of_counts(value_counts(table, ["k"], F.col("v")), ["k"], PROBS)
    else:
        frame = quantiles(table, ["k"], F.col("v"), PROBS)
    got = {r.k: r for r in frame.collect()}
    assert set(got) == set(CASES) | {None}
    for name, values in {**CASES, None: np.arange(10.0)}.items():
        for label, p in PROBS.items():
            assert got[name][label] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300), (name, label)


def test_without_keys_and_empty(table):
    everything = np.concatenate([*CASES.values(), np.arange(10.0)])
    row = quantiles(table, [], F.col("v"), {"m": 0.5}).collect()
    assert len(row) == 1 and row[0].m == pytest.approx(np.median(everything))
    assert quantiles(table.where("false"), ["k"], F.col("v"), PROBS).count() == 0


def test_buckets_never_fall(spark):
    values = np.unique(np.concatenate([*CASES.values(), [5e-324, -5e-324, 1.7e308, float("inf"), -float("inf")],
                                       np.nextafter(2.0 ** np.arange(-20, 20), 0), 2.0 ** np.arange(-20, 20)]))
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    buckets = [r.b for r in frame.select("v", order_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_values_at_ranks(spark):
    frame = spark.createDataFrame([(float(v),) for v in (5, 1, 1, 3)], "v double")
    ranks = {"second": lambda total: F.lit(1), "last": lambda total: total - 1}
    row = values_at(value_counts(frame, [], F.col("v")), [], ranks).first()
    assert (row.second, row["last"], row.total) == (1.0, 5.0, 4)


def test_box_numbers(table):
    got = {r.k: r for r in box_numbers(table, ["k"], F.col("v")).collect()}
    for name in ("scores", "few_values", "one", "signs_and_zero", "outlier", "hot"):
        values, row = CASES[name], got[name]
        q1, q3 = np.quantile(values, [0.25, 0.75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        assert (row.n, row.min, row.max) == (len(values), values.min(), values.max())
        assert row.lower_fence == pytest.approx(inside.min()) and row.upper_fence == pytest.approx(inside.max())


def test_histogram(spark):
    rows = [("a", 0.0), ("a", 0.1), ("a", 1.0), ("b", 0.99), ("b", -0.5), ("b", 1.5), ("b", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    fixed = {(r.k, r.bin): r.n for r in histogram(frame, ["k"], F.col("v"), 10, 0.0, 1.0).collect()}
    assert fixed == {("a", 0): 1, ("a", 1): 1, ("a", 9): 1, ("b", 9): 1, ("b", -1): 1, ("b", 10): 1}
    spanned = histogram(frame, ["k"], F.col("v"), 4).collect()
    assert sum(r.n for r in spanned) == 6 and {r.bin for r in spanned} <= {0, 1, 2, 3}
    same = histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), [], F.col("v"), 8).collect()
    assert [(r.bin, r.n) for r in same] == [(0, 3)]


@pytest.mark.parametrize("single", [0, 1, 50])
def test_every_cut_finds_the_same(table, monkeypatch, single):
    monkeypatch.setattr(module, "SINGLE_ROWS", single)
    got = {r.k: r for r in quantiles(table, ["k"], F.col("v"), PROBS).collect()}
    for name, values in CASES.items():
        for label, p in PROBS.items():
            assert got[name][label] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300), (name, label)
    boxes = {r.k: r for r in box_numbers(table, ["k"], F.col("v")).collect()}
    assert boxes["close"].median == np.quantile(CASES["close"], 0.5)


def test_digits_name_every_double(spark):
    rng = np.random.default_rng(3)
    values = np.unique(np.concatenate([rng.integers(-(2**63), 2**63 - 1, 3000).view(np.float64), 1.0 + np.arange(300) * 2.0**-52,
                                       -1.0 - np.arange(300) * 2.0**-52, [0.0, 5e-324, -5e-324, 2.0**-1074 * 3]]))
    values = values[np.isfinite(values)]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    v = F.col("v")
    digits = frame.select("v", F.struct(order_bucket(v), *[module.order_digit(v, cut) for cut in range(3)]).alias("d")).orderBy("v")
    found = [tuple(r.d) for r in digits.collect()]
    assert found == sorted(found) and len(set(found)) == len(values)


def test_close_values_spread_over_tasks(spark):
    """200,000 values within 1e-4 are one bucket; after the cuts no group of single values is large."""
    frame = spark.range(0, 200_000, numPartitions=4).select((F.lit(0.75) + F.col("id") * 5e-10).alias("v"))
    assert frame.select(order_bucket(F.col("v"))).distinct().count() <= 2
    found = quantiles(frame, [], F.col("v"), {"m": 0.5, "q": 0.9})
    values = 0.75 + np.arange(200_000) * 5e-10
    row = found.first()
    assert row.m == pytest.approx(np.quantile(values, 0.5), abs=1e-15) and row.q == pytest.approx(np.quantile(values, 0.9), abs=1e-15)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__cut0" in plan
