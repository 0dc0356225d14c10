"""Indexed substring search against a scan."""

import random

import pytest

from verbascope.operators.filters import mentions
from verbascope.sources.search import TextIndex

TEXTS = ["Selamat pagi", "ÉCOLE primaire", "a\nb\nc", "", None, "ab", "日本語の文", "𝒳𝒴𝒵 xyz", "100% [a-z]+ .*", "straße GROSS", "aaaaaa"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    words = [x for x in TEXTS if x]
    data = [(i, rng.choice(TEXTS), " ".join(rng.sample(words, 2)) if i % 3 else rng.choice(TEXTS)) for i in range(300)]
    return spark.createDataFrame(data, "row_id long, source string, hypothesis string").cache()


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    made = TextIndex(spark, f"file:{tmp_path_factory.mktemp('index')}")
    made.build(rows, ["row_id"], block_rows=20)
    return made


@pytest.mark.parametrize("query", ["pagi", "PAGI", "école", "b\nc", "ab", "a", "", "本語の", "𝒴𝒵 x", "% [a", "ss", "aaaaa", "pagi ", "nowhere", "mat pag", "STRASSE"])
def test_equals_scan(rows, index, query):
    condition = mentions(query)
    want = rows if condition is None else rows.where(condition)
    order = lambda df: sorted(r.row_id for r in df.collect())
    assert order(index.search(query)) == order(want)


def test_only_candidate_files_are_read(spark, tmp_path):
    rows = spark.createDataFrame([(i, "needle" if i == 777 else f"text {i}", None) for i in range(1000)], "row_id long, source string, hypothesis string")
    index = TextIndex(spark, f"file:{tmp_path}/index")
    index.build(rows, ["row_id"], block_rows=50)
    assert index.candidates("needle").count() == 1 and index.candidates("ne") is None
    found = index.search("NEEDLE")
    assert [r.row_id for r in found.collect()] == [777]
    plan = found._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(block" in plan.toString()
    read = spark.read.parquet(f"file:{tmp_path}/index/rows").select("block").distinct().count()
    assert read == 20


def test_hypothesis_alone_is_found(spark, tmp_path):
    rows = spark.createDataFrame([(1, "here is nothing", "only HERE: zebra"), (2, "zebra", None), (3, "x", "y")], "row_id long, source string, hypothesis string")
    index = TextIndex(spark, f"file:{tmp_path}/index")
    index.build(rows, ["row_id"])
    assert {r.row_id for r in index.search("zebra").collect()} == {1, 2}
    index.build(rows.where("false"), ["row_id"])
    assert index.search("zebra").count() == 0
