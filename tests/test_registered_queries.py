"""Every registered query against its SQL on the smallest tables, and the plans of the important ones."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of
from verbascope.operators import quantiles
from verbascope.operators.ranking import head_per_group, top_per_group
from verbascope.workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"
MODEL_JOBS = {"batch_infer", "score_pairs"}

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


# Every query of the library itself has SQL; those of optional parts are tested beside them.
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    frame = queries()[name](spark, SF)
    got = rows_of(frame.columns, frame.collect())
    found = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(frame.columns)
    assert got == rows_of(columns, found.fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in MODEL_JOBS:
        assert "EvalPython" not in plan and "InPandas" not in plan


def test_entry(spark):
    assert entry(spark).count() > 0


def test_score_summaries_never_read_texts(spark, plan_of, monkeypatch):
    # Box numbers read their input into a table of values first; that reading is judged then.
    original, tables = quantiles.stable_table, []
    monkeypatch.setattr(quantiles, "stable_table", lambda df: tables.append(plan_of(df)) or original(df))
    for name in ("summary_overall", "summary_by_language", "qe_summary", "box_scores", "score_histogram", "coverage_matrix"):
        tables.clear()
        plans = [plan_of(queries()[name](spark, SF)), *tables]
        scans = [line for plan in plans for line in plan.splitlines() if "documents.parquet" in line]
        assert scans and all("text:string" not in line for line in scans), name


def test_box_numbers_shuffle_no_values(spark, plan_of):
    """Extremes and fences come from small tables that are there already; no text is read for them."""
    plan = plan_of(queries()["box_lengths"](spark, SF))
    assert "__salt" not in plan and "documents.parquet" not in plan


def test_browsing_sorts_only_the_top(spark, plan_of):
    assert "TakeOrderedAndProject(limit=500" in plan_of(queries()["browse_worst"](spark, SF))


def test_ranking_drops_rows_before_the_shuffle(spark, plan_of):
    frame = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    for top in (top_per_group(frame, ["k"], [F.desc("id")], 2), head_per_group(frame, ["k"], 2, "id")):
        plan = plan_of(top)
        final = plan[: plan.find("Initial Plan")]
        assert final.count("WindowGroupLimit") == 2
