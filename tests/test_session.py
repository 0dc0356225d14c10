from types import SimpleNamespace

import pytest

from verbascope import session


def fake(master, named=None, current=None):
    seen = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=seen.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named)), seen


def test_named_folder_is_used():
    spark, seen = fake("yarn", named="hdfs:///shared")
    session.ensure_checkpoint_dir(spark)
    assert seen == ["hdfs:///shared"]


def test_a_folder_already_set_stays():
    spark, seen = fake("yarn", current="hdfs:///set")
    session.ensure_checkpoint_dir(spark)
    assert seen == []


def test_no_local_folder_on_a_cluster():
    spark, seen = fake("spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(spark)
    local, seen = fake("local[2]")
    session.ensure_checkpoint_dir(local)
    assert len(seen) == 1


def test_stable_copies(spark):
    frame = spark.range(5).selectExpr("id", "rand() r")
    for keep in (session.stable_copy, session.stable_table):
        kept = keep(frame)
        assert sorted(kept.collect()) == sorted(kept.collect()) and kept.count() == 5
