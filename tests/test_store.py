"""The run store, and the chain from translation to report through it."""

import json
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from verbascope.plans import jobs, summary
from verbascope.session import scratch, stable_table
from verbascope.sources import readers, writers
from verbascope.sources.store import RunConflict, RunStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = ["model", "dataset"]


@pytest.fixture
def store(spark, tmp_path):
    return RunStore(spark, f"file:{tmp_path}/store")


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "model string, dataset string, row_id long, error string")


def content(df):
    return sorted((r.model, r.dataset, r.row_id) for r in df.collect())


def test_a_repeated_run_replaces_itself_only(spark, store):
    first = rows_of(spark, [("o/a", "d", 1, None), ("o/a", "d", 2, "x"), ("o/b", "d", 3, None)])
    store.write("translations", first, "r1", {"shots": 0})
    store.write("translations", first.where("model = 'o/a'"), "r2", {"shots": 0})
    records = store.write("translations", rows_of(spark, [("o/a", "d", 9, None)]), "r1", {"shots": 0})
    assert [(r.model, r.n_rows, r.n_errors, r.version[:6]) for r in records.collect()] == [("o/a", 1, 0, "000002")]
    assert content(store.read("translations", "r1")) == [("o/a", "d", 9), ("o/b", "d", 3)]
    assert content(store.read("translations", "r2")) == [("o/a", "d", 1), ("o/a", "d", 2)]
    assert store.records().count() == 3
    versions = list(Path(store.root.removeprefix("file:")).glob("translations/run_id=r1/dataset=d/model_slug=o_a/version=*"))
    assert len(versions) == 1


def test_other_settings_are_refused(spark, store):
    rows = rows_of(spark, [("o/a", "d", 1, None)])
    store.write("translations", rows, "r", {"shots": 0, "corpus": "c"})
    store.write("translations", rows, "r", {"corpus": "c", "shots": 0})
    with pytest.raises(RunConflict, match="other settings"):
        store.write("translations", rows, "r", {"shots": 3, "corpus": "c"})
    with pytest.raises(RunConflict, match="share its folder"):
        store.write("translations", rows_of(spark, [("o:a", "d", 1, None)]), "r", {"shots": 0, "corpus": "c"})
    with pytest.raises(RunConflict, match="one folder name"):
        store.write("translations", rows_of(spark, [("o:b", "d", 1, None), ("o/b", "d", 1, None)]), "r", {})
    store.write("translations", rows, "r", {"shots": 3, "corpus": "c"}, replace=True)
    assert store.records().count() == 1 and json.loads(store.records().first().settings)["shots"] == 3


def test_a_run_that_dies_changes_nothing(spark, store, monkeypatch):
    store.write("translations", rows_of(spark, [("o/a", "d", 1, None)]), "r", {})
    monkeypatch.setattr(RunStore, "_record", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.write("translations", rows_of(spark, [("o/a", "d", 2, None)]), "r", {})
    monkeypatch.undo()
    assert content(store.read("translations", "r")) == [("o/a", "d", 1)]
    store.write("translations", rows_of(spark, []), "r", {}, keys=[("o/a", "d")])
    assert content(store.read("translations", "r")) == []
    assert store.records("translations", "r").first().n_rows == 0


def test_odd_names(spark, store, plan_of):
    rows = rows_of(spark, [("007", "1", 1, None), ("a b/c=d%", None, 2, None), ("a b/c=d%", "x/y", 3, None)])
    for run in ("001", "1"):
        for _ in range(2):
            store.write("translations", rows, run, {})
    read = store.read("translations", "001")
    assert {(r.model, r.dataset, r.run_id, r.row_id) for r in read.collect()} == {(r.model, r.dataset, "001", r.row_id) for r in rows.collect()}
    assert content(store.read("translations", "001", model="007")) == [("007", "1", 1)]
    assert "PartitionFilters: [isnotnull(run_id" in plan_of(read)
    assert store.records().count() == 6


def test_no_runs_yet(spark, store):
    assert store.records().count() == 0
    with pytest.raises(FileNotFoundError):
        store.read("scored", "r")


def test_later_columns_are_read(spark, store):
    rows = rows_of(spark, [("o/a", "d", 1, None)])
    store.write("scored", rows, "r1", {})
    store.write("scored", rows.withColumn("comet", F.lit(0.5)), "r2", {})
    assert sorted(((r.run_id, r.comet) for r in store.read("scored").collect()), key=str) == [("r1", None), ("r2", 0.5)]


def upper():
    return lambda prompt: prompt[-5:].upper()


def clean():
    return lambda texts: ["clean"] * len(texts)


def near():
    return lambda sources, outputs: [0.5 + len(o) / 100 for o in outputs]


def test_chain_twice_gives_one_row_a_run(spark, tmp_path):
    corpora = []
    for name in ("mono_sea", "mono_me"):
        corpora.append(str(tmp_path / f"{name}.jsonl"))
        lines = [json.dumps({"id1": "s", "id2": i, "lang_codes": "id", "text": f"{name} text {i}"}) for i in range(8)]
        Path(corpora[-1]).write_text("\n".join(lines))
    out, scorers = str(tmp_path / "out"), {"ifeval": clean, "qe": near}
    for _ in range(2):
        log = jobs.translate_corpora(spark, corpora, {"o/a": upper, "o/b": upper}, out, "r1")
        assert not log.failed
        assert jobs.score_run(spark, out, "r1", scorers).count() == 4
        jobs.summarise_run(spark, out, "r1", str(tmp_path / "sum"), 0.8)
        jobs.report_run(spark, out, "r1", str(tmp_path / "report"))
    overall = spark.read.option("header", True).csv(str(tmp_path / "sum/summary_overall")).collect()
    assert sorted((r.model, r.dataset, r.n_rows_scored, r.n_source_rows) for r in overall) == [
        (m, d, "8", "8") for m in ("o/a", "o/b") for d in ("mono_me", "mono_sea")
    ]
    assert RunStore(spark, out).records().count() == 8
    assert {p.name for p in (tmp_path / "report").iterdir()} == {"score_averages", "qe_summary", "qe_by_lang", "score_histogram", "ifeval_summary", "worst_rows"}
    # Scores of another metric beside the first ones, without a new translation.
    jobs.score_run(spark, out, "r1", {"qe": near}, "qe", scored_as="r1-qe")
    assert content(RunStore(spark, out).read("scored", "r1-qe")) == content(RunStore(spark, out).read("translations", "r1"))
    log = jobs.translate_corpora(spark, corpora, {"o/a": upper}, out, "r1", max_rows=2)
    assert "other settings" in log.failed["o/a"]
    # The metadata reader takes the records of the store.
    meta = readers.read_run_meta(spark, f"{out}/meta")
    assert meta.count() == 4 and {r.model_slug for r in meta.collect()} == {"o_a", "o_b"}


def test_newest_record_counts(spark, tmp_path):
    meta = spark.createDataFrame([("o/a", "d", 4, 0, 2.0)], "model string, dataset string, n_rows long, n_errors long, elapsed_seconds double")
    for errors in (3, 1):
        writers.write_run_metadata(writers.run_metadata(meta.withColumn("n_errors", F.lit(errors))), str(tmp_path / "meta"))
    groups = spark.createDataFrame([("o/a", "d", 4), ("o/z", None, 1)], "model string, dataset string, n long")
    found = {r.model: r for r in summary.with_run_meta(groups, readers.read_run_meta(spark, str(tmp_path / "meta"))).collect()}
    assert len(found) == 2 and found["o/a"].error_rate == 0.25 and found["o/z"].n_errors is None


def test_text_in_place_of_a_number_is_null(spark, tmp_path):
    (tmp_path / "o_m_translations_d.csv.meta.json").write_text(json.dumps({"model": "o/m", "n_rows": "12", "n_errors": 3, "elapsed_seconds": 1}))
    row = readers.read_run_meta(spark, str(tmp_path)).first()
    assert (row.n_rows, row.n_errors, row.elapsed_seconds) == (None, 3, 1.0)


def test_scratch_tables_go(spark):
    with pytest.raises(RuntimeError), scratch(spark):
        made = stable_table(spark.range(3))
        path = made.inputFiles()[0].removeprefix("file:").rpartition("/")[0].replace("//", "/")
        assert Path(path).exists()
        raise RuntimeError
    assert not Path(path).exists()
    assert stable_table(spark.range(3)).count() == 3
