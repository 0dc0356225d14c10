import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from verbascope.plans import jobs, stats
from verbascope.sources import readers

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def answers():
    def answer(prompt):
        if "7" in prompt:
            raise RuntimeError("refused")
        return prompt[-6:]

    return answer


def broken():
    raise RuntimeError("model does not load")


@pytest.fixture
def corpus(tmp_path):
    path = tmp_path / "mono_sea.jsonl"
    path.write_text("".join(
        json.dumps({"id1": "s", "id2": i, "lang_codes": "id" if i % 3 else "ms", "text": f"gak satu dua tiga row {chr(97 + i)}"
                    + (" 7" if i == 4 else ""), "translation": f"ref {i}"}) + "\n" for i in range(12)))
    return str(path)


def test_evaluation_from_corpus_to_scores(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    log = jobs.translate_corpora(spark, [corpus], {"o/good": answers, "o/bad": broken}, out, "r1", shots=2, partitions=2)
    assert list(log.done) == ["o/good"] and len(log.done["o/good"]) == 1
    rows = jobs.read_runs(spark, out, "r1").collect()
    good = [r for r in rows if r.model == "o/good"]
    assert len(good) == 10 and sum(r.error is not None for r in good) == 1
    assert {r.dataset for r in good} == {"mono_sea"}
    meta = {r["model"]: r for r in spark.read.json(f"{out}/meta").collect()}
    assert (meta["o/good"]["n_rows"], meta["o/good"]["n_errors"], meta["o/good"]["num_shots"]) == (10, 1, 2)
    assert meta["o/good"]["req_per_s"] > 0 and "o/bad" in log.failed and "o/bad" not in meta
    scorers = {"ifeval": lambda: lambda texts: ["clean"] * len(texts), "qe": lambda: lambda a, b: [0.9] * len(a)}
    jobs.score_translations(jobs.read_runs(spark, out, "r1").where("model = 'o/good'"), scorers, f"{out}/scored")
    scored = spark.read.parquet(f"{out}/scored")
    assert scored.count() == 9 and scored.where("ifeval = 1 and comet_qe = 0.9").count() == 9
    assert stats.coverage(scored).first().mono_sea == "ran (9)"


def test_folder_jobs(spark, tmp_path):
    folder = tmp_path / "results"
    folder.mkdir()
    (folder / "o_a_mono_sea_scored.csv").write_text(
        "model,id1,id2,language,source,hypothesis,reference,ifeval,comet_qe\no/a,1,2,id,gak \"\"mau,h,r,1.0,0.9\no/a,1,3,id,x,h,r,,0.1\n"
    )
    (folder / "o_a_translations_mono_sea.csv.meta.json").write_text(
        json.dumps({"model": "o/a", "n_rows": 4, "n_errors": 2, "elapsed_seconds": 2.0, "req_per_s": 2.0})
    )
    jobs.summarise_folder(spark, str(folder), str(tmp_path / "sum"), 0.8)
    overall = spark.read.option("header", True).csv(str(tmp_path / "sum/summary_overall")).first()
    assert (overall.model, overall.error_rate, overall.joint_pass_rate) == ("o/a", "0.5", "0.5")
    lexicon = tmp_path / "raw.csv"
    lexicon.write_text("slang,formal\ngak,tidak\n")
    jobs.build_lexicon_file(spark, str(lexicon), str(tmp_path / "lex"))
    args = (str(folder), str(tmp_path / "lex"), str(tmp_path / "enriched"))
    assert not jobs.enrich_folder(spark, *args, dry_run=True)


def test_split_job(spark, corpus, tmp_path):
    lexicon = tmp_path / "lex.json"
    lexicon.write_text('{"gak": "tidak"}')
    report = jobs.split_corpus(spark, corpus, str(lexicon), str(tmp_path / "split"), n_slang=3).first()
    assert report.n_slang == 3
    names = {p.name for p in (tmp_path / "split").iterdir()}
    assert names == {"mono_sea_id_slang", "mono_sea_id_formal"}
    read = readers.read_json_lines(spark, corpus).where(F.col("lang_codes") == "id").count()
    written = sum(spark.read.text(str(tmp_path / "split" / n)).count() for n in names)
    assert written == read


def test_enrich_job_writes_once(spark, tmp_path):
    (tmp_path / "o_a_mono_me_scored.csv").write_text("model,source,comet_qe\no/a,gak mau\n")
    (tmp_path / "lex.json").write_text('{"gak": "tidak"}')
    out = str(tmp_path / "enriched")
    assert jobs.enrich_folder(spark, str(tmp_path), str(tmp_path / "lex.json"), out)
    row = spark.read.parquet(out).first()
    assert (row.slang_density, row.slang_hits, row.n_tokens, row.dataset) == (0.5, 1, 2, "mono_me")


def test_enrich_job_judges_each_file(spark, tmp_path):
    folder = tmp_path / "results"
    folder.mkdir()
    (folder / "o_a_mono_me_scored.csv").write_text("source,comet_qe\ngak mau,\nmau,\n")
    (folder / "o_b_mono_me_scored.csv").write_text("source,slang_density,slang_hits,n_tokens\ngak,1.0,1,1\n")
    (tmp_path / "lex.json").write_text('{"gak": "tidak"}')
    args = (spark, str(folder), str(tmp_path / "lex.json"))
    assert not jobs.enrich_folder(*args, str(tmp_path / "none"), dry_run=True)
    log = jobs.enrich_folder(*args, str(tmp_path / "one"))
    assert (log.files, log.rows, log.skipped) == (1, 2, 1)
    assert {r.file_name for r in spark.read.parquet(str(tmp_path / "one")).collect()} == {"o_a_mono_me_scored.csv"}
    log = jobs.enrich_folder(*args, str(tmp_path / "all"), overwrite=True)
    assert (log.files, log.rows, log.skipped) == (2, 3, 0)
