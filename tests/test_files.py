import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from verbascope import schema as sc
from verbascope.operators.lexicon import build_lexicon, split_tracks, with_density
from verbascope.plans import summary
from verbascope.sources import readers, writers

ROW = {"id1": "s", "id2": 7, "lang_codes": "id", "text": "selamat pagi", "translation": "good morning"}


def lines_of(path):
    return [line for part in sorted(Path(path).glob("part-*")) for line in part.read_text("utf-8").splitlines()]


@pytest.fixture
def corpus(tmp_path):
    first = [{**ROW, "id2": i, "extra": i} for i in range(6)]
    body = "\n".join(json.dumps(r, ensure_ascii=False) for r in first[:3]) + "\n\n   \n"
    body += "\n".join(json.dumps(r) for r in first[3:]) + "\n"
    bad = json.dumps({**ROW, "text": "café X", "id1": None}, ensure_ascii=False).encode("utf-8").replace(b"X", b"\xff")
    (tmp_path / "mono_sea.jsonl").write_bytes(b"\xef\xbb\xbf" + body.encode() + bad)
    (tmp_path / "mono_me.jsonl").write_text(json.dumps({"text": "x y", "lang_count": 2, "is_code_switched": True}) + "\n")
    (tmp_path / "notes.txt").write_text("no corpus")
    return str(tmp_path)


def test_json_lines(spark, corpus):
    rows = readers.read_json_lines(spark, f"{corpus}/mono_sea.jsonl").orderBy("row_id").collect()
    assert [r.id2 for r in rows] == ["0", "1", "2", "3", "4", "5", "7"]
    assert rows[0].dataset == "mono_sea" and json.loads(rows[0].raw)["extra"] == 0
    assert rows[-1].text == "café �" and rows[-1].id1 is None and rows[-1].lang_count is None


def test_malformed_line_is_an_error(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"text": "ok"}\n{"text": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_lines(spark, str(tmp_path / "bad.jsonl")).collect()


def test_row_cap_is_per_file(spark, corpus):
    rows = readers.read_json_lines(spark, corpus, max_rows=2).collect()
    assert sorted((r.dataset, r.id2) for r in rows if r.dataset == "mono_sea") == [("mono_sea", "0"), ("mono_sea", "1")]
    assert len(rows) == 3


@pytest.mark.parametrize("cap", [0, 1, 123, 499, 900])
def test_row_cap_over_many_blocks(spark, tmp_path, plan_of, cap):
    lines = [json.dumps({"id2": i, "text": "w" * (i % 90)}) + "\n" * (1 + i % 3) for i in range(500)]
    (tmp_path / "long.jsonl").write_text("".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = readers.read_json_lines(spark, str(tmp_path), max_rows=cap)
        assert sorted(int(r.id2) for r in rows.collect()) == list(range(min(cap, 500)))
        assert "Sort" not in plan_of(rows)
        assert cap == 0 or rows.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_source_folder_skips_absent_files(spark, corpus, tmp_path):
    rows = readers.read_source_folder(spark, corpus).collect()
    assert {r.dataset for r in rows} == {"mono_sea", "mono_me"} and len(rows) == 8
    me = next(r for r in rows if r.dataset == "mono_me")
    assert (me.text_chars, me.text_words, me.translation_chars, me.is_code_switched) == (3, 2, 0, True)
    (tmp_path / "empty").mkdir()
    assert readers.read_source_folder(spark, str(tmp_path / "empty")).count() == 0


def test_named_datasets(spark, corpus, tmp_path):
    (tmp_path / "hollow").mkdir()
    folders = {"all": corpus, "hollow": str(tmp_path / "hollow")}
    assert readers.read_eval_datasets(spark, folders, ["all", "all"]).count() == 8
    for name in ("hollow", "absent"):
        with pytest.raises(FileNotFoundError):
            readers.read_eval_datasets(spark, folders, [name])


NASTY = ['plain', 'two\nlines', 'with "quotes", commas', "back\\slash \\", "cr\r\nlf", "  lead", "NA", "None", "", "é…"]


def test_csv_round_trip(spark, tmp_path):
    rows = [("o/m", str(i), text, None if i == 0 else text) for i, text in enumerate(NASTY)]
    frame = spark.createDataFrame(rows, "model string, id2 string, source string, hypothesis string")
    path = str(tmp_path / "out")
    writers.write_csv(frame.coalesce(2), path)
    back = readers.read_translations(spark, path, "*.csv").collect()
    got = {r.id2: (r.source, r.hypothesis) for r in back}
    for i, text in enumerate(NASTY):
        want = text.replace("\r\n", "\n") if "\r" in text else text
        assert got[str(i)][0] in (text, want, text or None)
    assert got["0"][1] is None and got["6"] == ("NA", "NA")
    assert set(sc.TRANSLATION.fieldNames()) <= set(back[0].asDict())


def test_csv_headers_may_differ(spark, tmp_path):
    (tmp_path / "o_a_mono_sea_scored.csv").write_text('model,source,ifeval,comet_qe\no/a,"x\n1",1.0,0.5\no/a,y,,nan\n')
    (tmp_path / "o_b_mono_me_scored.csv").write_text("comet_qe,model,hypothesis,source\n0.25,o/b,h,z\n")
    (tmp_path / "o_c_other_scored.csv").write_text("model,source,ifeval,comet_qe\no/c,w,0,1\n")
    got = {r.source: r for r in readers.read_scored(spark, str(tmp_path)).collect()}
    assert got["x\n1"].dataset == "mono_sea" and got["x\n1"].ifeval == 1.0 and got["x\n1"].hypothesis is None
    assert got["y"].comet_qe is None and got["y"].ifeval is None
    assert (got["z"].comet_qe, got["z"].model, got["z"].dataset) == (0.25, "o/b", "mono_me")
    assert got["w"].dataset == "unknown" and len({r.row_id for r in got.values()}) == 4
    named = readers.read_scored_by_name(spark, str(tmp_path)).collect()
    assert {(r.model, r.model_slug) for r in named} == {("o/a", "o_a"), ("o/b", "o_b")}
    with pytest.raises(FileNotFoundError):
        readers.read_scored(spark, str(tmp_path), pattern="*_none.csv")


def test_run_meta(spark, tmp_path):
    assert readers.read_run_meta(spark, str(tmp_path)).count() == 0
    record = {"model": "o/m", "n_rows": 10, "n_errors": 1, "elapsed_seconds": 2.5, "req_per_s": None,
              "timestamp": "2025-01-02T03:04:05+00:00", "concurrency": 32}
    (tmp_path / "o_m_translations_mono_sea.csv.meta.json").write_text(json.dumps(record, indent=2))
    (tmp_path / "o_n_translations_mono_me.csv.meta.json").write_text(json.dumps({"model": "o/n", "req_per_s": "oops"}))
    got = {r.model: r for r in readers.read_run_meta(spark, str(tmp_path)).collect()}
    one = got["o/m"]
    assert (one.dataset, one.model_slug, one.n_rows, one.elapsed_seconds, one.req_per_s) == ("mono_sea", "o_m", 10, 2.5, None)
    assert one.timestamp.isoformat().startswith("2025-01-02T03:04:05")
    assert got["o/n"].req_per_s is None and got["o/n"].dataset == "mono_me"


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('slang,formal,other\n GAK ,tidak,1\ngak,nggak,2\n"a ""b""","x, y",3\nsama,sama,4\n')
    built = build_lexicon(readers.read_lexicon_csv(spark, str(tmp_path / "raw.csv")))
    path = str(tmp_path / "lexicon")
    writers.write_lexicon_json(built.repartition(3), path)
    assert json.loads("\n".join(lines_of(path))) == {"gak": "tidak", 'a "b"': "x, y"}
    assert list(json.loads("\n".join(lines_of(path)))) == ['a "b"', "gak"]
    single = tmp_path / "lexicon.json"
    single.write_text("\n".join(lines_of(path)))
    assert {r.slang: r.formal for r in readers.read_lexicon_json(spark, str(single)).collect()} == {
        "gak": "tidak", 'a "b"': "x, y",
    }
    writers.write_lexicon_json(built.where("false"), path + "_none")
    assert json.loads("\n".join(lines_of(path + "_none"))) == {}


@pytest.fixture
def translations(spark):
    rows = [("o/a", "mono_sea", i, f"s{i}", f"h{i}") for i in range(4)] + [("o:b", "mono_me", 9, "s", None)]
    frame = spark.createDataFrame(rows, "model string, dataset string, row_id bigint, source string, hypothesis string")
    return frame


def test_store_prunes_runs(spark, translations, tmp_path, plan_of):
    path = str(tmp_path / "store")
    writers.publish_translations(translations, path, "run1")
    writers.publish_translations(translations.where("model = 'o/a'"), path, "run2")
    assert writers.read_published(spark, path).count() == 9
    one = writers.read_published(spark, path, "run2", "o/a")
    assert one.count() == 4 and "PartitionFilters: [isnotnull(run_id" in plan_of(one)
    writers.write_translations(translations, str(tmp_path / "t"))
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"model_slug=o_a", "model_slug=o_b"}


def test_run_metadata_record(spark, tmp_path):
    totals = spark.createDataFrame([("o/a", "mono_sea", 5, 1, 2.0, 2.5)],
                                   "model string, dataset string, n_rows long, n_errors long, elapsed_seconds double, req_per_s double")
    record = writers.run_metadata(totals, num_shots=0, concurrency=32, model_revision=None)
    writers.write_run_metadata(record, str(tmp_path / "meta"))
    written = json.loads(lines_of(tmp_path / "meta")[0])
    assert written["n_rows"] == 5 and written["model_revision"] is None and written["timestamp"]


@pytest.fixture
def scored(spark):
    rows = [(i, "o/a" if i % 2 else "o/b", "mono_sea", "id" if i % 3 else None, f"s\n{i}", "h" * 600, None, float(i % 2),
             i / 40) for i in range(40)]
    return spark.createDataFrame(
        rows, "row_id bigint, model string, dataset string, language string, source string, hypothesis string, "
        "reference string, ifeval double, comet_qe double"
    ).repartition(4)


def test_summary_files(spark, scored, tmp_path):
    meta = spark.createDataFrame([("o/a", "mono_sea", 20, 0, 2.0, 10.0)],
                                 "model string, dataset string, n_rows long, n_errors long, elapsed_seconds double, req_per_s double")
    path = str(tmp_path / "s")
    summary.write_summary(scored, meta, path, results_dir="runs")
    bundle = json.loads("\n".join(lines_of(f"{path}/summary_json")))
    assert list(bundle) == ["meta", "overall", "by_language", "examples"]
    assert bundle["meta"]["joint_threshold"] == 0.8 and bundle["meta"]["results_dir"] == "runs"
    assert [r["model"] for r in bundle["overall"]] == ["o/a", "o/b"] and bundle["overall"][1]["n_errors"] is None
    assert len(bundle["by_language"]) == 4
    of_a = [r for r in bundle["examples"] if r["model"] == "o/a"]
    assert [r["category"] for r in of_a] == ["best"] * 5 + ["worst"] * 5
    assert [r["comet_qe"] for r in of_a[:5]] == sorted((r["comet_qe"] for r in of_a[:5]), reverse=True)
    assert all(len(r["hypothesis"]) == 500 for r in bundle["examples"])
    back = readers.read_csv_files(spark, readers.files_matching(spark, f"{path}/summary_overall", "*.csv"))
    assert [r.model for r in back.orderBy("row_id").collect()] == ["o/a", "o/b"]
    examples = readers.read_csv_files(spark, readers.files_matching(spark, f"{path}/summary_examples", "*.csv"))
    assert examples.count() == len(bundle["examples"]) and examples.columns[:9] == sc.SUMMARY_EXAMPLE.fieldNames()
    with pytest.raises(ValueError):
        summary.write_summary(scored.where("false"), meta, path)


def test_track_files_keep_the_row(spark, tmp_path):
    texts = ["gak gak yg ya no", "satu dua tiga empat lima", "gak dua tiga empat lima", "pendek"]
    body = [json.dumps({"text": x, "lang_codes": "id", "note": "é", "id2": i}, ensure_ascii=False) for i, x in enumerate(texts)]
    (tmp_path / "in.jsonl").write_text("\n".join(body), "utf-8")
    lexicon = spark.createDataFrame([("gak", ""), ("yg", "")], "slang string, formal string")
    rows = with_density(readers.read_json_lines(spark, str(tmp_path / "in.jsonl")), lexicon, "text")
    writers.write_tracks(split_tracks(rows, 1, "id"), str(tmp_path / "out"), "slang", "formal")
    assert lines_of(tmp_path / "out" / "slang") == [body[0]]
    assert lines_of(tmp_path / "out" / "formal") == [body[2], body[1]]
    writers.write_json_lines(rows.drop("raw").select("id2", "text", "row_id"), str(tmp_path / "plain"))
    assert json.loads(lines_of(tmp_path / "plain")[3]) == {"id2": "3", "text": "pendek"}


def test_enriched_write_and_dry_run(spark, translations, tmp_path):
    path = str(tmp_path / "e")
    assert not writers.write_enriched(translations, True, path, dry_run=True)
    assert not writers.write_enriched(translations, False, path) and not Path(path).exists()
    assert writers.write_enriched(translations, True, path) and spark.read.parquet(path).count() == 5


def test_catalogue(spark, corpus, tmp_path):
    for folder in ("results_x", "sub/.git", "sub/deep"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "c.jsonl").write_text(json.dumps(ROW) + "\n\n")
    described = readers.read_descriptions(spark, {"mono_sea": "Sea set"})
    got = {r.path.removeprefix(corpus): r for r in readers.corpus_catalogue(spark, corpus, described, True).collect()}
    assert set(got) == {"/mono_sea.jsonl", "/mono_me.jsonl", "/sub/deep/c.jsonl"}
    assert got["/mono_sea.jsonl"].description == "Sea set" and got["/mono_sea.jsonl"].n_rows == 7
    assert got["/sub/deep/c.jsonl"].description.startswith("Registered ") and got["/sub/deep/c.jsonl"].n_rows == 1
    assert got["/mono_me.jsonl"].size_mb > 0
    assert "n_rows" not in readers.corpus_catalogue(spark, corpus, described).columns


def test_normalise(spark):
    frame = spark.createDataFrame([("1", "x", float("nan"))], "ifeval string, other string, comet double")
    row = sc.normalise(frame, sc.SCORES).first()
    assert (row.ifeval, row.comet, row.comet_qe, row.other) == (1.0, None, None, "x")
    assert sc.nan_to_null(frame).select(F.col("comet")).first()[0] is None


def test_headers_take_one_job(spark, tmp_path):
    headers = ["model,source,comet_qe", "source,model", '"comet_qe","model","no,te",source']
    rows = ["o/a,s{i},0.5", "s{i},o/a", '0.25,o/a,n,s{i}']
    for i in range(300):
        (tmp_path / f"f {i}_mono_me_scored.csv").write_text(f"{headers[i % 3]}\n{rows[i % 3].format(i=i)}\n" + ("" if i % 5 else "\n"))
    (tmp_path / "empty_scored.csv").write_text("")
    (tmp_path / "long_scored.csv").write_text('model,"so\nurce"\no/b,"x"\n')
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        paths = readers.files_matching(spark, str(tmp_path), "*_scored.csv")
        groups = readers.files_by_header(spark, paths)
        tracker = spark.sparkContext.statusTracker()
        # Spark lists many paths by a job and runs the parts of an adaptive plan as jobs: a handful, not one a file.
        assert len(tracker.getJobIdsForGroup("headers")) <= 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {len(members) for members in groups.values()} == {100, 1}
    assert len(groups[()]) == 1 and ("model", "so\nurce") in groups and ("comet_qe", "model", "no,te", "source") in groups
    read = readers.read_csv_files(spark, paths)
    assert read.where("model = 'o/a'").count() == 300 and {r.source for r in read.where("model = 'o/a'").collect()} == {f"s{i}" for i in range(300)}


def test_ids_differ_over_folders_with_files_of_one_name(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.jsonl").write_text("\n".join(json.dumps({"text": f"{folder}{i}"}) for i in range(10)))
    rows = readers.read_eval_datasets(spark, {n: str(tmp_path / n) for n in ("x", "y")}, ["x", "y"])
    assert rows.select("row_id").distinct().count() == 20


def test_catalogue_reads_changed_files_only(spark, tmp_path, plan_of):
    root = tmp_path / "root"
    for folder, name, n in (("a", "one", 3), ("b c", "two", 5), ("hf_cache", "three", 7), ("results_1", "four", 9)):
        (root / folder).mkdir(parents=True)
        (root / folder / f"{name}.jsonl").write_text("{}\n" * n + "\n")
    (root / "a" / "none.jsonl").write_text("\n")
    described = spark.createDataFrame([("one", "first")], "stem string, description string")

    def counts():
        found = readers.corpus_catalogue(spark, str(root), described, True, str(tmp_path / "cache")).collect()
        kept = spark.read.parquet(str(tmp_path / "cache")).count()
        return {r.stem: r.n_rows for r in found}, kept

    assert counts() == ({"one": 3, "two": 5, "none": 0}, 3)
    assert counts() == ({"one": 3, "two": 5, "none": 0}, 3)
    (root / "a" / "one.jsonl").write_text("{}\n" * 4)
    assert counts() == ({"one": 4, "two": 5, "none": 0}, 4)
    plain = readers.corpus_catalogue(spark, str(root), described, True)
    assert {r.stem: (r.n_rows, r.description == "first") for r in plain.collect()} == {"one": (4, True), "two": (5, False), "none": (0, False)}


def test_lexicon_of_several_parts(spark, tmp_path):
    """A lexicon spread over part files is read without being told how, one in a single file too."""
    pairs = {f"wort{i:03}": f'a "{i}", {{}}' for i in range(60)}
    built = spark.createDataFrame(list(pairs.items()), "slang string, formal string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_lexicon_json(built, str(tmp_path / "parts"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "parts").glob("part-*"))
    assert len(parts) > 1
    assert {r.slang: r.formal for r in readers.read_lexicon_json(spark, str(tmp_path / "parts")).collect()} == pairs
    (tmp_path / "one.json").write_text("".join(p.read_text() for p in parts))
    assert {r.slang: r.formal for r in readers.read_lexicon_json(spark, str(tmp_path / "one.json")).collect()} == pairs
