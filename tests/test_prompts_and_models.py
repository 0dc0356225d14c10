import sys
import threading

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from verbascope.operators import exemplars, inference, prompts

# Python workers cannot import test modules, so the stand-in models travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ASK = "Translate the following {}text to English. Output only the translation, nothing else."


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (0, "a", "ar,id", "t0", "r0"), (1, "a", None, "t1", None), (2, "a", "", None, "r2"), (3, "a", "id", "t3\nx", "r3"),
        (4, "b", "th", "t4", "r4"), (5, "b", "th", "t5", "r5"), (6, "b", None, "t6", "r6"),
    ]
    frame = spark.createDataFrame(data, "row_id bigint, dataset string, lang_codes string, text string, translation string")
    return frame.withColumns({"id1": F.lit("s"), "id2": F.col("row_id").cast("string")}).repartition(3).cache()


def prompt_of(frame):
    return {r.row_id: r.prompt for r in frame.collect()}


def test_zero_shot(rows):
    got = prompt_of(prompts.with_prompts(rows))
    assert got[0] == ASK.format("ar,id ") + "\n\nt0"
    assert got[1] == ASK.format("") + "\n\nt1"
    assert got[2] == ASK.format("") + "\n\n"


def few(examples, lang, text):
    lines = ["The following are example translations:"]
    for language, source, reference in examples:
        lines += [f"Source ({language or 'Unknown'}): {source}", f"Translation: {reference}", ""]
    lines += [ASK.format(f"{lang} " if lang else ""), f"Source ({lang or 'Unknown'}): {text}", "Translation:"]
    return "\n".join(lines)


@pytest.mark.parametrize("small", [True, False])
def test_few_shot(rows, monkeypatch, small):
    if not small:
        original = prompts.small_side
        monkeypatch.setattr(prompts, "small_side", lambda frame: original(frame, limit=0))
    got = prompt_of(prompts.with_prompts(rows, 2))
    assert set(got) == {2, 3, 6}
    assert got[3] == few([("ar,id", "t0", "r0"), (None, "t1", "")], "id", "t3\nx")
    assert got[2] == few([("ar,id", "t0", "r0"), (None, "t1", "")], "", "")
    assert got[6] == few([("th", "t4", "r4"), ("th", "t5", "r5")], None, "t6")


def test_too_many_examples(rows):
    with pytest.raises(ValueError, match="3 examples"):
        prompts.split_examples(rows, 3)
    examples, inputs = prompts.split_examples(rows, 0)
    assert examples.count() == 0 and inputs.count() == 7


def echo():
    def answer(prompt):
        if "t4" in prompt:
            raise RuntimeError("no answer")
        return None if "t5" in prompt else f"　{prompt[-2:]} \n"

    return answer


def test_translate_keeps_errors_on_their_row(rows):
    out = inference.translate(prompts.with_prompts(rows), "org/m", echo, partitions=2).collect()
    got = {r.row_id: (r.hypothesis, r.error) for r in out}
    assert got[4] == (None, "no answer") and got[5] == ("", None) and got[0] == ("t0", None)
    assert all(r.model == "org/m" and r.language == r.lang_codes for r in out) and len(out) == 7


def test_translate_runs_requests_together(spark, rows):
    def slow():
        gate = threading.Barrier(4, timeout=20)

        def answer(prompt):
            gate.wait()
            return "done"

        return answer

    four = prompts.with_prompts(rows.where("row_id < 4").coalesce(1))
    out = inference.translate(four, "m", slow, in_flight=4).collect()
    assert [r.hypothesis for r in out] == ["done"] * 4


def test_model_loads_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def loads():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4()}", "w").close()
        return lambda sources, outputs: [float(len(o)) for o in outputs]

    frame = spark.range(0, 400, numPartitions=12).select(
        "id", F.lit("s").alias("source"), F.repeat(F.lit("x"), (F.col("id") % 7 + 1).cast("int")).alias("hypothesis"),
        F.lit(None).cast("string").alias("reference"),
    )
    got = inference.score(frame, {"qe": loads}, "qe").collect()
    assert all(r.comet_qe == r.id % 7 + 1 for r in got) and len(got) == 400
    workers = [name.name.split("-")[0] for name in tmp_path.iterdir()]
    assert len(workers) == len(set(workers))


def judge():
    def classify(texts):
        assert all(text.strip() == text and text for text in texts) and len(texts) <= 3
        return ["polluted" if text.startswith("Sure") else "clean" for text in texts]

    return classify


def test_scoring(spark):
    data = [(0, "s", "ok", "r"), (1, "s", "Sure, here", None), (2, None, " 　", "r"), (3, "s", None, "r"), (4, "s", "", "r"),
            (5, "s", " fine ", "r")]
    frame = spark.createDataFrame(data, "row_id int, source string, hypothesis string, reference string").coalesce(1)
    triple = lambda: lambda a, o, r: [len(x) * 100 + len(y) * 10 + len(z) for x, y, z in zip(a, o, r)]
    out = inference.score(frame, {"ifeval": judge, "ref": triple}, "REF, ifeval", {"ifeval": 3, "ref": 2})
    got = {r.row_id: (r.ifeval, r.comet) for r in out.collect()}
    assert got == {0: (1.0, 121.0), 1: (0.0, 200.0), 2: (0.0, 21.0), 5: (1.0, 161.0)}
    assert "comet_qe" not in out.columns
    extra = inference.pair_scores(frame, lambda: lambda a, b: [1.0 if x == y else 0.5 for x, y in zip(a, b)], "same",
                                  ["source", "reference"])
    assert [r.same for r in extra.collect()] == [0.5] * 6


def test_metric_choice():
    assert inference.resolve_metrics() == ["ifeval", "qe"] and inference.resolve_metrics(" ") == ["ifeval", "qe"]
    assert inference.resolve_metrics("ref,IFEVAL") == ["ifeval", "ref"]
    for bad in ("bleu", ","):
        with pytest.raises(ValueError):
            inference.resolve_metrics(bad)
    with pytest.raises(ValueError):
        inference.resolve_metrics([])


def test_scorer_must_be_given(spark):
    frame = spark.createDataFrame([("s", "h", "r")], "source string, hypothesis string, reference string")
    with pytest.raises(ValueError):
        inference.score(frame, {}, ["qe"])


def test_run_totals(spark):
    out = spark.createDataFrame([("m", "d", None), ("m", "d", "x"), ("m", "d", "")], "model string, dataset string, error string")
    elapsed = spark.createDataFrame([("m", "d", 2.0)], "model string, dataset string, elapsed_seconds double")
    row = inference.run_totals(out, elapsed).first()
    assert (row.n_rows, row.n_errors, row.req_per_s) == (3, 1, 1.5)
    assert inference.run_totals(out, elapsed.withColumn("elapsed_seconds", F.lit(0.0))).first().req_per_s is None


@pytest.fixture(scope="module")
def scored(spark):
    data = [(i, "m", "d", "id", f"s{i}" * 400, f"h{i}", None, f, q) for i, (f, q) in enumerate([
        (1.0, 0.9), (1.0, 0.9), (0.0, 0.9), (None, 0.1), (1.0, None), (0.0, 0.1), (1.0, 0.5), (0.0, 0.0)])]
    return spark.createDataFrame(
        data, "row_id bigint, model string, dataset string, language string, source string, hypothesis string, "
        "reference string, ifeval double, comet_qe double"
    ).repartition(3).cache()


def test_examples(scored):
    rows = exemplars.examples(scored, n=3).collect()
    shown = {c: [r.hypothesis for r in sorted(rows, key=lambda r: r.position) if r.category == c]
             for c in ("best", "worst", "polluted")}
    assert shown == {"best": ["h0", "h1", "h6"], "worst": ["h4", "h7", "h3"], "polluted": ["h7", "h3", "h5"]}
    assert all(len(r.source) == 500 and r.source.endswith("…") and r.reference == "" for r in rows)
    assert all(r.comet_qe is not None and r.ifeval is not None for r in rows)


def test_worst_rows_put_missing_scores_last(scored):
    got = exemplars.worst_rows(scored, n=8).collect()
    assert {r.row_id for r in exemplars.worst_rows(scored, n=3).collect()} == {7, 3, 5}
    assert len(got) == 8 and {r.row_id for r in exemplars.worst_rows(scored, n=7).collect()} == set(range(8)) - {4}


