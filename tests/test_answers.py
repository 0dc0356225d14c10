"""Model jobs that are stopped and started again."""

import json
import os
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from verbascope.operators import inference
from verbascope.operators.answers import AnswerTable, Question, model_profile
from verbascope.plans import jobs
from verbascope.sources.store import RunStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def counting(folder, until=None):
    """A factory of scorers that note every text they are asked for, and break while the file ``stop`` is there."""

    def load():
        def score(texts):
            for text in texts:
                if until is not None and os.path.exists(f"{folder}/stop") and len(os.listdir(f"{folder}/calls")) >= until:
                    raise RuntimeError("stopped")
                open(f"{folder}/calls/{text}-{os.urandom(6).hex()}", "w").close()
            return [len(text) / 10 for text in texts]

        return score

    return load


def calls(folder):
    return Counter(name.partition("-")[0] for name in os.listdir(f"{folder}/calls"))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path)


def rows(spark, n=60):
    return spark.range(n).select("id", F.concat(F.lit("t"), F.col("id") % 40).alias("text"))


def scored(spark, folder, factory, frame, slice_questions=5):
    from verbascope.operators.answers import by_batch

    table, question = AnswerTable(spark, f"{folder}/answers", slice_questions), Question("m", "length")
    table.ask(frame, question, [F.col("text")], by_batch(factory, {}, 1))
    return table.attach(frame, question, [F.col("text")])


def test_nothing_answered_is_asked_again(spark, folder):
    Path(f"{folder}/stop").touch()
    with pytest.raises(Exception, match="stopped"):
        scored(spark, folder, counting(folder, until=20), rows(spark).coalesce(1))
    first = calls(folder)
    assert 0 < len(first) < 40
    os.remove(f"{folder}/stop")
    found = scored(spark, folder, counting(folder), rows(spark)).collect()
    assert len(found) == 60 and all(r.answer.score == len(r.text) / 10 for r in found)
    kept = {r.key for r in AnswerTable(spark, f"{folder}/answers").raw(Question("m", "length")).collect()}
    assert len(kept) == 40
    # Only the slice that broke is asked again, and no slice that ended.
    again = [text for text, n in calls(folder).items() if n > 1]
    assert set(calls(folder)) == {f"t{i}" for i in range(40)} and len(again) < 20 and set(again) <= set(first)
    before = calls(folder)
    scored(spark, folder, counting(folder), rows(spark, 100)).collect()
    assert calls(folder) == before


def test_questions_are_told_apart(spark, folder):
    from verbascope.operators.answers import by_batch

    table, frame = AnswerTable(spark, f"{folder}/answers"), rows(spark, 3)
    for question, factor in ((Question("m", "a"), 1.0), (Question("m", "b"), 2.0), (Question("m", "a", {"x": 1}), 3.0), (Question("m", "a", {}, "rev"), 4.0)):
        table.ask(frame, question, [F.col("text")], by_batch(lambda factor=factor: lambda texts: [factor] * len(texts), {}, 8))
        assert {r.answer.score for r in table.attach(frame, question, [F.col("text")]).collect()} == {factor}


def test_null_and_empty_texts(spark, folder):
    frame = spark.createDataFrame([(1, None, "a"), (2, "", None), (3, "", ""), (4, "x", "y"), (4, "x", "y")], "id int, a string, b string")
    from verbascope.operators.answers import by_batch

    table, question, texts = AnswerTable(spark, f"{folder}/answers"), Question("m", "pair"), [F.col("a"), F.col("b")]
    table.ask(frame, question, texts, by_batch(lambda: lambda a, b: [0.0 if y is None else 1.0 + len(y) for y in b], {}, 2))
    found = sorted((r.id, r.answer and r.answer.score) for r in table.attach(frame, question, texts).collect())
    assert found == [(1, None), (2, 0.0), (3, 1.0), (4, 2.0), (4, 2.0)]
    assert table.raw(question).count() == 3
    empty = frame.where("false")
    table.ask(empty, question, texts, by_batch(lambda: lambda a, b: [], {}, 2))
    assert table.attach(empty, question, texts).collect() == []


def test_errors_are_asked_again(spark, folder):
    def flaky(settings):
        def answer(prompt):
            if settings["fail"] and prompt.endswith("1"):
                raise ValueError("busy")
            return prompt.upper()

        return answer

    from verbascope.operators.answers import one_by_one

    table, frame, question = AnswerTable(spark, f"{folder}/answers"), rows(spark, 4), Question("m", "t")
    texts = [F.col("text")]
    read = lambda: {r.text: (r.answer.answer, r.answer.error) for r in table.attach(frame, question, texts).collect()}
    table.ask(frame, question, texts, one_by_one(flaky, {"fail": True}, 4))
    assert read() == {"t0": ("T0", None), "t1": (None, "busy"), "t2": ("T2", None), "t3": ("T3", None)}
    table.ask(frame, question, texts, one_by_one(flaky, {"fail": False}, 4), retry_errors=False)
    assert read()["t1"] == (None, "busy")
    table.ask(frame, question, texts, one_by_one(flaky, {"fail": False}, 4))
    assert read()["t1"] == ("T1", None) and table.raw(question).count() == 5


def echo_settings(settings):
    return lambda prompt: json.dumps(settings, sort_keys=True)


def test_settings_reach_the_models(spark, tmp_path):
    corpus = tmp_path / "mono_sea.jsonl"
    corpus.write_text("\n".join(json.dumps({"id1": "s", "id2": i, "lang_codes": "id", "text": f"text {i}"}) for i in range(5)))
    out = str(tmp_path / "out")
    for number, (resume, tokens) in enumerate([(True, 1024), (False, 7), (True, 9)]):
        log = jobs.translate_corpora(spark, [str(corpus)], {"o/a": echo_settings}, out, f"r{number}", resume=resume, decoding={"max_tokens": tokens})
        assert not log.failed
        assert {r.hypothesis for r in jobs.read_runs(spark, out, f"r{number}").collect()} == {json.dumps({"max_tokens": tokens})}
    assert json.loads(RunStore(spark, out).records("translations", "r2").first().settings)["max_tokens"] == 9
    given = spark.createDataFrame([("s", "h", "r")], "source string, hypothesis string, reference string")
    judge = lambda settings: lambda texts: [settings["labels"][0] if "{}" in settings["hypothesis"] else "no"] * len(texts)
    assert inference.score(given, {"ifeval": judge}, "ifeval").first().ifeval == 1.0
    assert inference.score(given, {"ifeval": judge}, "ifeval", settings={"ifeval": {"labels": ["a", "b"], "hypothesis": "x"}}).first().ifeval == 0.0


def noting(folder):
    def load():
        def answer(prompt):
            open(f"{folder}/calls/{prompt[-2:].strip()}-{os.urandom(6).hex()}", "w").close()
            return prompt[-3:]

        return answer

    return load


def test_a_repeated_job_asks_nothing(spark, folder):
    corpus = Path(folder) / "mono_sea.jsonl"
    lines = [json.dumps({"id1": "s", "id2": i, "lang_codes": "id", "text": f"text {i % 6}"}) for i in range(9)]
    corpus.write_text("\n".join(lines))
    for run in ("r1", "r1", "r2"):
        log = jobs.translate_corpora(spark, [str(corpus)], {"o/a": noting(folder)}, f"{folder}/out", run)
        assert not log.failed and jobs.read_runs(spark, f"{folder}/out", run).count() == 9
    assert calls(folder) == Counter({str(i): 1 for i in range(6)})
    corpus.write_text("\n".join([*lines, json.dumps({"id1": "s", "id2": 9, "lang_codes": "id", "text": "text 9"})]))
    jobs.translate_corpora(spark, [str(corpus)], {"o/a": noting(folder)}, f"{folder}/out", "r3")
    assert calls(folder) == Counter({**{str(i): 1 for i in range(6)}, "9": 1})


def test_model_profile():
    profile = model_profile(gpus=1, cpus=4, memory="8g")
    assert profile.taskResources["gpu"].amount == 1.0 and profile.taskResources["cpus"].amount == 4.0
    assert profile.executorResources["memory"].amount == 8192 and profile.executorResources["gpu"].amount == 1
