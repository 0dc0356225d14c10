"""Caller-supplied models as distributed batch jobs.

A model comes as a factory: a picklable function that loads it and returns a callable. A factory with a parameter gets
the settings of the job. Each Python worker calls the factory once, when the first batch arrives. Only the texts a
model needs go to Python; every other column of the row stays in the JVM. With an answer table, a job that is started
again asks only what is not answered yet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.functions import text as t
from verbascope.functions.scores import throughput
from verbascope.operators.answers import AnswerTable, Question, by_batch, one_by_one
from verbascope.operators.filters import drop_missing, missing_text
from verbascope.operators.joins import null_safe_join
from verbascope.operators.models import ModelFactory, load, loaded
from verbascope.schema import TRANSLATION

# Defaults of the jobs.
IN_FLIGHT = 32
TEMPERATURE = 0.0
MAX_TOKENS = 1024
CLEAN_BATCH = 32
QUALITY_BATCH = 16
# The cleanliness judge is a zero-shot classifier over these labels with this hypothesis.
CLEAN_LABELS = ("clean", "polluted")
CLEAN_HYPOTHESIS = (
    "This translation output is {} — it contains only the translation with no preamble, postamble, or explanation."
)
METRICS = ("ifeval", "qe", "ref")
DEFAULT_METRICS = ("ifeval", "qe")

# What the factories get: how to decode, and how the classifier is to judge.
DECODING = {"temperature": TEMPERATURE, "max_tokens": MAX_TOKENS}
JUDGING = {"labels": list(CLEAN_LABELS), "hypothesis": CLEAN_HYPOTHESIS}


def translate_prompts(
    factory: ModelFactory, in_flight: int = IN_FLIGHT, settings: Mapping[str, object] = DECODING
) -> Callable[[Column], Column]:
    """Column function prompt -> struct(answer, error); a failing request is that row's error only."""

    job = uuid4().hex

    @F.pandas_udf("answer string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=in_flight) as pool:
            for prompts in batches:
                ask = loaded(job, factory, settings)

                def attempt(prompt: str) -> tuple[str | None, str | None]:
                    try:
                        return ask(prompt), None
                    except Exception as problem:  # noqa: BLE001 - recorded on the row
                        return None, str(problem)

                yield pd.DataFrame(list(pool.map(attempt, prompts)), columns=["answer", "error"], dtype="object")

    return run.asNondeterministic()


def translate(
    rows: DataFrame,
    model: str,
    factory: ModelFactory,
    in_flight: int = IN_FLIGHT,
    partitions: int | None = None,
    keep: Sequence[str] = ("row_id", "dataset"),
    settings: Mapping[str, object] = DECODING,
    answers: AnswerTable | None = None,
    revision: str | None = None,
) -> DataFrame:
    """Translate every row with a ``prompt``; requests at once = tasks running x ``in_flight``.

    Without ``answers`` write the result before reading it twice: a recomputed partition would ask the model again.
    With it every distinct prompt is asked once, in this job or an earlier one of the same model, revision and settings.
    """
    if partitions:
        rows = rows.repartition(partitions, "row_id")
    if answers is None:
        out = rows.withColumn("__out", translate_prompts(factory, in_flight, settings)(F.col("prompt")))
    else:
        question = Question(model, "translate", settings, revision)
        ask = one_by_one(factory, settings, in_flight)
        answers.ask(rows, question, [F.col("prompt")], ask)
        out = answers.attach(rows, question, [F.col("prompt")], "__out")
    failed = F.col("__out.error").isNotNull()
    return out.select(
        F.lit(model).alias("model"),
        "id1",
        "id2",
        "lang_codes",
        F.col("lang_codes").alias("language"),
        F.col("text").alias("source"),
        F.when(~failed, t.strip(t.text_or_empty(F.col("__out.answer")))).alias("hypothesis"),
        F.col("translation").alias("reference"),
        F.col("__out.error").alias("error"),
        *[c for c in keep if c in rows.columns],
    )


def translation_columns(rows: DataFrame, model: str, hypothesis: Column, error: Column) -> DataFrame:
    """The nine columns of a translation table from evaluation rows."""
    return rows.select(
        F.lit(model).alias("model"),
        "id1",
        "id2",
        "lang_codes",
        F.col("lang_codes").alias("language"),
        F.col("text").alias("source"),
        hypothesis.alias("hypothesis"),
        F.col("translation").alias("reference"),
        error.alias("error"),
    ).select(*TRANSLATION.fieldNames())


def _scorer(factory: ModelFactory, batch: int, settings: Mapping[str, object] | None = None) -> Callable[..., Column]:
    """Column function texts -> score; rows whose first text is null get 0.0 and never reach the model."""

    job = uuid4().hex

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for given in batches:
            columns = given if isinstance(given, tuple) else (given,)
            scores = pd.Series(0.0, index=columns[0].index)
            asked = columns[0].notna().to_numpy().nonzero()[0]
            for start in range(0, len(asked), batch):
                part = asked[start : start + batch]
                scores.iloc[part] = loaded(job, factory, settings or {})(*[c.iloc[part].tolist() for c in columns])
            yield scores

    return run.asNondeterministic()


def resolve_metrics(wanted: Sequence[str] | str | None = None) -> list[str]:
    """Requested metrics in standard order; unknown or no names are an error, none given means the default."""
    if wanted is None or (isinstance(wanted, str) and not wanted.strip()):
        return list(DEFAULT_METRICS)
    names = set(t.comma_list(wanted, lower=True)) if isinstance(wanted, str) else set(wanted)
    unknown = names - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}; valid: {sorted(METRICS)}")
    if not names:
        raise ValueError("no metrics requested")
    return [m for m in METRICS if m in names]


def score(
    df: DataFrame,
    scorers: dict[str, ModelFactory],
    metrics: Sequence[str] | str | None = None,
    batches: dict[str, int] | None = None,
    settings: Mapping[str, Mapping[str, object]] | None = None,
    answers: AnswerTable | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the requested score columns to every row with a hypothesis; rows without one are dropped.

    ``ifeval`` sees the hypothesis and answers one of its labels, of which the first is clean; ``qe`` scores source and
    hypothesis, ``ref`` also the reference. Missing texts are empty to the model. ``settings`` of a metric go to its
    factory; the judge's are :data:`JUDGING`. With ``answers`` the scorers that ``names`` identifies score equal texts
    once, in this job or an earlier one; those without a name score every row.
    """
    batches = {"ifeval": CLEAN_BATCH, "qe": QUALITY_BATCH, "ref": QUALITY_BATCH, **(batches or {})}
    source, hypothesis, reference = (t.text_or_empty(F.col(c)) for c in ("source", "hypothesis", "reference"))
    inputs = {
        "ifeval": ("ifeval", [F.nullif(t.strip(hypothesis), F.lit(""))]),
        "qe": ("comet_qe", [source, hypothesis]),
        "ref": ("comet", [source, hypothesis, reference]),
    }
    chosen = resolve_metrics(metrics)
    lacking = [m for m in chosen if m not in scorers]
    if lacking:
        raise ValueError(f"no scorer given for {lacking}")
    rows, added = drop_missing(df), {}
    for metric in chosen:
        name, columns = inputs[metric]
        given = {"ifeval": JUDGING, **(settings or {})}.get(metric, {})
        factory = clean_scorer(scorers[metric]) if metric == "ifeval" else scorers[metric]
        if answers is None or metric not in (names or {}):
            added[name] = _scorer(factory, batches[metric], given)(*columns)
        else:
            question = Question(names[metric], metric, given)
            answers.ask(drop_missing(df), question, columns, by_batch(factory, given, batches[metric]))
            rows = answers.attach(rows, question, columns, "__found")
            rows = rows.withColumn(name, F.coalesce("__found.score", F.lit(0.0))).drop("__found")
    return rows.withColumns(added)


def clean_scorer(classifier: ModelFactory) -> ModelFactory:
    """Turn a factory of label lists into one of scores: 1.0 for the first of the labels it was given, else 0.0."""

    def load_judge(settings: dict) -> Callable[[list[str]], list[float]]:
        classify = load(classifier, settings)
        clean = settings.get("labels", CLEAN_LABELS)[0]
        return lambda texts: [1.0 if label == clean else 0.0 for label in classify(texts)]

    return load_judge


def pair_scores(df: DataFrame, factory: ModelFactory, name: str, columns: Sequence[str], batch: int = QUALITY_BATCH) -> DataFrame:
    """Any further scorer over text columns, such as an embedding similarity or an overlap measure."""
    return df.withColumn(name, _scorer(factory, batch)(*[t.text_or_empty(F.col(c)) for c in columns]))


def run_totals(
    translations: DataFrame, elapsed: DataFrame, keys: Sequence[str] = ("model", "dataset")
) -> DataFrame:
    """Rows, errors, elapsed seconds and throughput of each run; ``elapsed`` has one row per run."""
    counts = translations.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~missing_text(F.col("error"))).alias("n_errors")
    )
    timed = null_safe_join(counts, elapsed.select(*keys, "elapsed_seconds"), keys, "left")
    return timed.withColumn("req_per_s", throughput(F.col("n_rows"), F.col("elapsed_seconds")))
