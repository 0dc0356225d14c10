"""Whole jobs from files to files, one per step of an evaluation."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope.functions import text as t
from verbascope.functions.scores import throughput
from verbascope.operators import inference, lexicon, metrics, prompts
from verbascope.operators.answers import AnswerTable
from verbascope.operators.exemplars import worst_rows
from verbascope.operators.histograms import histogram
from verbascope.operators.inference import ModelFactory
from verbascope.plans import summary
from verbascope.session import scratch, ship_package, stable_copy, stable_table
from verbascope.sources import readers, writers
from verbascope.sources.store import SCORED, TRANSLATED, RunStore

HISTOGRAM_BINS = 20


@dataclass
class RunLog:
    """What became of each model: the folders written, or why it failed."""

    done: dict[str, list[str]] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


def translate_corpora(
    spark: SparkSession,
    corpora: Sequence[str],
    models: Mapping[str, ModelFactory],
    out: str,
    run_id: str,
    max_rows: int | None = None,
    shots: int = 0,
    in_flight: int = inference.IN_FLIGHT,
    partitions: int | None = None,
    revisions: Mapping[str, str] | None = None,
    replace: bool = False,
    decoding: Mapping[str, object] = inference.DECODING,
    resume: bool = True,
    profile: ResourceProfile | None = None,
) -> RunLog:
    """Translate every corpus with every model into the run store ``out``, with a record for each of them.

    ``decoding`` goes to every model's factory. With ``resume`` answers are kept below ``out/answers``: a job that was
    stopped, or a run that shares prompts with an earlier one, asks a model of the same revision and decoding only what
    is not answered yet. ``profile`` gives the asking stages executors of their own. A run that is repeated takes the
    place of its earlier self; one that means other settings under the same id is refused before it asks anything,
    unless ``replace``. A model that fails is noted and the others go on.
    """
    ship_package(spark)
    log = RunLog()
    store = RunStore(spark, out)
    answers = AnswerTable(spark, f"{out}/answers", profile=profile) if resume else None
    for model, factory in models.items():
        try:
            for corpus in corpora:
                dataset, revision = t.file_stem_of(corpus), (revisions or {}).get(model)
                settings = {"corpus": corpus, "max_rows": max_rows, "shots": shots, "revision": revision, **decoding}
                store.refuse_conflicts(TRANSLATED, run_id, settings, [(model, dataset)], replace)
                facts = _facts(eval_path=corpus, csv_path=f"{out}/{TRANSLATED}", num_shots=shots, concurrency=in_flight, model_revision=revision)
                with scratch(spark):
                    rows = readers.read_json_lines(spark, corpus, max_rows)
                    if shots:
                        # Examples are taken out by row id, so both readings must see the same ids.
                        rows = stable_table(rows)
                    translated = inference.translate(
                        prompts.with_prompts(rows, shots), model, factory, in_flight, partitions, settings=decoding, answers=answers, revision=revision
                    )
                    store.write(TRANSLATED, translated, run_id, settings, [(model, dataset)], facts, replace)
                log.done.setdefault(model, []).append(f"{run_id}/{dataset}")
        except Exception as problem:  # noqa: BLE001 - one model's failure must not stop the others
            log.failed[model] = str(problem)
    return log


def _facts(**constants) -> Callable[[DataFrame], DataFrame]:
    """Columns of a record that are known when its rows are written: ``constants``, time spent since now, and speed."""
    start = time.perf_counter()

    def add(records: DataFrame) -> DataFrame:
        spent = F.round(F.lit(time.perf_counter() - start), 3)
        known = records.withColumns({**{name: F.lit(value) for name, value in constants.items()}, "elapsed_seconds": spent})
        return known.withColumn("req_per_s", throughput(F.col("n_rows"), F.col("elapsed_seconds")))

    return add


def read_runs(spark: SparkSession, out: str, run_id: str) -> DataFrame:
    """All translations of one run."""
    return RunStore(spark, out).read(TRANSLATED, run_id)


def score_translations(
    translations: DataFrame,
    scorers: Mapping[str, ModelFactory],
    path: str,
    metrics: Sequence[str] | str | None = None,
) -> None:
    """Score all translations that have a hypothesis and write them, one folder per model and dataset."""
    ship_package(translations.sparkSession)
    writers.write_scored(inference.score(translations, dict(scorers), metrics), path)


def score_run(
    spark: SparkSession,
    out: str,
    run_id: str,
    scorers: Mapping[str, ModelFactory],
    wanted: Sequence[str] | str | None = None,
    scored_as: str | None = None,
    replace: bool = False,
    names: Mapping[str, str] | None = None,
    judging: Mapping[str, object] = inference.JUDGING,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Score the stored translations of a run and return the records of the scores.

    Nothing is translated again. ``judging`` goes to the factory of the classifier. Scores of scorers that ``names``
    identifies are kept below ``out/answers``, so that a job that was stopped scores only what is left. ``scored_as`` keeps the scores under a run id of their own, beside those of other
    scorers of the same translations.
    """
    ship_package(spark)
    store = RunStore(spark, out)
    chosen = inference.resolve_metrics(wanted)
    translated = store.records(TRANSLATED, run_id).select("model", "dataset", "version").collect()
    if not translated:
        raise FileNotFoundError(f"no translations of run {run_id!r} in {out}")
    keys = [(r["model"], r["dataset"]) for r in translated]
    settings = {"translations": run_id, "metrics": chosen, "names": dict(names or {}), "judging": dict(judging)}
    store.refuse_conflicts(SCORED, scored_as or run_id, settings, keys, replace)
    facts, answers = _facts(), AnswerTable(spark, f"{out}/answers", profile=profile)
    given = {"ifeval": judging}
    scored = inference.score(store.read(TRANSLATED, run_id), dict(scorers), chosen, settings=given, answers=answers, names=names)
    return store.write(SCORED, scored, scored_as or run_id, settings, keys, facts, replace)


def summarise_run(spark: SparkSession, out: str, run_id: str, path: str, threshold: float, scored_as: str | None = None) -> None:
    """Summary tables and bundle of a stored run: its scores, and the rows, errors and speed of its translations."""
    store = RunStore(spark, out)
    with scratch(spark):
        scored = store.read(SCORED, scored_as or run_id)
        summary.write_summary(scored, store.records(TRANSLATED, run_id), path, threshold, out)


def report_run(spark: SparkSession, out: str, run_id: str, path: str, worst: int = 20) -> None:
    """Tables of a stored run after scoring: quality, cleanliness and reference summaries, histogram, worst rows.

    Tables of scores that the run does not have are left out.
    """
    with scratch(spark):
        scored = stable_table(RunStore(spark, out).read(SCORED, run_id))
        tables = {"score_averages": metrics.score_averages(scored)}
        if "comet_qe" in scored.columns:
            tables["qe_summary"] = metrics.quality_summary(scored)
            tables["qe_by_lang"] = metrics.quality_by_language(scored)
            tables["score_histogram"] = histogram(scored, ["model", "dataset"], F.col("comet_qe"), HISTOGRAM_BINS, 0.0, 1.0)
        if "ifeval" in scored.columns:
            tables["ifeval_summary"] = metrics.cleanliness_summary(scored)
        if "comet" in scored.columns:
            tables["ref_summary"] = metrics.reference_summary(scored)
        for name, table in tables.items():
            writers.write_csv(table, f"{path}/{name}")
        if "comet_qe" in scored.columns:
            writers.write_csv(worst_rows(scored, n=worst), f"{path}/worst_rows")


def summarise_folder(spark: SparkSession, folder: str, out: str, threshold: float) -> None:
    """Summary tables and bundle of the scored CSV files and metadata of a folder."""
    with scratch(spark):
        scored = stable_table(readers.read_scored_by_name(spark, folder))
        meta = readers.read_run_meta(spark, folder)
        named = meta.withColumn("model", t.model_from_slug(F.col("model_slug")))
        summary.write_summary(scored, named, out, threshold, folder)


@dataclass
class EnrichLog:
    """What became of the files of a folder; true if anything was written."""

    files: int = 0
    rows: int = 0
    skipped: int = 0

    def __bool__(self) -> bool:
        return self.files > 0


def enrich_folder(
    spark: SparkSession,
    folder: str,
    lexicon_path: str,
    out: str,
    pattern: str = "*_scored.csv",
    text: str = "source",
    overwrite: bool = False,
    dry_run: bool = False,
) -> EnrichLog:
    """Add density columns to the scored files of a folder and say how many files and rows were written.

    Each file is judged by its own header: those that have the columns already are skipped, unless ``overwrite``.
    A file without the text column is an error. Files need no model column.
    """
    groups = readers.files_by_header(spark, readers.files_matching(spark, folder, pattern))
    wanted = {h: paths for h, paths in groups.items() if overwrite or not set(lexicon.ENRICHED) <= set(h)}
    lacking = [path for header, paths in wanted.items() if text not in header for path in paths]
    if lacking:
        raise ValueError(f"no column {text!r} in {lacking}")
    chosen = sorted(path for paths in wanted.values() for path in paths)
    skipped = sum(map(len, groups.values())) - len(chosen)
    if not chosen or dry_run:
        return EnrichLog(skipped=skipped)
    # Density takes the place of columns that only some of the files have.
    with scratch(spark):
        rows = readers.read_csv_files(spark, chosen)
        enriched, changed = lexicon.enrich(rows, readers.read_lexicon_json(spark, lexicon_path), text, True)
        dated = stable_table(enriched.withColumn("dataset", t.dataset_of_scored_name(F.col("file_name"))))
        writers.write_enriched(dated, changed, out)
        return EnrichLog(len(chosen), dated.count(), skipped)


def split_corpus(
    spark: SparkSession,
    corpus: str,
    lexicon_path: str,
    out: str,
    lang: str = "id",
    n_slang: int = lexicon.N_SLANG,
    min_tokens: int = lexicon.MIN_TOKENS,
    slang_name: str | None = None,
    formal_name: str | None = None,
) -> DataFrame:
    """Write the slang and formal tracks of a corpus as JSON lines; returns the report on the slang track."""
    stem = t.file_stem_of(corpus)
    with scratch(spark):
        rows = readers.read_json_lines(spark, corpus).where(F.col("lang_codes") == lang)
        dense = stable_table(lexicon.with_density(rows, readers.read_lexicon_json(spark, lexicon_path), "text"))
        labelled = lexicon.split_tracks(dense, n_slang, lang, min_tokens)
        writers.write_tracks(
            labelled, out, slang_name or f"{stem}_{lang}_slang", formal_name or f"{stem}_{lang}_formal"
        )
        return stable_copy(lexicon.split_report(dense, n_slang, lang, min_tokens))


def build_lexicon_file(spark: SparkSession, source: str, path: str) -> None:
    """Reduce a raw lexicon CSV to a JSON object of slang -> formal."""
    writers.write_lexicon_json(lexicon.build_lexicon(readers.read_lexicon_csv(spark, source)), path)
