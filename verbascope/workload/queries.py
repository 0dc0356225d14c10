"""Every registered query: name -> function of (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbascope import schema as sc
from verbascope.functions import scores as s
from verbascope.functions import text as t
from verbascope.operators import filters, inference, lexicon, metrics, prompts, ranking
from verbascope.operators.exemplars import examples, worst_rows
from verbascope.operators.histograms import histogram
from verbascope.operators.joins import small_side
from verbascope.operators.quantiles import box_numbers
from verbascope.plans import explore, jobs, profile, stats, summary
from verbascope.session import ensure_checkpoint_dir, remove_folder, ship_package, stable_copy
from verbascope.sources import readers, writers
from verbascope.sources.readers import with_lengths
from verbascope.sources.search import TextIndex
from verbascope.sources.store import RunStore
from verbascope.workload import views

Query = Callable[[SparkSession, str], DataFrame]

RUN = ["model", "dataset"]
KEY = list(explore.SOURCE_KEY)

# Parameters of the registered queries: each is an argument of the operator it belongs to.
SHOTS = 3
ROW_CAP = 10
FILE_CAP = 25
N_SLANG = 100
SEARCH = "Thand"
INDEXED_SEARCH = "Schach"

LENGTHS = ["text_chars", "text_words", "translation_chars"]

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def comparable(df: DataFrame, places: int = 6) -> DataFrame:
    """Round doubles, so that the order of a sum does not show."""
    return df.select(
        *[
            F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@contextmanager
def shared_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder beside the checkpoints, removed at the end; what is returned from it must have been computed."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"
    try:
        yield path
    finally:
        remove_folder(spark, path)


def dense_documents(spark: SparkSession, sf: str) -> DataFrame:
    documents = views.table(spark, sf, "documents")
    return lexicon.with_density(documents, views.lexicon(spark, sf), "text", "doc_id")


def dense_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Narrow density table, computed once: the split reads it for its cutoff and again for its labels."""
    rows = views.eval_rows(spark, sf, translation=False)
    dense = lexicon.with_density(rows, views.lexicon(spark, sf), "text")
    return stable_copy(dense.select("row_id", "lang_codes", *lexicon.ENRICHED))


def tracked_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows whose documents carry density and track; the split reads figures only, and texts are tokenised once."""
    dense = stable_copy(dense_documents(spark, sf).select(F.col("doc_id").alias("row_id"), *lexicon.ENRICHED))
    figures, _ = small_side(lexicon.split_tracks(dense, N_SLANG).withColumnRenamed("row_id", "doc_id"))
    return views.scored(spark, sf, documents=views.table(spark, sf, "documents").join(figures, "doc_id"))


# --- summaries ---------------------------------------------------------------------------------------------


@query
def summary_overall(spark, sf):
    return comparable(summary.overall(views.scored(spark, sf), views.run_meta(spark, sf)))


@query
def summary_by_language(spark, sf):
    return comparable(summary.by_language(views.scored(spark, sf)))


@query
def summary_levels(spark, sf):
    """The figures per run and per language of the run, from one reading of the scored rows."""
    overall, languages = summary.both_levels(views.scored(spark, sf), views.run_meta(spark, sf))
    figures = ["mean_ifeval", "mean_comet_qe", "median_comet_qe", "p10_comet_qe", "p90_comet_qe", "joint_pass_rate"]
    runs = overall.select(*RUN, F.lit(None).cast("string").alias("language"), F.lit("run").alias("level"), F.col("n_rows_scored").alias("n_rows"), *figures)
    return comparable(runs.unionByName(languages.select(*RUN, "language", F.lit("language").alias("level"), "n_rows", *figures)))


@query
def eda_headline(spark, sf):
    rows = filters.select_rows(views.scored(spark, sf), languages=["en", "de", "fr"], comet_qe=(0.05, 1.0))
    return comparable(metrics.headline(rows))


@query
def lang_mean(spark, sf):
    return comparable(metrics.mean_by_language(views.scored(spark, sf)))


@query
def qe_summary(spark, sf):
    return metrics.quality_summary(views.scored(spark, sf))


@query
def qe_by_lang(spark, sf):
    return metrics.quality_by_language(views.scored(spark, sf))


@query
def ifeval_summary(spark, sf):
    return metrics.cleanliness_summary(views.scored(spark, sf))


@query
def ref_summary(spark, sf):
    return metrics.reference_summary(views.scored(spark, sf))


@query
def score_averages(spark, sf):
    return comparable(metrics.score_averages(views.scored(spark, sf)))


@query
def model_stats(spark, sf):
    return comparable(metrics.model_stats(tracked_scored(spark, sf)))


@query
def slang_conditional_means(spark, sf):
    rows = tracked_scored(spark, sf).where(F.col("slang_bucket").isNotNull())
    means = rows.groupBy("model", "slang_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.avg("comet_qe").alias("mean_comet_qe")
    )
    return comparable(means)


@query
def metric_merge(spark, sf):
    rows = views.scored(spark, sf)
    outputs = [rows.where(F.col(c).isNotNull()).select("row_id", c) for c in ("ifeval", "comet_qe", "comet")]
    return metrics.merge_metrics(outputs)


@query
def metric_merge_rows(spark, sf):
    """Per-metric tables whose row ids differ, merged on what names a row, with their texts."""
    rows = views.scored(spark, sf)
    natural = [*metrics.NATURAL_KEY, "hypothesis"]
    outputs = [
        rows.where(F.col(c).isNotNull()).select(*natural, c, (F.col("row_id") * sign).alias("row_id"))
        for c, sign in (("ifeval", 1), ("comet_qe", -1), ("comet", 3))
    ]
    return metrics.merge_metrics(outputs)


@query
def metric_merge_repeats(spark, sf):
    """Per-metric tables of one reading, each lacking rows, where null and repeated ids leave the row id to tell rows apart."""
    number = F.col("id2").cast("long")
    repeated = F.when(number % 2 == 0, F.col("id2")).when(number % 4 == 1, F.lit("again"))
    rows = views.scored(spark, sf).select("model", "dataset", repeated.alias("id2"), "language", "row_id", "hypothesis", "ifeval", "comet_qe", "comet")
    outputs = [rows.where(F.col(c).isNotNull()).select(*rows.columns[:6], c) for c in ("ifeval", "comet_qe", "comet")]
    return metrics.merge_metrics(outputs)


@query
def judge_f1(spark, sf):
    return comparable(metrics.judge_quality(views.judgements(spark, sf)))


@query
def judge_decision(spark, sf):
    quality = metrics.judge_quality(views.judgements(spark, sf))
    return comparable(metrics.judge_accepted(quality, "candidate", "baseline"))


# --- model tables ------------------------------------------------------------------------------------------


@query
def coverage_matrix(spark, sf):
    return stats.coverage(views.scored(spark, sf))


@query
def speed_table(spark, sf):
    return comparable(stats.speed(views.scored(spark, sf), views.run_meta(spark, sf)))


@query
def revision_check(spark, sf):
    return stats.revisions(views.revisions(spark, sf))


@query
def run_totals(spark, sf):
    elapsed = views.run_meta(spark, sf).select(*RUN, "elapsed_seconds")
    return comparable(inference.run_totals(views.scored(spark, sf), elapsed))


@query
def load_counts(spark, sf):
    rows = views.scored(spark, sf)
    name = F.concat(t.model_slug(F.col("model")), F.lit("_"), F.col("dataset"), F.lit("_scored.csv"))
    return stats.load_counts(rows.withColumn("file_name", name))


@query
def option_values(spark, sf):
    return stats.option_values(views.scored(spark, sf))


@query
def meta_json(spark, sf):
    events = views.table(spark, sf, "events")
    number = s.meta_number(F.col("props"), "k")
    absent = s.meta_number(F.col("props"), "absent")
    return events.select("event_id", number.alias("k"), absent.alias("absent"))


# --- comparison and browsing -------------------------------------------------------------------------------


@query
def compare_candidates(spark, sf):
    return explore.candidates(views.scored(spark, sf))


@query
def ifeval_disagreements(spark, sf):
    return explore.candidates(views.scored(spark, sf), disagreements=True).select(*KEY, "n_models")


@query
def source_preview(spark, sf):
    return explore.candidate_labels(views.scored(spark, sf), limit=None)


@query
def side_by_side(spark, sf):
    return explore.side_by_side_all(views.scored(spark, sf, reference=True))


@query
def first_reference(spark, sf):
    return explore.first_references(views.scored(spark, sf, reference=True))


def _browse(spark, sf, order):
    rows = filters.select_rows(views.scored(spark, sf, reference=True), comet_qe=(0.0, 1.0), slang_density=(0.0, 1.0))
    return explore.browse(rows, order)


@query
def browse_worst(spark, sf):
    return _browse(spark, sf, "worst")


@query
def browse_best(spark, sf):
    return _browse(spark, sf, "best")


@query
def browse_polluted(spark, sf):
    return _browse(spark, sf, "polluted")


@query
def browse_longest(spark, sf):
    return _browse(spark, sf, "longest")


@query
def text_search(spark, sf):
    return filters.select_rows(views.scored(spark, sf), comet_qe=None, text=SEARCH).select("row_id", *RUN)


@query
def text_search_indexed(spark, sf):
    """Rows that mention a word, by an index; most mention it in one of the two texts only."""
    rows = views.eval_rows(spark, sf).select("row_id", "dataset", F.col("text").alias("source"), F.col("translation").alias("hypothesis"))
    with shared_folder(spark, "index") as path:
        index = TextIndex(spark, path)
        index.build(rows, ["dataset", "row_id"])
        found = index.search(INDEXED_SEARCH)
        inside = {f"in_{c}": F.contains(F.lower(t.text_or_empty(F.col(c))), F.lit(INDEXED_SEARCH.lower())) for c in index.columns}
        return stable_copy(found.withColumns(inside).select("row_id", "dataset", *inside))


@query
def filters_all(spark, sf):
    kept = filters.select_rows(
        tracked_scored(spark, sf),
        datasets=["mono_sea", "bilingual"],
        models=[],
        languages=["en", "fr", "es"],
        ifeval="clean",
        comet_qe=(0.2, 0.9),
        slang_density=(0.1, 0.8),
        min_slang_hits=3,
        text="the",
    )
    return kept.select("row_id", *RUN, "language", "ifeval", "comet_qe", "slang_density", "slang_hits")


@query
def filter_polluted(spark, sf):
    kept = filters.select_rows(views.scored(spark, sf), ifeval="polluted", comet_qe=(0.0, 0.5))
    return kept.select("row_id", *RUN, "ifeval", "comet_qe")


@query
def drop_missing(spark, sf):
    return filters.count_missing(views.scored(spark, sf))


@query
def exemplars(spark, sf):
    return examples(views.scored(spark, sf, reference=True))


@query
def worst_per_file(spark, sf):
    return worst_rows(views.scored(spark, sf))


def _ids_per_file(rows: DataFrame, files: int) -> DataFrame:
    """Ids that are unique in their file only."""
    return rows.withColumn("row_id", F.floor(F.col("row_id") / files).cast("long"))


@query
def exemplars_repeated_ids(spark, sf):
    return examples(_ids_per_file(views.scored(spark, sf, reference=True), 4))


@query
def worst_repeated_ids(spark, sf):
    return worst_rows(_ids_per_file(views.scored(spark, sf), 4))


@query
def few_shot_repeated_ids(spark, sf):
    rows = prompts.with_prompts(_ids_per_file(views.eval_rows(spark, sf), 3), SHOTS)
    return rows.select("row_id", "dataset", "prompt")


# --- source corpora ----------------------------------------------------------------------------------------


@query
def source_profile(spark, sf):
    return comparable(profile.source_profile(with_lengths(views.eval_rows(spark, sf, translation=False))))


@query
def text_lengths(spark, sf):
    rows = with_lengths(views.eval_rows(spark, sf))
    return rows.select("row_id", *[F.col(c).cast("long") for c in ("text_chars", "text_words", "translation_chars")])


@query
def language_distribution(spark, sf):
    return profile.language_counts(views.eval_rows(spark, sf, translation=False))


@query
def code_switch_rate(spark, sf):
    return comparable(profile.code_switch_rate(views.eval_rows(spark, sf, translation=False)))


@query
def lang_count_dist(spark, sf):
    return profile.language_count_sizes(views.eval_rows(spark, sf, translation=False))


@query
def lang_breakdown(spark, sf):
    return profile.language_breakdown(views.eval_rows(spark, sf, translation=False))


@query
def length_histogram(spark, sf):
    rows = views.eval_rows(spark, sf, translation=False)
    return comparable(histogram(rows, ["dataset"], t.char_length(F.col("text")), 80))


@query
def score_histogram(spark, sf):
    return comparable(histogram(views.scored(spark, sf), RUN, F.col("comet_qe"), 50, 0.0, 1.0))


@query
def box_scores(spark, sf):
    return comparable(box_numbers(views.scored(spark, sf), RUN, F.col("comet_qe")))


@query
def box_lengths(spark, sf):
    rows = views.eval_rows(spark, sf, translation=False)
    return comparable(box_numbers(rows, ["dataset"], t.char_length(F.col("text"))))


@query
def box_similarity(spark, sf):
    rows = views.eval_rows(spark, sf, translation=False)
    return comparable(box_numbers(rows, ["dataset"], F.col("semantic_similarity")))


@query
def embedding_cosine(spark, sf):
    rows = views.vector_pairs(spark, sf)
    return comparable(rows.select("vec_id", s.cosine(F.col("left"), F.col("right")).alias("similarity")))


# --- slang -------------------------------------------------------------------------------------------------


@query
def tokens(spark, sf):
    found = t.tokens(F.col("text"))
    return views.table(spark, sf, "documents").select(
        "doc_id", F.array_join(found, " ").alias("tokens"), F.size(found).cast("long").alias("n_tokens")
    )


@query
def lexicon_build(spark, sf):
    return lexicon.build_lexicon(views.lexicon_entries(spark, sf))


@query
def slang_density(spark, sf):
    return dense_documents(spark, sf).select("doc_id", *lexicon.ENRICHED)


@query
def slang_density_joined(spark, sf):
    """The same through the join that lexicons too large for the plan take."""
    documents = views.table(spark, sf, "documents")
    dense = lexicon.with_density(documents, views.lexicon(spark, sf), "text", "doc_id", literal_entries=0)
    return dense.select("doc_id", *lexicon.ENRICHED)


@query
def slang_summary(spark, sf):
    return comparable(lexicon.slang_summary(dense_documents(spark, sf)))


@query
def slang_histogram(spark, sf):
    kept = dense_documents(spark, sf).where(lexicon.is_eligible())
    return comparable(histogram(kept, [], F.col("slang_density"), 50, 0.0, 1.0))


def _track(spark, sf, label):
    labelled = lexicon.split_tracks(dense_rows(spark, sf), N_SLANG, lang="en")
    kept = labelled.where(F.col("slang_bucket") == label)
    return kept.select("row_id", "lang_codes", "slang_density", "slang_hits", "n_tokens")


@query
def slang_track(spark, sf):
    return _track(spark, sf, "slang")


@query
def formal_track(spark, sf):
    return _track(spark, sf, "formal")


@query
def split_report(spark, sf):
    return lexicon.split_report(dense_rows(spark, sf), N_SLANG, lang="en")


@query
def track_preview(spark, sf):
    rows = views.eval_rows(spark, sf, translation=False)
    return lexicon.track_preview(lexicon.with_density(rows, views.lexicon(spark, sf), "text"), lang="en")


@query
def rescore_selection(spark, sf):
    return lexicon.rescore_selection(tracked_scored(spark, sf))


# --- prompts, names, models --------------------------------------------------------------------------------


@query
def row_cap(spark, sf):
    rows = views.eval_rows(spark, sf, translation=False)
    return ranking.head_per_group(rows.select("dataset", "row_id", "id2"), ["dataset"], ROW_CAP)


@query
def prompt_zero_shot(spark, sf):
    rows = views.eval_rows(spark, sf, translation=False)
    return prompts.with_prompts(rows).select("row_id", "prompt")


@query
def prompt_few_shot(spark, sf):
    return prompts.with_prompts(views.eval_rows(spark, sf), SHOTS).select("row_id", "dataset", "prompt")


@query
def translations_projection(spark, sf):
    hypothesis = F.when(F.col("row_id") % 50 != 0, t.strip(views.whole_hypothesis(F.col("row_id"))))
    error = F.when(F.col("row_id") % 50 == 0, "timeout")
    rows = inference.translation_columns(views.eval_rows(spark, sf), views.MODELS[0], hypothesis, error)
    filled = {c: t.text_or_empty(F.col(c)) for c in ("source", "hypothesis", "reference")}
    return rows.withColumns(filled)


def _scored_names(spark, sf):
    rows = views.scored(spark, sf).groupBy(*RUN).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn(
        "file_name", F.concat(t.model_slug(F.col("model")), F.lit("_"), F.col("dataset"), F.lit("_scored.csv"))
    )


@query
def name_parse_summary(spark, sf):
    slug, dataset = t.name_parts(F.col("file_name"), ("mono_sea", "mono_me"))
    parsed = _scored_names(spark, sf).select("file_name", "n", slug.alias("slug"), dataset.alias("parsed_dataset"))
    known = parsed.where(F.col("parsed_dataset").isNotNull())
    return known.withColumn("parsed_model", t.model_from_slug(F.col("slug")))


@query
def name_parse_stats(spark, sf):
    slug, dataset = t.name_parts(F.col("file_name"), stats.SPLITS)
    return _scored_names(spark, sf).select(
        "file_name",
        "n",
        slug.alias("slug"),
        dataset.alias("split"),
        t.dataset_of_scored_name(F.col("file_name")).alias("eda_dataset"),
    )


@query
def file_names(spark, sf):
    runs = views.scored(spark, sf).groupBy(*RUN).agg(F.count(F.lit(1)).alias("n"))
    named = runs.withColumn("csv_name", t.translations_name(F.col("model"), F.concat("dataset", F.lit(".jsonl"))))
    meta = F.concat("csv_name", F.lit(".meta.json"))
    return named.select(
        *RUN,
        "n",
        "csv_name",
        t.scored_name(F.col("csv_name")).alias("scored_name"),
        t.dataset_of_meta_name(meta, t.model_slug(F.col("model"))).alias("meta_dataset"),
    )


def _echo_model():
    """Stand-in for a model: answers with the prompt's last line in brackets, fails on a marked word."""

    def answer(prompt: str) -> str:
        if "onesen" in prompt:
            raise ValueError("refused")
        last = prompt.split("\n")[-1]
        return f" [{last}]\n"

    return answer


def _length_judge():
    """Stand-in classifier: short outputs are clean."""
    return lambda texts: ["clean" if len(text) < 300 else "polluted" for text in texts]


def _ratio_scorer():
    """Stand-in quality model: output length over joint length."""
    return lambda sources, outputs: [len(o) / (len(a) + len(o)) if a or o else 0.0 for a, o in zip(sources, outputs)]


def _triple_scorer():
    """Stand-in reference-based quality model."""
    return lambda sources, outputs, references: [
        (len(o) + len(r)) / (len(a) + len(o) + len(r) + 1) for a, o, r in zip(sources, outputs, references)
    ]


@query
def batch_infer(spark, sf):
    ship_package(spark)
    rows = prompts.with_prompts(views.eval_rows(spark, sf))
    out = inference.translate(rows, views.MODELS[0], _echo_model)
    return out.select("row_id", "dataset", "model", "lang_codes", "hypothesis", "error")


@query
def score_pairs(spark, sf):
    ship_package(spark)
    scorers = {"ifeval": _length_judge, "qe": _ratio_scorer, "ref": _triple_scorer}
    out = inference.score(views.pairs(spark, sf), scorers, ["ifeval", "qe", "ref"])
    return comparable(out.select("row_id", "ifeval", "comet_qe", "comet"))


def _set_model(settings):
    """The same stand-in, which says how it was told to decode."""
    answer = _echo_model()
    return lambda prompt: f"{answer(prompt).strip()} {settings['max_tokens']}/{settings['temperature']}"


def _set_judge(settings):
    """Stand-in classifier that takes its two labels, and the length it goes by, from its settings."""
    clean, polluted = settings["labels"]
    limit = len(settings["hypothesis"])
    return lambda texts: [clean if len(text) < limit else polluted for text in texts]


@query
def infer_resumed(spark, sf):
    """A corpus translated after a job that got through one dataset; every answered prompt was asked once."""
    rows = prompts.with_prompts(views.eval_rows(spark, sf)).select("row_id", "dataset", "prompt", "id1", "id2", "lang_codes", "text", "translation")
    model, question = views.MODELS[0], inference.Question(views.MODELS[0], "translate", inference.DECODING)
    with shared_folder(spark, "answers") as path:
        answers = inference.AnswerTable(spark, path, slice_questions=20_000)
        for part in (rows.where("dataset = 'mono_sea'"), rows):
            out = inference.translate(part, model, _set_model, answers=answers)
        answered = answers.raw(question).where("error is null")
        asked = answered.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("times_asked"))
        return stable_copy(out.select("row_id", "dataset", "hypothesis", "error", asked.scalar().alias("times_asked")))


@query
def score_resumed(spark, sf):
    """Answers scored after a job that got through a third of the models' metrics; equal texts are scored once."""
    # Every third pair has no reference, the others that of the source's own words.
    rows = views.pairs(spark, sf).withColumn("reference", F.when(F.col("row_id") % 3 != 0, F.col("source")))
    scorers, names = {"ifeval": _set_judge, "qe": _ratio_scorer, "ref": _triple_scorer}, {m: f"stand-in {m}" for m in inference.METRICS}
    judging = {"ifeval": {"labels": ["pure", "mixed"], "hypothesis": "x" * 250}}
    with shared_folder(spark, "answers") as path:
        answers = inference.AnswerTable(spark, path)
        for wanted in (["ifeval"], list(inference.METRICS)):
            out = inference.score(rows, scorers, wanted, settings=judging, answers=answers, names=names)
        asked = answers.raw(inference.Question(names["ifeval"], "ifeval", judging["ifeval"]))
        counted = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("times_asked"))
        return stable_copy(comparable(out.select("row_id", "ifeval", "comet_qe", "comet", counted.scalar().alias("times_asked"))))


@query
def pair_scores(spark, sf):
    """Each embedding as eight token vectors, aligned with those of the next one."""
    tokens = lambda c: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(c, i * 8 + 1, F.lit(8)))
    rows = views.vector_pairs(spark, sf).select("vec_id", s.alignment(tokens(F.col("left")), tokens(F.col("right"))).alias("scores"))
    return comparable(rows.select("vec_id", "scores.precision", "scores.recall", "scores.f1"))


# --- runs in a store, and files written and read back ----------------------------------------------------------


@query
def store_rerun(spark, sf):
    """A run written twice: first without scores, then whole; the summary has each model and dataset once."""
    rows = views.scored(spark, sf).select(*RUN, "row_id", "language", "ifeval", "comet_qe", "error")
    settings = {"view": "scored"}
    with shared_folder(spark, "store") as path:
        store = RunStore(spark, path)
        for attempt in (rows.withColumns({c: F.lit(None).cast("double") for c in ("ifeval", "comet_qe")}), rows):
            store.write("translations", attempt.drop("ifeval", "comet_qe"), "007", settings)
            store.write("scored", filters.drop_missing(attempt, "language"), "007", settings)
        store.write("scored", rows, "008", settings)
        records = store.records("translations", "007")
        found = summary.overall(store.read("scored", "007"), records)
        counted = store.records().groupBy(*RUN).agg(F.count(F.lit(1)).alias("n_records"))
        return stable_copy(comparable(found.drop("elapsed_seconds", "req_per_s").join(counted, RUN)))


@query
def meta_round_trip(spark, sf):
    """Run metadata added to a folder twice, read back, the newest of each run."""
    meta = views.run_meta(spark, sf)
    with shared_folder(spark, "meta") as path:
        for concurrency in (16, 32):
            writers.write_run_metadata(writers.run_metadata(meta.drop("concurrency"), concurrency=concurrency), path)
        read = readers.read_run_meta(spark, path)
        facts = F.max(F.struct("timestamp", "n_rows", "n_errors", "concurrency", "elapsed_seconds", "req_per_s")).alias("newest")
        newest = read.groupBy(*RUN).agg(facts, F.count(F.lit(1)).alias("n_records"))
        columns = [F.col(f"newest.{c}").alias(c) for c in ("n_rows", "n_errors", "concurrency", "elapsed_seconds", "req_per_s")]
        return stable_copy(comparable(newest.select(*RUN, "n_records", *columns)))


@query
def csv_mixed_headers(spark, sf):
    """Conversation turns written to CSV files of three headers, matched by name when read."""
    turns = views.table(spark, sf, "conversations").withColumn("text", F.nullif("text", F.lit("")))
    headers = {"user": ["conv_id", "turn", "role", "text"], "assistant": ["text", "role", "turn", "conv_id"]}
    is_named = F.col("role").isin(*headers)
    with shared_folder(spark, "csv") as path:
        for role, columns in headers.items():
            writers.write_csv(turns.where(F.col("role") == role).select(columns), f"{path}/{role}")
        writers.write_csv(turns.where(~is_named | F.col("role").isNull()).select("conv_id", "text", "turn"), f"{path}/other")
        read = readers.read_csv_files(spark, readers.files_matching(spark, f"{path}/*", "*.csv"))
        typed = read.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
        return stable_copy(typed)


@query
def jsonl_round_trip(spark, sf):
    """Evaluation rows written as JSON lines and read back, with the lengths of their texts."""
    columns = [f.name for f in sc.EVAL_ROW.fields]
    with shared_folder(spark, "json") as path:
        writers.write_json_lines(views.eval_rows(spark, sf).select("row_id", *columns), f"{path}/part.jsonl")
        read = with_lengths(readers.read_json_lines(spark, f"{path}/part.jsonl/*.json", pattern="*.json"))
        return stable_copy(comparable(read.select(*[c for c in columns if c not in ("text", "translation")], *[F.col(c).cast("long") for c in LENGTHS], F.md5("text").alias("text_md5"))))


@query
def file_row_cap(spark, sf):
    """The first rows of each file, in its order; a file holds the turns of fifty conversations."""
    turns = views.table(spark, sf, "conversations")
    lines = turns.select(F.floor(F.col("conv_id") / 50).alias("k"), (F.col("conv_id") * 1000 + F.col("turn")).alias("at"), "role", "text")
    raw = F.to_json(F.struct(F.col("role").alias("id1"), F.col("at").alias("id2"), "text")).alias("value")
    with shared_folder(spark, "cap") as path:
        lines.repartition("k").sortWithinPartitions("k", "at").select("k", raw).write.partitionBy("k").text(path)
        read = readers.read_json_lines(spark, path, FILE_CAP, recursive=True, pattern="*.txt")
        file = F.regexp_extract("file_path", "k=([0-9]+)", 1).cast("long")
        return stable_copy(read.select(file.alias("file"), F.col("id2").cast("long").alias("at"), F.length("text").cast("long").alias("chars")))


@query
def lexicon_json_round_trip(spark, sf):
    """A lexicon written as one JSON object over ordered part files, and read back line by line."""
    built = lexicon.build_lexicon(views.lexicon_entries(spark, sf))
    with shared_folder(spark, "lexicon") as path:
        writers.write_lexicon_json(built, path)
        return stable_copy(readers.read_lexicon_json(spark, path, by_line=True))


@query
def catalogue(spark, sf):
    """Corpus files by their rows, counted once: the second catalogue takes them from the first. Skipped folders stay out."""
    rows = views.table(spark, sf, "documents").select("doc_id", "source")
    with shared_folder(spark, "catalogue") as path:
        for folder, chosen in (("a", "src0"), ("b", "src1"), ("results_x", "src2"), ("hf_cache", "src3")):
            line = F.to_json(F.struct("doc_id"))
            rows.where(F.col("source") == chosen).select(line).write.text(f"{path}/root/{folder}/{chosen}")
        described = spark.createDataFrame([], "stem string, description string")
        options = {"descriptions": described, "count_rows": True, "cache": f"{path}/counts"}
        first = stable_copy(readers.corpus_catalogue(spark, f"{path}/root", pattern="*.txt", **options))
        again = readers.corpus_catalogue(spark, f"{path}/root", pattern="*.txt", **options)
        name = F.element_at(F.split("path", "/"), -2)
        both = first.select("path", F.col("n_rows").alias("n_first")).join(again.select("path", "n_rows"), "path")
        return stable_copy(both.groupBy(name.alias("source")).agg(F.sum("n_first").alias("n_first"), F.sum("n_rows").alias("n_rows")))


@query
def tracks_round_trip(spark, sf):
    """Both tracks written as JSON lines and read back: every line's place in its track.

    A place is the lines of the files before plus the place in the file, so no track is sorted again.
    """
    rows = views.eval_rows(spark, sf, translation=False)
    raw = F.to_json(F.struct(F.col("row_id").alias("id1"), "text"))
    dense = stable_copy(lexicon.with_density(rows.withColumn("raw", raw), views.lexicon(spark, sf), "text").select("row_id", "lang_codes", "raw", *lexicon.ENRICHED))
    with shared_folder(spark, "tracks") as path:
        writers.write_tracks(lexicon.split_tracks(dense, N_SLANG, lang="en"), path, "slang", "formal")
        parts = [
            readers.read_json_lines(spark, f"{path}/{track}", pattern="*.txt").select(F.lit(track).alias("track"), "file_name", "row_id", "id1", "text")
            for track in ("slang", "formal")
        ]
        lines = stable_copy(parts[0].unionByName(parts[1]))
        earlier = Window.partitionBy("track").orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
        files = lines.groupBy("track", "file_name").agg(F.count(F.lit(1)).alias("n"))
        before = files.select("track", "file_name", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        inside = F.row_number().over(Window.partitionBy("track", "file_name").orderBy("row_id"))
        placed = lines.withColumn("inside", inside).join(before, ["track", "file_name"])
        place = (F.col("before") + F.col("inside")).alias("place")
        return stable_copy(placed.select("track", place, F.col("id1").cast("long").alias("row_id"), F.md5("text").alias("text_md5")))


@query
def bundle_round_trip(spark, sf):
    """The three summary tables written as one JSON document over ordered part files, and its records read back."""
    scored = views.scored(spark, sf, reference=True)
    overall, by_language = summary.both_levels(scored, views.run_meta(spark, sf))
    tables = [stable_copy(table) for table in (overall, by_language, examples(scored))]
    kinds = {"overall": "n_rows_scored long", "by_language": "n_rows long", "examples": "category string, hypothesis string"}
    fields = f"model string, dataset string, language string, mean_comet_qe double, joint_pass_rate double, {', '.join(kinds.values())}"
    with shared_folder(spark, "bundle") as path:
        writers.write_bundle(*tables, path, 0.8, "results")
        lines = spark.read.text(path).select(F.regexp_replace("value", "^,", "").alias("value"))
        records = lines.where(F.col("value").startswith('{"model"') | F.col("value").startswith('{"dataset"'))
        read = records.select(F.from_json("value", fields, {"mode": "FAILFAST"}).alias("r")).select("r.*")
        section = F.when(F.col("category").isNotNull(), "examples").when(F.col("n_rows_scored").isNotNull(), "overall").otherwise("by_language")
        measures = ["mean_comet_qe", "joint_pass_rate"]
        counted = F.coalesce("n_rows_scored", "n_rows").alias("n")
        return stable_copy(comparable(read.select(section.alias("section"), *RUN, "language", "category", counted, *measures, F.md5("hypothesis").alias("hypothesis_md5"))))


@query
def enrich_mixed(spark, sf):
    """A folder of CSV files of which some carry density already: those are skipped, the others enriched."""
    documents = views.table(spark, sf, "documents").select("doc_id", F.col("text").alias("source"))
    has_density = F.col("doc_id") % 3 == 0
    with shared_folder(spark, "enrich") as path:
        writers.write_lexicon_json(views.lexicon(spark, sf).withColumn("formal", F.upper("slang")), f"{path}/lexicon")
        done = documents.where(has_density).withColumns({c: F.lit(0) for c in lexicon.ENRICHED})
        for name, rows in (("done", done), ("open", documents.where(~has_density))):
            writers.write_csv(rows, f"{path}/in/{name}")
        log = jobs.enrich_folder(spark, f"{path}/in/*", f"{path}/lexicon", f"{path}/out", pattern="*.csv")
        rows = spark.read.parquet(f"{path}/out").select(F.col("doc_id").cast("long"), *lexicon.ENRICHED)
        return stable_copy(rows.withColumn("n_rows", F.lit(log.rows).cast("long")))
