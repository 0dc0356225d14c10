"""Command line: ``spark-submit`` or ``python -m verbascope <command> ...``."""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbascope.functions import scores
from verbascope.functions import text as t
from verbascope.operators import lexicon, metrics
from verbascope.plans import jobs, stats
from verbascope.session import build_session
from verbascope.sources import readers


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="verbascope", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    summarise = commands.add_parser("summarise", help="summary tables and bundle of scored files")
    summarise.add_argument("folder")
    summarise.add_argument("out")
    summarise.add_argument("--joint-threshold", type=float, default=scores.JOINT_THRESHOLD)

    run = commands.add_parser("summarise-run", help="summary tables and bundle of a stored run")
    run.add_argument("store")
    run.add_argument("run_id")
    run.add_argument("out")
    run.add_argument("--joint-threshold", type=float, default=scores.JOINT_THRESHOLD)
    run.add_argument("--scored-as", help="run id of the scores, where they have one of their own")

    score = commands.add_parser("score-run", help="score the stored translations of a run")
    score.add_argument("store")
    score.add_argument("run_id")
    score.add_argument("--scorer", action="append", default=[], metavar="METRIC=MODULE:FUNCTION", help="factory of a scorer")
    score.add_argument("--metrics")
    score.add_argument("--scored-as")
    score.add_argument("--replace", action="store_true")

    report = commands.add_parser("report-run", help="tables of a stored run after scoring")
    report.add_argument("store")
    report.add_argument("run_id")
    report.add_argument("out")

    tables = commands.add_parser("stats", help="coverage, quality and speed tables of scored files")
    tables.add_argument("folder")

    enrich = commands.add_parser("enrich", help="add slang density to scored files")
    enrich.add_argument("folder")
    enrich.add_argument("lexicon")
    enrich.add_argument("out")
    enrich.add_argument("--pattern", default="*_scored.csv")
    enrich.add_argument("--text-col", default="source")
    enrich.add_argument("--overwrite", action="store_true")
    enrich.add_argument("--dry-run", action="store_true")

    split = commands.add_parser("split", help="split a corpus into slang and formal tracks")
    split.add_argument("corpus")
    split.add_argument("lexicon")
    split.add_argument("out")
    split.add_argument("--lang-code", default="id")
    split.add_argument("--n-slang", type=int, default=lexicon.N_SLANG)
    split.add_argument("--min-tokens", type=int, default=lexicon.MIN_TOKENS)
    split.add_argument("--slang-name")
    split.add_argument("--formal-name")

    build = commands.add_parser("lexicon", help="reduce a raw lexicon CSV to a JSON object")
    build.add_argument("source")
    build.add_argument("out")

    catalogue = commands.add_parser("catalogue", help="list corpus files with size, rows and description")
    catalogue.add_argument("root")
    catalogue.add_argument("--descriptions", help="YAML file of stem -> description")
    return parser.parse_args()


def _factory(place: str):
    """The function that ``module:function`` names."""
    module, _, function = place.partition(":")
    return getattr(import_module(module), function)


def _print(table: DataFrame) -> None:
    """Every row, a partition at a time."""
    print("\t".join(table.columns))
    for row in table.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main() -> None:
    args = _arguments()
    spark = build_session()
    if args.command == "summarise":
        jobs.summarise_folder(spark, args.folder, args.out, args.joint_threshold)
    elif args.command == "summarise-run":
        jobs.summarise_run(spark, args.store, args.run_id, args.out, args.joint_threshold, args.scored_as)
    elif args.command == "score-run":
        scorers = {metric: _factory(place) for metric, _, place in (given.partition("=") for given in args.scorer)}
        _print(jobs.score_run(spark, args.store, args.run_id, scorers, args.metrics, args.scored_as, args.replace))
    elif args.command == "report-run":
        jobs.report_run(spark, args.store, args.run_id, args.out)
    elif args.command == "stats":
        scored = readers.read_scored_by_name(spark, args.folder, stats.SPLITS)
        meta = readers.read_run_meta(spark, args.folder)
        _print(stats.coverage(scored))
        _print(metrics.model_stats(scored).orderBy("model", "dataset"))
        named = meta.withColumn("model", t.model_from_slug(F.col("model_slug")))
        _print(stats.speed(scored, named))
    elif args.command == "enrich":
        written = jobs.enrich_folder(
            spark, args.folder, args.lexicon, args.out, args.pattern, args.text_col, args.overwrite, args.dry_run
        )
        print(f"{written.files} files and {written.rows} rows written, {written.skipped} files skipped")
    elif args.command == "split":
        report = jobs.split_corpus(
            spark, args.corpus, args.lexicon, args.out, args.lang_code, args.n_slang, args.min_tokens,
            args.slang_name, args.formal_name,
        )
        report.show(truncate=False, vertical=True)
    elif args.command == "lexicon":
        jobs.build_lexicon_file(spark, args.source, args.out)
    else:
        entries: dict[str, str] = {}
        described = readers.read_descriptions(spark, entries)
        if args.descriptions:
            text = spark.read.text(args.descriptions, wholetext=True).first()["value"]
            described = readers.read_descriptions_yaml(spark, text)
        _print(readers.corpus_catalogue(spark, args.root, described, count_rows=True))


if __name__ == "__main__":
    main()
