"""Writers: a partitioned store, CSV and JSON-lines exports, and reports.

No writer gathers a table in one task. Reports are sorted by range, so that their part files, read in order,
are the sorted report; small ones come out as one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope import schema as sc
from verbascope.functions import text as t

# Fields may hold line breaks, which makes a CSV file one task for its reader; files stay small.
CSV_ROWS_PER_FILE = 1_000_000

_CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8", "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _by_model(df: DataFrame) -> DataFrame:
    return df.withColumn("model_slug", t.model_slug(F.col("model")))


def write_store(df: DataFrame, path: str, by: Sequence[str], mode: str = "append") -> None:
    """Parquet below one folder per value of ``by``; tasks are balanced by size, hot values over several."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def write_translations(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per model and dataset."""
    write_store(_by_model(df), path, ["model_slug", "dataset"], mode)


def publish_translations(df: DataFrame, path: str, run_id: str) -> None:
    """Add a run to the store, for scoring it again later."""
    write_store(_by_model(df).withColumn("run_id", F.lit(run_id)), path, ["model_slug", "run_id"])


def read_published(spark: SparkSession, path: str, run_id: str | None = None, model: str | None = None) -> DataFrame:
    """Translations of an earlier run; only its folders are read."""
    rows = spark.read.parquet(path)
    if run_id is not None:
        rows = rows.where(F.col("run_id") == run_id)
    if model is not None:
        rows = rows.where(F.col("model_slug") == t.model_slug(F.lit(model)))
    return rows


def write_scored(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored rows, one folder per model and dataset."""
    write_store(_by_model(df), path, ["model_slug", "dataset"], mode)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export that the readers here take back, line breaks and quotes included."""
    df.write.mode(mode).options(**_CSV).option("maxRecordsPerFile", CSV_ROWS_PER_FILE).csv(path)


def run_metadata(totals: DataFrame, **fields) -> DataFrame:
    """Metadata records from run totals; ``fields`` gives the constant ones, the time stamp is now."""
    constants = {name: F.lit(value) for name, value in fields.items()}
    return sc.normalise(totals.withColumns({**constants, "timestamp": F.current_timestamp()}), sc.RUN_META)


def write_run_metadata(records: DataFrame, path: str) -> None:
    records.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_summaries(overall: DataFrame, by_language: DataFrame, examples: DataFrame, path: str) -> None:
    """The three summary tables, sorted, each below its own folder."""
    write_csv(overall.orderBy("dataset", "model"), f"{path}/summary_overall")
    write_csv(by_language.orderBy("dataset", F.asc_nulls_last("language"), "model"), f"{path}/summary_by_language")
    ordered = examples.orderBy(*_example_order()).select(*sc.SUMMARY_EXAMPLE.fieldNames())
    write_csv(ordered, f"{path}/summary_examples")


def _separated(df: DataFrame, order: Sequence[Column], line: Column) -> DataFrame:
    """Lines with a comma before all but the first in ``order``, whose text must identify a row."""
    key = F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in order])
    first = df.agg(F.min(key).alias("first")).scalar()
    return df.select(key.alias("key"), F.when(key == first, line).otherwise(F.concat(F.lit(","), line)).alias("line"))


def _document(parts: Sequence[tuple[str, DataFrame | None, str]], path: str, spark: SparkSession) -> None:
    """Write heading, lines, footing of each part one after another, as text sorted by range."""
    sections = None
    for number, (head, lines, foot) in enumerate(parts):
        fixed = spark.createDataFrame([(number, 0, head), (number, 2, foot)], "part int, piece int, line string")
        piece = fixed.where(F.col("line") != "").withColumn("key", F.array().cast("array<string>"))
        if lines is not None:
            body = lines.select(F.lit(number).alias("part"), F.lit(1).alias("piece"), "line", "key")
            piece = piece.unionByName(body)
        sections = piece if sections is None else sections.unionByName(piece)
    sections.orderBy("part", "piece", "key").select("line").write.mode("overwrite").text(path)


def write_bundle(
    overall: DataFrame,
    by_language: DataFrame,
    examples: DataFrame,
    path: str,
    joint_threshold: float,
    results_dir: str,
) -> None:
    """One JSON document {meta, overall, by_language, examples}, spread over ordered part files."""
    spark = overall.sparkSession
    record = lambda df: F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    meta = spark.range(1).select(
        F.to_json(
            F.struct(
                F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
                F.lit(joint_threshold).alias("joint_threshold"),
                F.lit(results_dir).alias("results_dir"),
            )
        ).alias("line"),
        F.array(F.lit("")).alias("key"),
    )
    columns = list(sc.SUMMARY_EXAMPLE.fieldNames())
    example_line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    col = F.col
    _document(
        [
            ('{"meta":', meta, ""),
            (',"overall":[', _separated(overall, [col("dataset"), col("model")], record(overall)), "]"),
            (
                ',"by_language":[',
                _separated(by_language, [col("dataset"), col("language"), col("model")], record(by_language)),
                "]",
            ),
            (',"examples":[', _separated(examples, _example_order(), example_line), "]}"),
        ],
        path,
        spark,
    )


def _example_order() -> list[Column]:
    """Model, dataset, then best, worst and polluted, each by rank."""
    category = F.col("category")
    number = F.when(category == "best", 0).when(category == "worst", 1).otherwise(2)
    return [F.col("model"), F.col("dataset"), number, F.lpad(F.col("position").cast("string"), 9, "0")]


def write_lexicon_json(lexicon: DataFrame, path: str) -> None:
    """One JSON object with sorted keys, an entry per line."""
    pair = F.to_json(F.create_map("slang", "formal"))
    entry = F.substring(pair, F.lit(2), F.length(pair) - 2)
    _document([("{", _separated(lexicon, [F.col("slang")], entry), "}")], path, lexicon.sparkSession)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines in input order: the raw line when it was kept, else all columns."""
    ordered = rows.orderBy("row_id") if "row_id" in rows.columns else rows
    if "raw" in rows.columns:
        ordered.select("raw").write.mode("overwrite").text(path)
    else:
        ordered.drop("row_id").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_tracks(labelled: DataFrame, path: str, slang_name: str, formal_name: str) -> None:
    """The two tracks of a split below their names, densest rows first."""
    order = [F.desc("slang_density"), F.desc("slang_hits"), F.asc("row_id")]
    for label, name in (("slang", slang_name), ("formal", formal_name)):
        track = labelled.where(F.col("slang_bucket") == label).orderBy(*order)
        if "raw" in track.columns:
            track.select("raw").write.mode("overwrite").text(f"{path}/{name}")
        else:
            kept = track.drop("slang_bucket", "slang_density", "slang_hits", "n_tokens", "row_id")
            kept.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def write_enriched(df: DataFrame, changed: bool, path: str, dry_run: bool = False) -> bool:
    """Write an enriched table to a new path; nothing is written on a dry run or when nothing was added."""
    if dry_run or not changed:
        return False
    rows = _by_model(df) if "model" in df.columns else df
    write_store(rows, path, [c for c in ("model_slug", "dataset") if c in rows.columns])
    return True
