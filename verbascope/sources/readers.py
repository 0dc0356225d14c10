"""Readers of evaluation corpora, translation and score files, run metadata and lexicons."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbascope import schema as sc
from verbascope.functions import scores as s
from verbascope.functions import text as t
from verbascope.operators.joins import small_side
from verbascope.session import folder_exists, is_folder, stable_copy
from verbascope.sources.store import TRANSLATED, read_records

# The source corpora of the profile view.
SOURCE_DATASETS = ("bi_ar_id", "bi_en_ar", "bi_en_id", "mono_me", "mono_sea", "multi")

# Names of corpus files.
CORPUS_FILES = "*.jsonl"

# Folders a corpus scan leaves out, besides those whose name starts with "results".
SKIPPED_FOLDERS = ("hf_cache", ".git", "__pycache__", ".venv", "venv", "node_modules", ".clearml")

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def with_origin(df: DataFrame) -> DataFrame:
    """Name and path of the file every row comes from, and the start of the block it was read in."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def with_row_ids(df: DataFrame) -> DataFrame:
    """Origin of every row and an id that rises by one through each block of a file.

    Write the table before using the ids twice in a longer job: they belong to one way of reading the files.
    """
    return with_origin(df).withColumn("row_id", F.monotonically_increasing_id())


def cap_rows(df: DataFrame, max_rows: int | None) -> DataFrame:
    """First ``max_rows`` rows of each file.

    Rows are counted per block of a file; a row's place is then the rows in the blocks before, plus the
    distance of its id from the first one in its block. No rows are sorted.
    """
    if max_rows is None:
        return df
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        df.groupBy("file_path", "block_start")
        .agg(F.count(F.lit(1)).alias("__rows"), F.min("row_id").alias("__first"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .where(F.col("__before") < max_rows)
        .drop("__rows")
    )
    kept, _ = small_side(blocks)
    place = F.col("__before") + F.col("row_id") - F.col("__first")
    return df.join(kept, ["file_path", "block_start"]).where(place < max_rows).drop("__before", "__first")


def read_json_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    max_rows: int | None = None,
    recursive: bool = False,
    pattern: str = CORPUS_FILES,
) -> DataFrame:
    """Evaluation rows of JSON-lines files, with the raw line beside them.

    Lines are read as text, so a byte order mark is dropped and invalid bytes become the replacement
    character; blank lines are skipped and a malformed line is an error.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    lines = with_origin(reader.text(list(paths) if not isinstance(paths, str) else paths))
    kept = lines.withColumn("raw", t.strip(F.col("value"))).where(F.col("raw") != "").drop("value")
    numbered = cap_rows(kept.withColumn("row_id", F.monotonically_increasing_id()), max_rows)
    as_text = ", ".join(f"{c} string" for c in sc.EVAL_ROW.fieldNames())
    parsed = numbered.withColumn("__row", F.from_json("raw", as_text, {"mode": "FAILFAST"}))
    return parsed.select(
        *[sc.typed(F.col(f"__row.{f.name}"), f.dataType).alias(f.name) for f in sc.EVAL_ROW.fields],
        t.file_stem(F.col("file_name")).alias("dataset"),
        "row_id",
        "file_name",
        "file_path",
        "raw",
    )


def with_lengths(rows: DataFrame) -> DataFrame:
    """Character and word counts of the text, characters of the translation."""
    return rows.select(
        "*",
        t.char_length(F.col("text")).alias("text_chars"),
        t.word_count(F.col("text")).alias("text_words"),
        t.char_length(F.col("translation")).alias("translation_chars"),
    )


def read_source_folder(
    spark: SparkSession, folder: str, datasets: Sequence[str] = SOURCE_DATASETS, max_rows: int | None = None
) -> DataFrame:
    """The known corpora of a folder in one table; absent ones are skipped, none at all gives no rows."""
    wanted = [f"{folder.rstrip('/')}/{name}.jsonl" for name in datasets]
    present = [path for path in wanted if folder_exists(spark, path)]
    if not present:
        empty = spark.createDataFrame([], sc.EVAL_ROW)
        return with_lengths(empty.withColumn("dataset", F.lit(None).cast("string")))
    return with_lengths(read_json_lines(spark, present, max_rows))


def read_eval_datasets(
    spark: SparkSession, folders: Mapping[str, str], names: Sequence[str], max_rows: int | None = None
) -> DataFrame:
    """Rows of the named datasets, each a folder searched at any depth; one without corpus files is an error.

    ``dataset`` stays the file's own stem; ``dataset_name`` is the requested name.
    """
    tables = []
    for name in dict.fromkeys(names):
        rows = read_json_lines(spark, folders[name], max_rows, recursive=True) if name in folders else None
        if rows is None or not rows.inputFiles():
            raise FileNotFoundError(f"dataset {name!r} has no *.jsonl file")
        tables.append(rows.withColumn("dataset_name", F.lit(name)))
    if not tables:
        raise ValueError("no dataset named")
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other)
    # Two folders may hold files of one name, so ids must differ over the union.
    return union if len(tables) == 1 else union.withColumn("row_id", F.monotonically_increasing_id())


def files_matching(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths under ``folder`` with a matching name, in order. A listing, like the one every reader makes."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return sorted(unquote(path) for path in listing.inputFiles())


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """file_path and first line of each file that has one, from one scan that keeps a row for each file and task."""
    lines = with_origin(spark.read.text(list(paths))).where("block_start = 0")
    first = F.min_by("value", "at").alias("line")
    return lines.withColumn("at", F.monotonically_increasing_id()).groupBy("file_path").agg(first)


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the CSV files that have it, in order; empty files have the empty one.

    Files are grouped by their first line in one distributed job; the reader then names the columns of each distinct
    line once. Only a header that goes on over a line break is looked at file by file.
    """

    def plain(path: str) -> str:
        return re.sub("^file:/*", "/", path)

    def columns(path: str, multi_line: bool) -> tuple[str, ...]:
        return tuple(spark.read.options(**{**_CSV, "multiLine": str(multi_line).lower()}).csv(path).columns)

    grouped = first_lines(spark, paths).groupBy("line").agg(F.collect_list("file_path").alias("paths")).collect()
    asked: list[tuple[list[str], bool]] = []
    for line, encoded in grouped:
        members = sorted(map(unquote, encoded))
        asked += [([path], True) for path in members] if line.count('"') % 2 else [(members, False)]
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda one: columns(one[0][0], one[1]), asked))
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, (members, _) in zip(headers, asked, strict=True):
        groups[header] = sorted([*groups.get(header, []), *members])
    # Files without a line are not in the scan; a path may have been given without its scheme.
    found = [plain(path) for members in groups.values() for path in members]
    empty = []
    if len(found) < len(set(paths)):
        empty = [path for path in paths if not any(f.endswith(plain(path)) for f in found)]
    return groups | ({(): empty} if empty else {})


def read_csv_files(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> DataFrame:
    """CSV files of any mix of headers, columns matched by name, all as text.

    Files that share a header are read together, since one read binds columns by position. Fields may hold
    line breaks, so a file is one task: keep files small, or pass ``multi_line=False`` where they hold none.
    """
    if not paths:
        raise FileNotFoundError("no files to read")
    groups = files_by_header(spark, paths)
    options = {**_CSV, "multiLine": str(multi_line).lower()}
    tables = []
    for columns, members in groups.items():
        if not columns:
            continue
        ddl = ", ".join(f"`{c}` string" for c in columns)
        tables.append(with_row_ids(spark.read.options(**options).schema(ddl).csv(members)))
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    if len(tables) > 1:
        union = union.withColumn("row_id", F.monotonically_increasing_id())
    return union


def read_translations(spark: SparkSession, folder: str, pattern: str = "*_translations*.csv") -> DataFrame:
    """All translation files of a folder."""
    return sc.normalise(read_csv_files(spark, files_matching(spark, folder, pattern)), sc.TRANSLATION)


def read_scored(
    spark: SparkSession, folder: str, datasets: Sequence[str] = ("mono_sea", "mono_me"), pattern: str = "*_scored.csv"
) -> DataFrame:
    """All scored files of a folder; ``dataset`` comes from the file name, ``unknown`` when it fits none.

    Columns no file has come as typed nulls.
    """
    rows = sc.normalise(read_csv_files(spark, files_matching(spark, folder, pattern)), sc.SCORED)
    return rows.withColumn("dataset", t.dataset_of_scored_name(F.col("file_name"), datasets))


def read_scored_by_name(
    spark: SparkSession, folder: str, datasets: Sequence[str] = ("mono_sea", "mono_me"), pattern: str = "*_scored.csv"
) -> DataFrame:
    """Scored files with model and dataset both taken from the name; files whose name fits no dataset are left out."""
    rows = sc.normalise(read_csv_files(spark, files_matching(spark, folder, pattern)), sc.SCORED)
    slug, dataset = t.name_parts(F.col("file_name"), datasets)
    named = rows.withColumns({"model_slug": slug, "dataset": dataset}).where(F.col("dataset").isNotNull())
    return named.withColumn("model", t.model_from_slug(F.col("model_slug")))


def _sidecars(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Metadata files beside translation files, one object each, named after them."""
    raw = (
        spark.read.option("pathGlobFilter", pattern)
        .text(folder, wholetext=True)
        .select("value", F.col("_metadata.file_name").alias("file_name"))
    )

    def field(name: str, kind: T.DataType) -> Column:
        if isinstance(kind, (T.LongType, T.DoubleType)):
            return s.meta_number(F.col("value"), name).cast(kind).alias(name)
        return sc.typed(F.get_json_object("value", f"$.{name}"), kind).alias(name)

    named = raw.select(*[field(f.name, f.dataType) for f in sc.RUN_META.fields], "file_name")
    slug = F.substring_index("file_name", "_translations_", 1)
    return named.withColumns({"model_slug": slug, "dataset": t.dataset_of_meta_name(F.col("file_name"), slug)})


def read_run_meta(spark: SparkSession, folder: str, pattern: str = "*.meta.json") -> DataFrame:
    """Metadata records of a folder with the model slug and dataset each belongs to; none gives no rows.

    A folder may hold files beside translations, a run store's records (of its translations), or lines that ``write_run_metadata`` added.
    Numbers must be JSON numbers: text in their place is null.
    """
    columns = [*sc.RUN_META.fieldNames(), "model_slug", "dataset"]
    found = spark.createDataFrame([], sc.RUN_META).withColumns({c: F.lit(None).cast("string") for c in columns[-2:]})
    if files_matching(spark, folder, pattern):
        found = found.unionByName(_sidecars(spark, folder, pattern).select(*columns))
    parts = files_matching(spark, folder, "part-*.json")
    added = [path for path in parts if "/stage=" not in path]
    if added:
        lines = spark.read.schema(T.StructType([*sc.RUN_META.fields, T.StructField("dataset", T.StringType())])).json(added)
        found = found.unionByName(lines.withColumn("model_slug", t.model_slug(F.col("model"))).select(*columns))
    if len(parts) > len(added):
        found = found.unionByName(read_records(spark, folder).where(F.col("stage") == TRANSLATED).select(*columns))
    return found


def read_lexicon_json(spark: SparkSession, path: str, by_line: bool | None = None) -> DataFrame:
    """(slang, formal) pairs of one JSON object.

    A whole object is one row while it is parsed; one that ``write_lexicon_json`` wrote, with an entry in each line, can
    be read ``by_line``, in any number of part files and tasks. Folders are, unless told otherwise: their parts are no
    objects of their own.
    """
    if is_folder(spark, path) if by_line is None else by_line:
        entry = F.regexp_replace("value", "^[{,]+|[,}]+$", "")
        text = spark.read.text(path).select(F.concat(F.lit("{"), entry, F.lit("}")).alias("value")).where("value != '{}'")
    else:
        text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return text.select(F.explode(entries).alias("slang", "formal"))


def read_lexicon_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw (slang, formal) rows in file order, for building a lexicon."""
    return read_csv_files(spark, [path]).select("slang", "formal", "row_id")


def read_descriptions(spark: SparkSession, entries: Mapping[str, str]) -> DataFrame:
    """Dataset descriptions as a table."""
    return spark.createDataFrame(list(entries.items()) or [], "stem string, description string")


def read_descriptions_yaml(spark: SparkSession, text: str) -> DataFrame:
    """The same from YAML text, where the parser is installed."""
    import yaml

    return read_descriptions(spark, {k: str(v) for k, v in (yaml.safe_load(text) or {}).items()})


def _wanted_folder(path: Column, root: str) -> Column:
    inside = F.replace(path, F.lit(root.rstrip("/") + "/"), F.lit(""))
    folders = F.filter(F.split(inside, "/"), lambda part: part != "")
    parents = F.slice(folders, 1, F.greatest(F.size(folders) - 1, F.lit(0)))
    return ~F.exists(parents, lambda part: part.isin(*SKIPPED_FOLDERS) | part.startswith("results"))


def _counted_files(spark: SparkSession, files: DataFrame, cache: str | None) -> DataFrame:
    """path and n_rows of ``files`` (path, length, modified), taken from ``cache`` where a file is unchanged.

    Only files that are new or changed are read. Counts of a file's earlier states stay in the cache unused.
    """
    state = ["path", "length", "modified"]
    schema = "path string, length long, modified timestamp, n_rows long"
    known = spark.read.schema(schema).parquet(cache) if cache and folder_exists(spark, cache) else spark.createDataFrame([], schema)
    known = stable_copy(files.join(known.dropDuplicates(state), state))
    wanted = [row["path"] for row in files.join(known, state, "left_anti").select("path").collect()]
    if not wanted:
        return known.select("path", "n_rows")
    lines = spark.read.text(wanted).select(_plain_path(F.col("_metadata.file_path")).alias("path"), "value")
    counts = lines.where(t.strip(F.col("value")) != "").groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"))
    read = files.join(known, state, "left_anti").join(counts, "path", "left").na.fill(0, ["n_rows"]).select(*state, "n_rows")
    if cache:
        read = stable_copy(read)
        read.coalesce(1).write.mode("append").parquet(cache)
    return known.select("path", "n_rows").unionByName(read.select("path", "n_rows"))


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/*", "/")


def corpus_catalogue(
    spark: SparkSession,
    root: str,
    descriptions: DataFrame,
    count_rows: bool = False,
    cache: str | None = None,
    pattern: str = CORPUS_FILES,
) -> DataFrame:
    """Every corpus file below ``root`` with its size and description; rows are counted on request.

    Files in skipped folders are never read; files without a byte are not listed. ``cache`` names a folder that keeps the counts by path, size and time of
    change, so that a later catalogue reads what has changed since and nothing else.
    """
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": "true"}
    listed = spark.read.format("binaryFile").options(**options).load(root)
    path = F.regexp_replace("path", "^file:/*", "/").alias("path")
    files = listed.select(path, "length", F.col("modificationTime").alias("modified")).where(_wanted_folder(F.col("path"), re.sub("^file:/*", "/", root)))
    named = files.select(
        t.file_stem(F.element_at(F.split("path", "/"), -1)).alias("stem"),
        "path",
        (F.col("length") / 1048576).alias("size_mb"),
    )
    today = F.date_format(F.current_date(), "dd-MM-yyyy")
    # Fixed value: the description of a file that has none.
    generic = F.concat(F.lit("Registered "), today, F.lit(" — "), F.col("stem"), F.lit(".jsonl"))
    described = named.join(descriptions, "stem", "left").withColumn("description", F.coalesce("description", generic))
    if not count_rows:
        return described.orderBy("path")
    return described.join(_counted_files(spark, files, cache), "path").orderBy("path")
