"""Tables of the library's record shapes, derived by Spark from the given parquet tables.

Scores are arithmetic on ids and text lengths, not model output. Nulls stand in keys, texts and scores on
purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbascope.functions import text as t

# The models of the scored view.
MODELS = ("org0/model-a", "org0/model-b", "org1/model_c", "org1/model-d")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dataset(number: Column) -> Column:
    third = number % 3
    return F.when(third == 0, "mono_sea").when(third == 1, "mono_me").otherwise("bilingual")


def _every(number: Column, step: int) -> Column:
    return number % step == 0


def _with_reference(spark: SparkSession, sf_dir: str, rows: DataFrame, name: str) -> DataFrame:
    """Give every document one benchmark text, dealt out in turn over the whole benchmark."""
    texts = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("__item"), F.col("text").alias(name))
    size = texts.agg(F.count(F.lit(1))).scalar()
    return rows.withColumn("__item", F.col("doc_id") % size).join(texts, "__item", "left").drop("__item")


def eval_rows(spark: SparkSession, sf_dir: str, translation: bool = True) -> DataFrame:
    """Evaluation rows; ``translation=False`` leaves out the benchmark join where nothing needs it."""
    documents = table(spark, sf_dir, "documents")
    if translation:
        documents = _with_reference(spark, sf_dir, documents, "translation")
    else:
        documents = documents.withColumn("translation", F.lit(None).cast("string"))
    number, lang = F.col("doc_id"), F.col("lang")
    mixed = _every(number, 7)
    second = F.when(lang == "en", "de").otherwise("en")
    return documents.select(
        number.alias("row_id"),
        F.when(~_every(number, 89), F.col("source")).alias("id1"),
        number.cast("string").alias("id2"),
        F.when(_every(number, 97), None).when(mixed, F.concat_ws(",", lang, second)).otherwise(lang).alias("lang_codes"),
        "text",
        "translation",
        mixed.alias("is_code_switched"),
        F.when(mixed, 2).otherwise(1).alias("lang_count"),
        F.when(~_every(number, 53), (number * 37 % 1010) / 1009.0).alias("semantic_similarity"),
        _dataset(number).alias("dataset"),
    )


def whole_hypothesis(number: Column) -> Column:
    """The whole text read backwards; every tenth row is a true copy."""
    return F.when(_every(number, 10), F.col("text")).otherwise(F.reverse("text"))


def per_model(documents: DataFrame) -> DataFrame:
    """Every document once per model."""
    models = F.array(*[F.struct(F.lit(i).alias("mi"), F.lit(name).alias("model")) for i, name in enumerate(MODELS)])
    return documents.select("*", F.inline(models))


def scored(spark: SparkSession, sf_dir: str, reference: bool = False, documents: DataFrame | None = None) -> DataFrame:
    """Scored rows of four models; ``documents`` may carry extra columns, which are kept."""
    given = table(spark, sf_dir, "documents")
    rows = given if documents is None else documents
    if reference:
        rows = _with_reference(spark, sf_dir, rows, "reference")
    # Whether a hypothesis copies its source is the document's own matter: settled before the models multiply it.
    copied = F.lower(t.strip(F.col("text"))) == F.lower(t.strip(whole_hypothesis(F.col("doc_id"))))
    extra = [c for c in rows.columns if c not in (*given.columns, "reference")]
    rows = rows.withColumn("copied", copied)
    number, mi = F.col("doc_id"), F.col("mi")
    shifted = number + mi

    def quality(multiplier: int) -> Column:
        return (number * multiplier + mi * 104729 + F.col("n_chars") * 13) % 1010 / 1009.0

    hypothesis = F.when(~_every(shifted, 50), whole_hypothesis(number))
    language = F.when(~_every(number, 97), F.col("lang"))
    return per_model(rows).select(
        "model",
        _dataset(number).alias("dataset"),
        language.alias("language"),
        language.alias("lang_codes"),
        F.when(~_every(number, 89), F.col("source")).alias("id1"),
        number.cast("string").alias("id2"),
        (number * 4 + mi).alias("row_id"),
        F.col("text").alias("source"),
        hypothesis.alias("hypothesis"),
        F.when(~_every(shifted, 41), F.when((number * 31 + mi * 17) % 10 < 8, 1.0).otherwise(0.0)).alias("ifeval"),
        F.when(~_every(shifted, 43), quality(7919)).alias("comet_qe"),
        F.when(~_every(shifted, 47), quality(6271)).alias("comet"),
        F.when(_every(shifted, 50), "timeout").alias("error"),
        *([F.col("reference")] if reference else []),
        F.when(hypothesis.isNotNull(), F.col("copied")).alias("source_copy"),
        *extra,
    )


def run_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metadata from the event stream, and one run without rows."""
    events = table(spark, sf_dir, "events")
    user = F.col("user_id") % 3
    model = F.when(user == 0, MODELS[0]).when(user == 1, MODELS[1]).otherwise(MODELS[2])
    elapsed = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / 1e10
    runs = events.groupBy(model.alias("model"), _dataset(F.col("event_id")).alias("dataset")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        elapsed.alias("elapsed_seconds"),
    )
    timed = runs.select(
        "*",
        F.round(F.col("n_rows") / F.col("elapsed_seconds"), 3).alias("req_per_s"),
        F.lit(32).cast("long").alias("concurrency"),
    )
    empty = spark.range(1).select(
        F.lit(MODELS[3]).alias("model"),
        F.lit("mono_sea").alias("dataset"),
        F.lit(0).cast("long").alias("n_rows"),
        F.lit(0).cast("long").alias("n_errors"),
        F.lit(0.0).alias("elapsed_seconds"),
        F.lit(None).cast("double").alias("req_per_s"),
        F.lit(32).cast("long").alias("concurrency"),
    )
    return timed.unionByName(empty)


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata record per event, with the revision the run reported."""
    user = F.col("user_id") % 3
    model = F.when(user == 0, MODELS[0]).when(user == 1, MODELS[1]).otherwise(MODELS[2])
    number = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        model.alias("model"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("rev"), (number % 2).cast("string"))).alias(
            "model_revision"
        ),
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the benchmark as slang."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(t.tokens(F.col("text"))).alias("slang"))
    return words.distinct()


def lexicon_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (slang, formal) rows: neighbouring words of every conversation turn, untidy and with repeats."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.regexp_extract_all("text", F.lit(t.TOKEN_PATTERN), F.lit(0)).alias("words")
    )
    pairs = turns.select("conv_id", "turn", "words", F.posexplode("words").alias("at", "slang"))
    formal = F.coalesce(F.get("words", F.col("at") + 1), F.lit(""))
    return pairs.select(
        F.when(F.col("at") % 11 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "slang")).alias("slang"),
        F.when(F.col("at") % 5 == 0, F.concat("slang", F.lit(" "))).otherwise(formal).alias("formal"),
        ((F.col("conv_id") * 1000 + F.col("turn")) * 100000 + F.col("at")).alias("row_id"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the answer that follows it directly."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source"))
    answers = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hypothesis")
    )
    row_id = F.col("conv_id") * 1000 + F.col("turn")
    return asked.join(answers, ["conv_id", "turn"], "left").select(
        row_id.alias("row_id"), "source", "hypothesis", F.lit(None).cast("string").alias("reference")
    )


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding with the next one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("left"))
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("left").alias("right"))
    return vectors.join(following, "vec_id")


def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two judges' verdicts on every labelled document."""
    number = F.col("doc_id")
    labels = table(spark, sf_dir, "labels")
    verdicts = F.array(
        F.struct(F.lit("baseline").alias("judge"), (number % 3 != 0).cast("int").alias("pred")),
        F.struct(
            F.lit("candidate").alias("judge"),
            F.when(number % 10 == 0, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int").alias("pred"),
        ),
    )
    return labels.select("doc_id", F.col("quality").alias("gold"), F.inline(verdicts))
