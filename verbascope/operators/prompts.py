"""Translation prompts, without and with example translations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbascope.functions import text as t
from verbascope.operators.joins import null_safe_join, small_side, spread_join
from verbascope.operators.ranking import head_per_group

# The wording the models are evaluated with.
EXAMPLES_HEADING = "The following are example translations:"
ASK_HEAD = "Translate the following "
ASK_TAIL = "text to English. Output only the translation, nothing else."
UNKNOWN_LANGUAGE = "Unknown"


def _known(language: Column) -> Column:
    return F.nullif(language, F.lit(""))


def instruction(language: Column) -> Column:
    """The request, naming the language when there is one."""
    phrase = F.coalesce(F.concat(_known(language), F.lit(" ")), F.lit(""))
    return F.concat(F.lit(ASK_HEAD), phrase, F.lit(ASK_TAIL))


def source_line(language: Column, text: Column) -> Column:
    shown = F.coalesce(_known(language), F.lit(UNKNOWN_LANGUAGE))
    return F.concat(F.lit("Source ("), shown, F.lit("): "), t.text_or_empty(text))


def zero_shot_prompt(text: Column, language: Column) -> Column:
    return F.concat(instruction(language), F.lit("\n\n"), t.text_or_empty(text))


def few_shot_prompt(text: Column, language: Column, examples: Column) -> Column:
    """``examples`` is the block made by :func:`example_blocks`; without one the prompt is zero-shot."""
    asked = F.concat_ws("\n", F.lit(EXAMPLES_HEADING), examples, instruction(language), source_line(language, text),
                        F.lit("Translation:"))
    return F.when(examples.isNull(), zero_shot_prompt(text, language)).otherwise(asked)


def split_examples(
    rows: DataFrame, shots: int, keys: tuple[str, ...] = ("dataset",), row_id: str = "row_id"
) -> tuple[DataFrame, DataFrame]:
    """(examples, inputs): the first ``shots`` rows of each file, and all its other rows.

    A row id needs to be unique in its file only. A file without rows to spare is an error.
    """
    if shots <= 0:
        return rows.limit(0), rows
    short = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= shots).first()
    if short is not None:
        raise ValueError(f"{shots} examples need more than {short['n']} rows in {[short[k] for k in keys]}")
    chosen = head_per_group(rows, keys, shots, row_id)
    whole = [*keys, row_id]
    ids, _ = small_side(chosen.select(*whole))
    return null_safe_join(rows, ids, whole, "left_semi"), null_safe_join(rows, ids, whole, "left_anti")


def example_blocks(examples: DataFrame, keys: tuple[str, ...] = ("dataset",), row_id: str = "row_id") -> DataFrame:
    """One text block per file: each example's source, translation and a blank line, in file order."""
    entry = F.concat(
        source_line(F.col("lang_codes"), F.col("text")),
        F.lit("\nTranslation: "),
        t.text_or_empty(F.col("translation")),
        F.lit("\n"),
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col(row_id).alias("at"), entry.alias("entry"))))
    return examples.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda e: e["entry"]), "\n").alias("examples")
    )


def with_prompts(
    rows: DataFrame, shots: int = 0, keys: tuple[str, ...] = ("dataset",), row_id: str = "row_id"
) -> DataFrame:
    """Rows to translate with their ``prompt``; rows used as examples are taken out."""
    if shots <= 0:
        return rows.withColumn("prompt", zero_shot_prompt(F.col("text"), F.col("lang_codes")))
    examples, inputs = split_examples(rows, shots, keys, row_id)
    blocks, fits = small_side(example_blocks(examples, keys, row_id))
    if fits:
        joined = null_safe_join(inputs, blocks, keys, "left")
    else:
        joined = spread_join(inputs, blocks, keys, [row_id], "left")
    prompt = few_shot_prompt(F.col("text"), F.col("lang_codes"), F.col("examples"))
    return joined.withColumn("prompt", prompt).drop("examples")
