"""Text columns: trimming, counting, cutting, tokens and file-name parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.strip() and str.split() treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: runs of letters and of the number characters that are not decimal digits.
TOKEN_PATTERN = r"[\p{L}\p{Nl}\p{No}]+"

# Length limits of the reports.
EXAMPLE_LIMIT = 500
PREVIEW_LIMIT = 80
LABEL_LIMIT = 100
CLIP_LIMIT = 140

# The same set as a character class: (?U)\s lacks only the four separators U+001C to U+001F.
_WORD_PATTERN = r"(?U)[^\s\x1c-\x1f]+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Python's ``str.strip``: all Unicode whitespace, not only the space."""
    return F.trim(text, F.lit(WHITESPACE))


def char_length(text: Column) -> Column:
    """Length in code points, 0 for null."""
    return F.length(text_or_empty(text))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words, 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(_WORD_PATTERN))


def truncate(text: Column, limit: int = EXAMPLE_LIMIT) -> Column:
    """At most ``limit`` characters; the last is an ellipsis when something was cut."""
    whole = text_or_empty(text)
    return F.when(F.length(whole) <= limit, whole).otherwise(
        F.concat(F.substring(whole, 1, limit - 1), F.lit("…"))
    )


def preview(text: Column, limit: int = PREVIEW_LIMIT) -> Column:
    """One-line form of :func:`truncate`."""
    return truncate(F.replace(text_or_empty(text), F.lit("\n"), F.lit(" ")), limit)


def clip(text: Column, limit: int = CLIP_LIMIT) -> Column:
    """One line of the first ``limit`` characters, an ellipsis after them when there were more."""
    line = F.replace(text_or_empty(text), F.lit("\n"), F.lit(" "))
    return F.concat(F.left(line, F.lit(limit)), F.when(F.length(line) > limit, "…").otherwise(""))


def selector_label(dataset: Column, language: Column, source: Column) -> Column:
    """``[dataset/language]  preview``; a missing language prints as ``None``."""
    return F.concat(
        F.lit("["), dataset, F.lit("/"), F.coalesce(language, F.lit("None")), F.lit("]  "), preview(source, LABEL_LIMIT)
    )


def tokens(text: Column) -> Column:
    """Letter runs, each lower-cased after the match; null and empty text give an empty array.

    Lower-casing the whole text first is cheaper and gives the same tokens, save where it depends on the
    neighbours (capital sigma) or adds a combining mark (dotted capital I).
    """
    whole = text_or_empty(text)
    pattern, all_of_it = F.lit(TOKEN_PATTERN), F.lit(0)
    return F.when(
        whole.rlike("[\u0130\u03a3]"),
        F.transform(F.regexp_extract_all(whole, pattern, all_of_it), lambda run: F.lower(run)),
    ).otherwise(F.regexp_extract_all(F.lower(whole), pattern, all_of_it))


def comma_list(raw: str | None, lower: bool = False) -> list[str]:
    """Parse a comma-separated argument: trimmed, empty parts dropped."""
    parts = [part.strip() for part in (raw or "").split(",")]
    return [part.lower() if lower else part for part in parts if part]


def code_list(codes: Column) -> Column:
    """Parse a comma-separated column into an array: trimmed, empty parts dropped."""
    parts = F.transform(F.split(text_or_empty(codes), ","), lambda part: strip(part))
    return F.filter(parts, lambda part: part != "")


def row_limit(raw: str | None) -> int | None:
    """Parse a row cap; blank, ``none`` and ``null`` mean all rows."""
    value = (raw or "").strip().lower()
    return None if value in ("", "none", "null") else int(value)


def model_slug(model: Column) -> Column:
    """Model name as it may stand in a file name."""
    return F.translate(model, "/:", "__")


def model_from_slug(slug: Column) -> Column:
    """Undo :func:`model_slug` as far as possible: the first underscore was the slash.

    Wrong for an organisation with an underscore, so prefer a ``model`` column where there is one.
    """
    return F.regexp_replace(slug, "^([^_]*)_", "$1/")


def name_parts(file_name: Column, datasets: Sequence[str], suffix: str = "_scored.csv") -> tuple[Column, Column]:
    """(slug, dataset) of ``<slug>_<dataset><suffix>``; both null when no listed dataset fits."""
    slug = dataset = F.lit(None).cast("string")
    for name in reversed(datasets):
        tail = f"_{name}{suffix}"
        fits = file_name.endswith(tail)
        slug = F.when(fits, F.left(file_name, F.length(file_name) - len(tail))).otherwise(slug)
        dataset = F.when(fits, F.lit(name)).otherwise(dataset)
    return slug, dataset


def dataset_of_scored_name(file_name: Column, datasets: Sequence[str] = ("mono_sea", "mono_me")) -> Column:
    """Dataset a scored file belongs to, or ``unknown``."""
    return F.coalesce(name_parts(file_name, datasets)[1], F.lit("unknown"))


def file_stem(file_name: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(file_name, r"(?s)^(.*[^.].*)\.[^.]*\z", "$1")


def translations_name(model: Column, input_name: Column) -> Column:
    """File name of one model's translations of one input file."""
    return F.concat(model_slug(model), F.lit("_translations_"), file_stem(input_name), F.lit(".csv"))


def scored_name(translations_file: Column) -> Column:
    """File name of the scored form of a translations file."""
    return F.concat(F.replace(file_stem(translations_file), F.lit("_translations"), F.lit("")), F.lit("_scored.csv"))


def dataset_of_meta_name(meta_name: Column, slug: Column) -> Column:
    """Dataset a run-metadata file describes, given the model's slug."""
    without_model = F.replace(meta_name, F.concat(slug, F.lit("_translations_")), F.lit(""))
    return F.replace(without_model, F.lit(".csv.meta.json"), F.lit(""))


def slug_of(model: str) -> str:
    """:func:`model_slug` of a plain string."""
    return model.replace("/", "_").replace(":", "_")


def file_stem_of(path: str) -> str:
    """:func:`file_stem` of the last part of a plain path."""
    name = path.rstrip("/").rpartition("/")[2]
    stem, dot, _ = name.rpartition(".")
    return stem if dot and stem.strip(".") else name
